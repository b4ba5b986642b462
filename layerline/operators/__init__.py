"""Operators on DataFrames that the jobs are made of."""

from layerline.operators.aggregate import group_counts, group_totals
from layerline.operators.compact import compact
from layerline.operators.compact_table import compact_table, compaction_plan, remove_replaced
from layerline.operators.sort import preview, sort_rows

__all__ = [
    "compact",
    "compact_table",
    "compaction_plan",
    "group_counts",
    "group_totals",
    "preview",
    "remove_replaced",
    "sort_rows",
]
