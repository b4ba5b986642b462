"""Column helpers."""

from layerline.functions.columns import conform, day_of, total

__all__ = ["conform", "day_of", "total"]
