"""Column helpers, all built-in expressions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_of(timestamp: str | Column) -> Column:
    """``YYYY-MM-DD`` text. For a timestamp without time zone, no zone is involved."""
    column = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return column.cast("date").cast("string")


def conform(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Exactly the named columns, in this order."""
    return df.select([column.alias(name) for name, column in columns.items()])


def total(amount: str | Column) -> Column:
    """Sum of a double column, rounded half up to two decimals.

    A sum of doubles loses cents after some million rows, and loses others in
    another order of rows. Here three parts of each amount add up on their own:
    whole units and millionths as integers, exactly, and what is smaller than a
    millionth as doubles. A rest that is within the error of the double itself (the
    last digits of 0.1, say) is no part of the amount and is left out. Amounts that
    are not finite, or beyond the integers, are added as doubles.
    """
    column = F.col(amount) if isinstance(amount, str) else amount
    units = column.try_cast("bigint")
    fraction = column - units
    millionths = F.rint(fraction * 1_000_000)
    rest = fraction - millionths / 1_000_000
    small = F.sum(F.when(F.abs(rest) > F.abs(column) * 2.0**-52, rest))
    beyond = F.sum(F.when(units.isNull(), column))
    exact = F.try_sum(units).cast("decimal(19,0)") + F.try_sum(millionths.cast("bigint")).cast("decimal(19,0)") * Decimal(
        "0.000001"
    )
    others = F.coalesce(small, F.lit(0.0)) + F.coalesce(beyond, F.lit(0.0))
    rounded = F.round(F.coalesce(exact, F.lit(0)) + others.try_cast("decimal(31,12)"), 2).cast("double")
    # Units that overflow have no exact sum, and infinity, NaN or a huge rest no decimal.
    summed = F.sum(column)
    finite = exact.isNotNull() | (F.count(units) == 0)
    return F.when(F.count(column) > 0, F.coalesce(F.when(finite, rounded), F.round(summed, 2)))
