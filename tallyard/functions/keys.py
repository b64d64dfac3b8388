"""Keys, money and ratios: the places where engines differ, in one module."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sk(*parts: str | Column) -> Column:
    """Surrogate key: md5 of the parts joined by ':'; null parts are left out, as concat_ws does."""
    return F.md5(F.concat_ws(":", *(_column(p).cast("string") for p in parts)).cast("binary"))


def natural_id(*parts: str | Column) -> Column:
    """Natural id: the parts joined by ':'; a null part reads 'None'."""
    return F.concat_ws(":", *(F.coalesce(_column(p).cast("string"), F.lit("None")) for p in parts))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division of exactly summed values; null for a denominator of 0 or null."""
    return _column(numerator).cast("double") / F.nullif(_column(denominator).cast("double"), F.lit(0.0))


def amount(quantity: str | Column, price: str | Column) -> Column:
    """quantity * price without loss of scale: the quantity enters as an int."""
    return _column(quantity).cast("int") * _column(price)


def total(c: str | Column) -> Column:
    """Exact sum of a decimal column."""
    return F.sum(_column(c)).cast("decimal(38,4)")


def when_all(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side."""
    return reduce(lambda a, b: a.crossJoin(b), frames)
