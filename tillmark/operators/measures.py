"""Aggregates and window measures the marts are composed of."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.sum(F.coalesce(condition, F.lit(False)).cast("int"))


def exact_sum(column: str) -> Column:
    """Sum of values with four decimals as a decimal: the same in any order, and mergeable.

    One type for all values: a value of 10^19 or more, or one that is no number, makes it NULL.
    """
    exact = F.col(column).try_cast("decimal(23,4)")
    odd = F.max(F.col(column).isNotNull() & exact.isNull())
    return F.when(~odd, F.sum(exact)).cast("decimal(33,4)")


def mean_of(total: str | Column, count: str | Column) -> Column:
    """Mean of an exact sum that is not negative, rounded half up to cents."""
    total, count = (F.col(one) if isinstance(one, str) else one for one in (total, count))
    # a quotient just below half a cent may have been rounded up to it before
    mean = F.round(F.try_divide(total, count), 2)
    half, cent = F.lit(Decimal("0.005")), F.lit(Decimal("0.01"))
    return F.when((mean - half) * count > total, mean - cent).otherwise(mean).cast("double")


def mean_2dp(column: str) -> Column:
    """Mean rounded half up to cents, the same whatever the order of summation; NULL where
    ``exact_sum`` is."""
    return mean_of(exact_sum(column), F.count(column))


def share_pct(part: str, whole: str) -> Column:
    return F.round(F.try_divide(F.col(part), F.col(whole)) * 100, 2)


def change_pct(now: str, before: str) -> Column:
    """Percent change; NULL without a value before, or when that is 0."""
    changed = (F.col(now) - F.col(before)) / F.col(before) * 100
    return F.when(F.col(before) != 0, F.round(changed, 2))


def with_rank(df: DataFrame, within: list[str], by: str) -> DataFrame:
    """Add ``price_rank`` (ties share a rank) and ``is_cheapest``."""
    window = Window.partitionBy(*within).orderBy(by)
    return df.withColumn("price_rank", F.rank().over(window)).withColumn("is_cheapest", F.col("price_rank") == 1)


def with_base_index(df: DataFrame, within: list[str], over: str, value: str) -> DataFrame:
    """Add ``base_price``, the first value of each group in ``over`` order, and the index to it."""
    window = Window.partitionBy(*within).orderBy(over)
    based = df.withColumn("base_price", F.first(value).over(window))
    return based.withColumn("price_index", index_of(value, "base_price"))


def index_of(value: str, base: str) -> Column:
    return F.round(F.try_divide(F.col(value), F.col(base)) * 100, 1)
