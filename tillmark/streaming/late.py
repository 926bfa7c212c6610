"""Which keys of a batch reach back behind what is stored of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.operators.ordered import free_names, same_key

_ROLES = ("_next", "_seen")
# Bits of the filter of ``maybe_of_keys``, 64 to a row: what is broadcast does not grow with the keys.
FILTER_BITS = 1 << 24


def late_keys(fresh: DataFrame, last: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """Keys with a fresh row at or before the last stored one.

    One aggregate over both tables, combined before the shuffle; null keys are a key like any
    other, and a null sequence comes before every other one.
    """
    marked = [
        rows.select(
            *keys,
            F.when(F.lit(role == "_next"), F.col(sequence)).alias("_next"),
            F.when(F.lit(role == "_seen"), F.col(sequence)).alias("_seen"),
            (F.lit(role == "_next") & F.col(sequence).isNull()).alias("_next_is_null"),
            F.lit(role == "_seen").alias("_known"),
        )
        for role, rows in zip(_ROLES, (fresh, last), strict=True)
    ]
    by_key = marked[0].unionByName(marked[1]).groupBy(*keys).agg(
        F.min("_next").alias("_next"),
        F.max("_seen").alias("_seen"),
        F.max("_next_is_null").alias("_next_is_null"),
        F.max("_known").alias("_known"),
    )
    reaches_back = F.col("_next_is_null") | F.coalesce(F.col("_next") <= F.col("_seen"), F.lit(False))
    return by_key.where(F.col("_known") & reaches_back).select(*keys)


def of_keys(df: DataFrame, some: DataFrame, keys: list[str], inside: bool = True) -> DataFrame:
    """Rows whose key is, or is not, among some keys; null equals null."""
    named = some.select(*[F.col(key).alias(f"_k{place}") for place, key in enumerate(keys)])
    return df.join(named, same_key(keys), "left_semi" if inside else "left_anti")


def maybe_of_keys(df: DataFrame, some: DataFrame, keys: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose key may be among some keys: all that are, and of the others the fewer the fewer keys
    there are. Rows stay where they are; a bit of a filter stands for the keys of one hash."""
    place, (word, marks) = F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(bits)), free_names(df, "_word", "_marks")
    bit = F.pmod(place, F.lit(64)).cast("int")
    marked = some.select(F.shiftright(place, 6).alias(word), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias(marks))
    words = marked.groupBy(word).agg(F.bit_or(marks).alias(marks))
    met = df.withColumn(word, F.shiftright(place, 6)).join(F.broadcast(words), word)
    return met.where(F.getbit(marks, bit) == 1).select(*df.columns)
