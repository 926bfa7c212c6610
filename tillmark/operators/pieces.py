"""The row before, per key, for rows that are stored in parts: whole rows travel once.

A part is cut into pieces of about equal size at rows found in a sample, so a large key spans
several pieces. A piece ends with all rows that equal its cut in key, sequence and value; the next
one therefore begins right behind that cut, and is told of it by a carried row. So the rows of a
piece find those before them in the task that writes the piece, and need no other shuffle.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.sources.parted import PART

CARRIED, CUTS, FIRST, PIECE = "_carried", "_cuts", "_first", "_piece"
# A task sorts one piece of whole rows in memory.
PIECE_ROWS = 500_000
# Rows seen per piece to find the cuts; the result does not depend on them.
SEEN_PER_PIECE = 100


def cuts(rows: DataFrame, order: list[str], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """By part (column ``PART``), the rows at which it is cut, in order; a part of one piece has none.

    Another run may find other cuts, so store them before they are used.
    """
    share = min(1.0, SEEN_PER_PIECE / piece_rows)
    every = max(1, round(piece_rows * share))
    place = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    picked = rows.select(PART, *order).sample(share, 1).withColumn("_place", place).where(F.col("_place") % every == 0)
    return picked.select(PART, *order).distinct().groupBy(PART).agg(F.sort_array(F.collect_list(F.struct(*order))).alias(CUTS))


def by_key(rows: DataFrame, keys: list[str], part: Column, parts: Collection[str], n_rows: int, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Rows dealt to pieces (column ``PIECE``) by the hashes of their keys, each piece of one of the
    ``parts``. About ``n_rows`` rows are expected."""
    per_part = max(1, -(-n_rows // (max(1, len(parts)) * piece_rows)))
    place = F.array_position(F.array(*[F.lit(name) for name in sorted(parts)]), part) - 1
    piece = (place * per_part + F.pmod(F.hash(*keys), F.lit(per_part))).cast("int")
    return rows.withColumn(PIECE, piece).repartitionById(max(1, len(parts)) * per_part, F.col(PIECE))


def with_value_before(
    rows: DataFrame, found: DataFrame, parts: Collection[str], key: str, sequence: str, value: str, into: str
) -> DataFrame:
    """Add ``value`` of the row before, per ``key``, ordered by ``sequence``, ``value`` and then the
    remaining columns. Rows leave by pieces, each of one part.

    Rows of ``rows`` marked in ``CARRIED`` are looked back to and dropped. ``found`` are stored cuts of
    the rows by (key, sequence, value), ``parts`` the parts that rows belong to.
    """
    order = [key, sequence, value]
    counts = {row[PART]: row.n for row in found.select(PART, F.size(CUTS).alias("n")).collect()}
    firsts, pieces = [], 0
    for part in sorted(parts):
        firsts.append((part, pieces))
        pieces += counts.get(part, 0) + 1
    # one row per part, one cut per piece: small whatever the rows are
    known = rows.sparkSession.createDataFrame(firsts, f"{PART} string, {FIRST} int").join(found, PART, "left")
    behind = F.size(F.filter(CUTS, lambda cut: cut < F.struct(*order)))
    dealt = rows.join(F.broadcast(known), PART).withColumn(PIECE, F.col(FIRST) + F.when(F.col(CUTS).isNotNull(), behind).otherwise(0))
    ends = known.select(PART, FIRST, F.posexplode(CUTS).alias("_place", "_cut"))
    ends = ends.select(PART, "_cut.*", F.lit(True).alias(CARRIED), (F.col(FIRST) + F.col("_place") + 1).alias(PIECE))
    together = dealt.drop(FIRST, CUTS).unionByName(ends, allowMissingColumns=True).repartitionById(max(pieces, 1), F.col(PIECE))
    rest = sorted(name for name in rows.columns if name not in (*order, PART, CARRIED))
    before = Window.partitionBy(PIECE, key).orderBy(sequence, value, *rest)
    return together.withColumn(into, F.lag(value).over(before)).where(~F.col(CARRIED)).drop(PIECE, CARRIED)
