"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``distance`` bits have a common variant within half that distance of
both. Every distinct fingerprint stands for all its variants within the radius; fingerprints
that share a variant are linked, and the pair is verified by its bit distance.

Emitting 2,081 variants per fingerprint (64 bits, radius 2) as rows would shuffle fifty times
the fingerprints' weight. Variants are dealt by their leading bits instead: a fingerprint emits
one row for every leading part that some of its variants have, and the task that gets a
leading part makes the variants that start with it. Every variant of every fingerprint still
meets its equals in one place, with about a twentieth of the rows.

All owners of one variant lie within the distance of each other, so linking each to the
smallest owner loses no group and makes no pairs within a large group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.common import checkpointed, components, small_batches, text_pass

SHINGLE = 4
DISTANCE = 4
BITS = 64
# Slices of the fingerprints of one root when its smallest id is handed to them.
ROOT_SLICES = 8
SEED = 42
# Rows of one leading part that are expected, and variants that a task holds at once.
PART_ROWS = 4_000
HELD_VARIANTS = 1_000_000
MOST_LEADING = 48
# Shingles of one text that are hashed at a time.
SHINGLE_BLOCK = 16_384

FINGERPRINT = T.StructType([T.StructField("fingerprint", T.LongType())])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a whole text."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    set_bits = np.zeros(BITS, np.int64)
    for start in range(0, count, SHINGLE_BLOCK):
        some = words[start : min(start + SHINGLE_BLOCK, count) + shingle - 1]
        set_bits += bit_counts(_hashes(some, shingle))
    bits = np.packbits(2 * set_bits > count, bitorder="little")
    return int(bits.view("<i8")[0])


def _hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Hashes of all shingles of some words; of all words together if they are fewer."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: max(0, len(words) - shingle)].tolist()]
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    return np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes set each bit."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little")
    return bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)


def with_fingerprint(df: DataFrame, column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Add ``fingerprint`` (long) to every row; null and wordless texts have fingerprint 0."""
    return text_pass(df, column, FINGERPRINT, lambda: lambda texts: [[fingerprint(text, shingle) for text in texts]])


def leading_bits(count: int, radius: int) -> int:
    """Leading bits by which variants are dealt so that parts stay near ``PART_ROWS`` rows."""
    bits = 8
    while bits < MOST_LEADING and count * ball_size(bits, radius) > PART_ROWS * 2**bits:
        bits += 1
    return bits


def ball_size(bits: int, radius: int) -> int:
    return sum(comb(bits, flips) for flips in range(radius + 1))


def masks(bits: range, radius: int) -> np.ndarray:
    """All ways to flip up to ``radius`` of some bits, the fewest flips first."""
    made = [sum(1 << bit for bit in flips) for size in range(radius + 1) for flips in combinations(bits, size)]
    return np.array(made, np.uint64)


def ball_links(fingerprints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``distance`` bits.

    ``fingerprints`` has one long column of distinct values without nulls. Not every close pair
    is returned, but every two close fingerprints are connected, and every link is close.
    """
    if distance % 2:
        raise ValueError("the distance must be even: both sides take half of it")
    column = fingerprints.columns[0]
    radius = distance // 2
    leading = leading_bits(fingerprints.count(), radius)
    leads = masks(range(BITS - leading, BITS), radius)
    shift = np.uint64(BITS - leading)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, 500_000 // len(leads))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for at in range(0, len(values), step):
                some = values[at : at + step, None]
                parts = ((some ^ leads[None, :]) >> shift).view(np.int64).ravel()
                owners = np.broadcast_to(some, (len(some), len(leads))).view(np.int64).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(owners)], names=["part", "owner"])

    small_batches(fingerprints.sparkSession)
    dealt = fingerprints.select(column).mapInArrow(emit, "part long, owner long")
    partitions = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_parts = dealt.repartition(partitions, "part").sortWithinPartitions("part")
    met = sorted_parts.mapInArrow(_meet(leading, radius, distance), "a long, b long")
    return met.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def _meet(leading: int, radius: int, distance: int):
    tails = [masks(range(BITS - leading), size) for size in range(radius + 1)]
    shift = np.uint64(BITS - leading)

    def whole_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows in runs of whole parts, gathered to a useful size."""
        parts, owners = [], []
        for batch in batches:
            part, owner = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            if not len(part):
                continue
            parts.append(part.view(np.uint64))
            owners.append(owner.view(np.uint64))
            if sum(map(len, parts)) >= 50_000:
                part, owner = np.concatenate(parts), np.concatenate(owners)
                cut = int(np.searchsorted(part, part[-1]))
                if cut:
                    yield part[:cut], owner[:cut]
                parts, owners = [part[cut:]], [owner[cut:]]
        if parts:
            yield np.concatenate(parts), np.concatenate(owners)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, owner in whole_parts(batches):
            left = radius - np.bitwise_count((owner >> shift) ^ part).astype(np.int64)
            for a, b in _links(part << shift, owner, left, tails, shift):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def _variants(lead, owner, left, tails, shift, keep=None):
    """Variants that start with each row's leading part, and the row each belongs to."""
    low = (np.uint64(1) << shift) - np.uint64(1)
    values, rows = [], []
    for size, tail in enumerate(tails):
        own = np.flatnonzero(left == size)
        if not len(own):
            continue
        step = max(1, HELD_VARIANTS // len(tail))
        for at in range(0, len(own), step):
            some = own[at : at + step]
            made = (lead[some] | (owner[some] & low))[:, None] ^ tail[None, :]
            row = np.repeat(some, len(tail))
            made = made.ravel()
            if keep is not None:
                chosen = keep(made)
                made, row = made[chosen], row[chosen]
            values.append(made)
            rows.append(row)
    return (np.concatenate(values), np.concatenate(rows)) if values else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _links(lead, owner, left, tails, shift) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links from every owner of a shared variant to the smallest owner, part by part.

    Rows of few variants are handled together. A part with many rows is worked through in
    slices of its variants, so memory stays bounded however large a group is.
    """
    total = int(sum(len(tail) * int((left == size).sum()) for size, tail in enumerate(tails)))
    slices = max(1, ceil(total / HELD_VARIANTS))
    for number in range(slices):
        keep = None if slices == 1 else lambda made, number=number: _mixed(made) % np.uint64(slices) == number
        values, rows = _variants(lead, owner, left, tails, shift, keep)
        # sort hashes packed with their row: equal neighbours name the rows that may share one
        bits = max(1, ceil(log2(len(owner) + 1)))
        packed = (_mixed(values) >> np.uint64(bits) << np.uint64(bits)) | rows.astype(np.uint64)
        packed.sort()
        same = np.flatnonzero((packed[1:] ^ packed[:-1]) >> np.uint64(bits) == 0)
        if not len(same):
            continue
        low = np.uint64((1 << bits) - 1)
        involved = np.zeros(len(owner), bool)
        involved[(packed[same] & low).astype(np.int64)] = True
        involved[(packed[same + 1] & low).astype(np.int64)] = True
        chosen = involved[rows]
        values, owners = values[chosen], owner[rows[chosen]]
        order = np.lexsort((owners, values))
        values, owners = values[order], owners[order]
        first = np.r_[True, values[1:] != values[:-1]]
        least = owners[np.maximum.accumulate(np.where(first, np.arange(len(values)), 0))]
        linked = np.unique(np.stack([least, owners])[:, least != owners], axis=1)
        if linked.shape[1]:
            yield linked[0].copy(), linked[1].copy()


def _mixed(values: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit values that spreads neighbours."""
    mixed = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def simhash_groups(
    df: DataFrame, key: str = "doc_id", column: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row (key, fingerprint, component_id) for every row of ``df``.

    ``component_id`` is the smallest key of all rows reached by links, the row itself included;
    a null key is passed over, and a group of null keys only has a null id. Null and wordless
    texts share fingerprint 0 and so one group with whatever is close to it. Rows that repeat a
    key or a text are rows of their own with the same rules. An empty table gives none.

    Texts pass once and are not shuffled. Fingerprints are reduced to distinct ones with
    partial aggregation, so copies cost nothing however many there are, and groups are found
    by distributed star contraction.
    """
    rows = checkpointed(with_fingerprint(df.select(F.col(key).alias("key"), F.col(column).alias("text")), "text", shingle).drop("text"))
    distinct = checkpointed(rows.groupBy("fingerprint").agg(F.min("key").alias("least")))
    linked = distinct.join(_roots(distinct, distance), "fingerprint")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    # a root may stand for very many fingerprints: they are dealt to slices, its one row copied
    slices = F.explode(F.sequence(F.lit(0), F.lit(ROOT_SLICES - 1))).alias("slice")
    dealt = linked.withColumn("slice", F.pmod(F.xxhash64("fingerprint"), F.lit(ROOT_SLICES)).cast("int"))
    found = dealt.join(least.select("*", slices), ["root", "slice"]).select("fingerprint", "component_id")
    named = distinct.join(found, "fingerprint", "left").select("fingerprint", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(named, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")


def _roots(distinct: DataFrame, distance: int) -> DataFrame:
    """(fingerprint, root) of the fingerprints that have links."""
    links = ball_links(distinct.select("fingerprint"), distance)
    return components(links).select(F.col("node").alias("fingerprint"), "root")


def fingerprint_groups(documents: DataFrame) -> DataFrame:
    """Fingerprint and component of every document, the fingerprint as 16 hex digits."""
    hexed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return simhash_groups(documents).select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_per_group(documents: DataFrame) -> DataFrame:
    """The documents without near copies: exactly one row of each group stays.

    It is the one with the smallest id, null ids coming last; of rows that repeat that id the one
    with the smallest digest of its text; of rows equal in both any one. Rows are told apart by id and
    digest, so texts are read where they lie and only those of repeated rows are shuffled.
    """
    marked = documents.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), F.col("text").isNull().alias("is_null"))
    prints = with_fingerprint(marked, "text", SHINGLE).drop("text")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "is_null")
    counted = prints.groupBy("fingerprint", "doc_id", "digest", "is_null").agg(F.count(F.lit(1)).alias("copies"))
    first = counted.groupBy("fingerprint").agg(F.min(F.struct(row.alias("row"), F.col("copies"))).alias("first"))
    distinct = checkpointed(first)
    rooted = distinct.join(_roots(distinct, DISTANCE), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    chosen = rooted.groupBy("root").agg(F.min("first").alias("first"))
    kept = checkpointed(
        chosen.select(
            F.col("first.row.doc_id").alias("_id"), F.col("first.row.digest").alias("_digest"),
            F.col("first.row.is_null").alias("_is_null"), (F.col("first.copies") > 1).alias("_repeated"),
        )
    )

    def rows(repeated: bool) -> DataFrame:
        same = (
            documents["doc_id"].eqNullSafe(kept["_id"])
            & (F.md5(F.coalesce(documents["text"], F.lit(""))) == kept["_digest"])
            & (documents["text"].isNull() == kept["_is_null"])
        )
        return documents.join(kept.where(F.col("_repeated") == repeated), same, "left_semi")

    return rows(False).unionByName(rows(True).dropDuplicates(["doc_id", "text"]))
