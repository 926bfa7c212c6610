"""Frequent phrases and how firmly their words belong together.

Counting every phrase of a large corpus exactly needs a table of all phrases, most of which
occur once. Two passes avoid it:

1. Every task counts phrase hashes of a block of its texts and deals them to hash partitions.
   Each partition merges its blocks into one Misra-Gries summary (Agarwal et al., "Mergeable
   Summaries", 2012) whose capacity exceeds the partition's mass divided by the threshold.
   All counters together fall by less than the threshold, so every frequent phrase keeps a
   counter above zero; a few rare ones may too. The hashes kept set bits of a filter of fixed
   size, each partition in a slice of its own.
2. The texts are read again. Phrases that the filter lets through are counted exactly, by
   their words, combined per block before the shuffle; those below the threshold go.

The summaries only choose what is counted: counts are exact whatever hashes collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillmark.llm.common import checkpointed, small_batches

LONGEST = 3
LEAST_COUNT = 10
PHRASES_PER_LANG = 2000
# Share, in percent, of a phrase's occurrences that lie inside a longer one to make it a part.
PART_PERCENT = 50
NO_LANG = "und"
# Text that a hash partition stands for on average; bounds the memory of a merging task.
PARTITION_BYTES = 8_000_000
# Words that a task counts at a time; twice as many different ones must fit 21 bits.
BLOCK_WORDS = 1_000_000
# Size of the filter that every task of the second pass holds, whatever the input. A fuller
# filter lets more rare phrases through to the exact count, which drops them.
FILTER_BITS = 1 << 27
# Parts of phrases are looked up in this many slices, for a frequent word is part of many.
LOOKUP_SLICES = 8
NUMBER_BITS = np.uint64(21)
# Odd constants of a multiplicative hash.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
BREAKS = bytes.maketrans(b".,;:!?\n\v\f\r", b"\n" * 10)


class Block:
    """Words of texts of one language, numbered as they come; 0 stands between pieces."""

    def __init__(self, lang: str):
        self.lang, self.words = lang, [b""]
        self.numbers: dict[bytes, int] = {}
        self.runs: list[int] = []
        self.before: list[int] = []  # places of words that an earlier block has counted

    def add(self, words: list[bytes], before: int) -> None:
        """Words that follow each other; the first ``before`` of them only lead up to the rest."""
        number_of, known = self.numbers, self.words
        self.before.extend(range(len(self.runs), len(self.runs) + before))
        for word in words:
            number = number_of.get(word)
            if number is None:
                number = number_of[word] = len(known)
                known.append(word)
            self.runs.append(number)
        self.runs.append(0)

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: the word numbers, first places, counts of distinct phrases."""
        flat = np.array(self.runs, np.uint64)
        own = flat > 0
        own[self.before] = False
        key, whole = flat, flat > 0
        for length in range(1, LONGEST + 1):
            if length > 1:
                key = (key[:-1] << NUMBER_BITS) | flat[length - 1 :]
                whole = whole[:-1] & (flat[length - 1 :] > 0)
            places = np.flatnonzero(whole & own[length - 1 :])
            _, first, counts = np.unique(key[places], return_index=True, return_counts=True)
            yield length, flat, places[first], counts

    def hashes(self, length: int, flat: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A hash of language and words for the phrases that start at the places."""
        if not hasattr(self, "_own"):
            self._own = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        value = np.full(len(places), xxhash.xxh3_64_intdigest(self.lang.encode()) + length & (1 << 64) - 1, np.uint64)
        for step in range(length):
            value = (value ^ self._own[flat[places + step]]) * MIX[0]
            value = (value ^ (value >> np.uint64(29))) * MIX[1]
            value ^= value >> np.uint64(32)
        return value


def blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_WORDS) -> Iterator[Block]:
    """Blocks of the rows (text, lang). All open blocks together hold at most about ``most`` words;
    a piece longer than that goes on in the next block, led up to by its last words."""
    held: dict[str, Block] = {}
    total = 0
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for piece in (text or "").encode("utf-8").lower().translate(BREAKS).split(b"\n"):
                words = piece.split()
                for start in range(0, len(words), most):
                    first = max(start - LONGEST + 1, 0)
                    held.setdefault(lang, Block(lang)).add(words[first : start + most], start - first)
                    total += min(len(words) - start, most)
                    if total >= most:
                        yield from held.values()
                        held, total = {}, 0
    yield from held.values()


def partition_of(hashes: np.ndarray, partitions: int) -> np.ndarray:
    """The partition by the upper half of a hash; the lower half is its key there."""
    return ((hashes >> np.uint64(32)) * np.uint64(partitions)) >> np.uint64(32)


def bit_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(bits)) >> np.uint64(32)


def summaries(batches: Iterator[pa.RecordBatch], partitions: int) -> Iterator[pa.RecordBatch]:
    """Exact counts of a block by partition, keys that occur once apart from the others."""
    for block in blocks(batches):
        parts = [(block.hashes(length, flat, places), counts) for length, flat, places, counts in block.phrases()]
        hashes, counts = (np.concatenate(column) for column in zip(*parts, strict=True))
        home = partition_of(hashes, partitions)
        order = np.lexsort((counts > 1, home))
        home, keys, counts = home[order], hashes[order].astype(np.uint32), counts[order].astype(np.int64)
        edges = np.flatnonzero(np.diff(home, prepend=-1, append=-1))
        rows: tuple[list, ...] = ([], [], [], [])
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            middle = start + int((counts[start:end] == 1).sum())
            for column, value in zip(
                rows, (int(home[start]), keys[start:middle].tobytes(), keys[middle:end].tobytes(), counts[middle:end].tobytes())
            ):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int64()), *(pa.array(column, pa.binary()) for column in rows[1:])],
            names=["part", "once", "more", "counts"],
        )


def merged(
    one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], capacity: int
) -> tuple[np.ndarray, np.ndarray]:
    """Two Misra-Gries summaries as one: counters are added, then all fall by the first counter
    beyond the capacity, and those not above zero go."""
    keys, place = np.unique(np.concatenate([one[0], other[0]]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, place, np.concatenate([one[1], other[1]]))
    if len(keys) > capacity:
        counts = counts - np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def survivors(blocks_of_part: list[tuple[np.ndarray, np.ndarray]], least: int) -> np.ndarray:
    """Keys that may occur ``least`` times or more in the partition.

    With mass m and capacity c = m // least + 1, all falls together are at most m / (c + 1),
    which is less than ``least``: a key as frequent as that keeps a counter. A counter plus the
    falls bounds a key's count from above, so keys bounded below ``least`` are left out.
    """
    mass = sum(int(counts.sum()) for _, counts in blocks_of_part)
    capacity = mass // least + 1
    held = (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    # Merged like a tree, so that every key is sorted a logarithmic number of times.
    waiting = list(blocks_of_part)
    while len(waiting) > 1:
        waiting = [merged(*pair, capacity) if len(pair) == 2 else pair[0] for pair in (waiting[at : at + 2] for at in range(0, len(waiting), 2))]
    held = merged(held, waiting[0], capacity) if waiting else held
    # Falls of one merge take at least (capacity + 1) times as much mass as they lower a counter.
    most_fallen = (mass - int(held[1].sum())) // (capacity + 1)
    return held[0][held[1] + most_fallen >= least]


def phrase_filter(texts: DataFrame, least: int) -> tuple[int, np.ndarray]:
    """Number of hash partitions and, by partition, the bits of the keys that survive."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(1, -(-int(size) // PARTITION_BYTES))
    bits = max(8, FILTER_BITS // partitions // 8 * 8)

    def merge(table: pa.Table) -> pa.Table:
        found = []
        for once, more, counts in zip(*(table.column(name).to_pylist() for name in ("once", "more", "counts")), strict=True):
            keys = np.frombuffer(once + more, np.uint32)
            weights = np.ones(len(keys), np.int64)
            weights[len(once) // 4 :] = np.frombuffer(counts, np.int64)
            found.append((keys, weights))
        marks = np.zeros(bits, np.uint8)
        marks[bit_of(survivors(found, least), bits)] = 1
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([np.packbits(marks).tobytes()], pa.binary())})

    dealt = texts.mapInArrow(
        lambda batches: summaries(batches, partitions), "part long, once binary, more binary, counts binary"
    )
    slices = dealt.groupBy("part").applyInArrow(merge, "part long, bits binary")
    held = np.zeros((partitions, bits // 8), np.uint8)
    for part, marks in slices.collect():  # slices of one filter of fixed size
        held[part] = np.frombuffer(marks, np.uint8)
    return partitions, held


def exact_counts(texts: DataFrame, least: int) -> DataFrame:
    """(lang, words, phrase, count): phrases that occur ``least`` times or more, and for every
    language one row with zero words and the number of all words."""
    partitions, held = phrase_filter(texts, least)
    shipped = texts.sparkSession.sparkContext.broadcast(held)
    bits = held.shape[1] * 8

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shipped.value
        for block in blocks(batches):
            langs, sizes, names, numbers = [block.lang], [0], [b""], [0]
            for length, flat, places, counts in block.phrases():
                if length == 1:
                    numbers[0] = int(counts.sum())
                hashes = block.hashes(length, flat, places)
                spot = bit_of(hashes.astype(np.uint32), bits)
                byte = marks[partition_of(hashes, partitions), spot >> np.uint64(3)]
                passed = np.flatnonzero((byte >> (7 - (spot & np.uint64(7))).astype(np.uint8)) & 1)
                starts = places[passed]
                columns = [map(block.words.__getitem__, flat[starts + step].tolist()) for step in range(length)]
                names.extend(map(b" ".join, zip(*columns, strict=True)))
                numbers.extend(counts[passed].tolist())
                sizes.extend([length] * len(passed))
            langs *= len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()),
                    pa.array(sizes, pa.int32()),
                    pa.array(names, pa.binary()).cast(pa.string()),
                    pa.array(numbers, pa.int64()),
                ],
                names=["lang", "words", "phrase", "count"],
            )

    counted = texts.mapInArrow(count, "lang string, words int, phrase string, count long")
    total = counted.groupBy("lang", "words", "phrase").agg(F.sum("count").alias("count"))
    return total.where((F.col("count") >= least) | (F.col("words") == 0))


def _part(phrase: str, first: int, last: int) -> Column:
    return F.array_join(F.slice(F.split(F.col(phrase), " "), first, last - first + 1), " ")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts below 10^16."""
    wide = [number.cast("decimal(19,0)") for number in (a, left, right)]
    above = (wide[0] * wide[0]).cast("decimal(32,0)") * F.lit(1000000).cast("decimal(7,0)")
    return F.call_function("div", above, (wide[1] * wide[2]).cast("decimal(38,0)")).cast("long")


def collocations(
    documents: DataFrame, column: str = "text", lang: str = "lang", least: int = LEAST_COUNT, top: int = PHRASES_PER_LANG
) -> DataFrame:
    """The firmest phrases of 2 to 3 words of every language.

    Columns: lang, rank, phrase, a, l, r, n, score, as described at the top of the contract:
    a the phrase's occurrences, l and r those of the parts of its worst cut, n the language's
    words. A null language is ``und``; null and empty texts hold no words; repeated rows count
    each time; other columns of ``documents`` do not matter. An empty table gives no rows. Ties
    of the score are ordered by count, then by the phrase's bytes, so the result is one only.

    Two passes over the texts, one shuffle of 4-byte keys, one of phrases that passed the
    filter. Partial sums keep frequent phrases from piling up in a task; look-ups of parts are
    dealt to slices, as one word may be part of very many phrases.
    """
    spark: SparkSession = documents.sparkSession
    small_batches(spark)
    texts = documents.select(
        F.col(column).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang")
    )
    counted = checkpointed(exact_counts(texts, least))
    found = counted.where("words > 1").select("lang", "words", "phrase", F.col("count").alias("a"))
    cuts = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    halves = found.select("*", cuts.alias("cut")).select(
        "*",
        F.explode(F.array(
            F.struct(F.lit(True).alias("left"), _part("phrase", F.lit(1), F.col("cut")).alias("part")),
            F.struct(F.lit(False).alias("left"), _part("phrase", F.col("cut") + 1, F.col("words")).alias("part")),
        )).alias("half"),
    )
    dealt = halves.select(
        "lang", "words", "phrase", "a", "cut", "half.left", "half.part",
        F.pmod(F.xxhash64("phrase"), F.lit(LOOKUP_SLICES)).cast("int").alias("slice"),
    )
    copies = counted.where("words between 1 and 2").select(
        "lang", F.col("phrase").alias("part"), "count", F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SLICES - 1))).alias("slice")
    )
    looked_up = dealt.join(copies, ["lang", "part", "slice"])
    # Two-word parts of longer phrases tell at once how often they lie inside one.
    inside = looked_up.where("words > 2 and part like '% %'").groupBy("lang", F.col("part").alias("phrase")).agg(
        F.max("a").alias("inside")
    )
    cut = looked_up.groupBy("lang", "words", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("left"), F.col("count"))).alias("l"), F.max(F.when(~F.col("left"), F.col("count"))).alias("r")
    )
    worst = (
        cut.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
        .groupBy("lang", "words", "phrase", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
        .select("lang", "words", "phrase", "a", "worst.l", "worst.r", "worst.score")
    )
    free = worst.join(inside, ["lang", "phrase"], "left").where(
        F.col("inside").isNull() | (F.col("inside") * 100 < F.col("a") * PART_PERCENT)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counted.where("words = 0").select("lang", F.col("count").alias("n"))
    return best.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, row_number() OVER () AS piece, words
  FROM (SELECT lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\\x0A-\\x0D]')) AS line FROM documents),
       LATERAL (SELECT regexp_extract_all(line, '[^\\x20\\x09]+') AS words)
), tokens AS (
  SELECT lang, piece, unnest(words) AS w, generate_subscripts(words, 1) AS place FROM pieces
), runs AS (
  SELECT lang, w AS w1, lead(w) OVER follow AS w2, lead(w, 2) OVER follow AS w3
  FROM tokens WINDOW follow AS (PARTITION BY lang, piece ORDER BY place)
), one AS (SELECT lang, w1 AS p, count(*) AS f FROM runs GROUP BY ALL),
two AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS p, count(*) AS f FROM runs WHERE w2 IS NOT NULL
        GROUP BY ALL HAVING count(*) >= {LEAST_COUNT}),
three AS (SELECT lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 AS p, count(*) AS f FROM runs WHERE w3 IS NOT NULL
          GROUP BY ALL HAVING count(*) >= {LEAST_COUNT}),
cuts AS (
  SELECT two.lang, two.p, two.f AS a, 1 AS k, x.f AS l, y.f AS r FROM two
  JOIN one x ON x.lang = two.lang AND x.p = two.w1 JOIN one y ON y.lang = two.lang AND y.p = two.w2
  UNION ALL
  SELECT t.lang, t.p, t.f, 1, x.f, y.f FROM three t
  JOIN one x ON x.lang = t.lang AND x.p = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.p, t.f, 2, x.f, y.f FROM three t
  JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.p = t.w3
), scored AS (
  SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inside AS (
  SELECT lang, p, max(f) AS f FROM (
    SELECT lang, w1 || ' ' || w2 AS p, f FROM three UNION ALL SELECT lang, w2 || ' ' || w3, f FROM three)
  GROUP BY ALL
), ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.p) AS place
  FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.p = w.p
  WHERE i.f IS NULL OR 100 * i.f < {PART_PERCENT} * a
)
SELECT lang, place::BIGINT AS rank, p AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       total::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN (SELECT lang, sum(f) AS total FROM one GROUP BY lang) USING (lang)
WHERE place <= {PHRASES_PER_LANG}
"""
