"""Spelling variants: words one edit apart, each led to its much more frequent form.

If two words differ by one edit, one half of either stands unchanged in the other. A query word
is therefore looked up twice: its first half matched exactly and its second half extended with
one error allowed, then its second half exactly and the first half with the error. Both run on a
bidirectional FM-index (Lam et al., 2009) of the vocabulary written out between delimiters: a
pattern is an interval of suffix ranks in the text and one in the reversed text, kept in step,
so the half is matched in one direction and the error searched in the other.

The vocabulary is dealt to indexes by ranges of its sorted words for first halves, and of its
sorted reversed words for second halves. A half is a prefix, so a query goes to the few ranges
that its half reaches into, usually one. Ranges that many queries reach are copied to several
tasks, each with its share of the queries. Pairs are never written out: a task returns, for
every query word, how many near words it found and the most frequent of them.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.common import checkpointed, small_batches

# What a word is and how misspelt ones are made, as the contract states them.
RUNS = re.compile("[a-zÀ-ÿ]+")
DELETE_ONE_IN = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_TIMES = 5
# Different words that a task counts before it hands them on.
COUNTED_WORDS = 200_000
# Words of one index, and queries that one copy of it serves; both bound a task's memory.
INDEX_WORDS = 50_000
TASK_QUERIES = 400_000
# Words per range in the sample that places the borders of ranges.
SAMPLED_PER_RANGE = 48
# Queries that are searched at a time.
SEARCHED = 4_000
END, BORDER = 0, 1


def word_counts(documents: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of the texts, misspelt as the contract says, that occur often enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{'' if number is None else number}:".encode())
                lowered = (text or "").encode("utf-8").lower().decode("utf-8")
                for word, times in Counter(RUNS.findall(lowered)).items():
                    mark = zlib.crc32(word.encode("utf-8"), start)
                    if mark % DELETE_ONE_IN == 0:
                        at = mark % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= LEAST_LETTERS:
                        total[word] += times
                if len(total) >= COUNTED_WORDS:
                    yield _counted(total)
                    total = Counter()
        yield _counted(total)

    found = documents.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"]
    )


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffixes of the text in order, by doubling the length that ranks tell apart."""
    count, bits = len(symbols), int(symbols.max()).bit_length()
    reach = 62 // bits
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(reach, np.int64)])
    key = np.zeros(count, np.int64)
    for step in range(reach):
        key = (key << bits) | padded[step : step + count]
    while True:
        order = np.argsort(key, kind="stable")
        ranks = np.empty(count, np.int64)
        sorted_key = key[order]
        ranks[order] = np.cumsum(np.diff(sorted_key, prepend=sorted_key[0] - 1) != 0) - 1
        if ranks[order[-1]] == count - 1:
            return order
        later = np.zeros(count, np.int64)
        later[: max(count - reach, 0)] = ranks[reach:] + 1
        key = ranks * (count + 1) + later
        reach *= 2


class Direction:
    """Rank tables of a text's Burrows-Wheeler transform: extends patterns to the front."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        order = suffix_order(symbols)
        last = symbols[order - 1]
        blocks = len(symbols) // 64 + 1
        padded = np.full(blocks * 64, kinds, last.dtype)
        padded[: len(last)] = last
        self.bits = np.empty((blocks, kinds), np.uint64)
        for kind in range(kinds):
            self.bits[:, kind] = np.packbits(padded == kind, bitorder="little").view(np.uint64)
        held = np.bitwise_count(self.bits).astype(np.int32)
        self.counts = np.cumsum(held, axis=0, dtype=np.int32) - held
        self.below = np.concatenate([[0], np.cumsum(held.sum(axis=0))[:-1]]).astype(np.int64)
        # Suffixes that begin with a border follow the one that begins with the end mark.
        self.borders = order[1 : 1 + int((symbols == BORDER).sum())]

    def before(self, rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """How often each kind stands in the transform before its row."""
        block = rows >> 6
        mask = (np.uint64(1) << (rows & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[block, kinds] + np.bitwise_count(self.bits[block, kinds] & mask).astype(np.int64)

    def all_before(self, rows: np.ndarray) -> np.ndarray:
        """The same for all kinds at once."""
        block = rows >> 6
        mask = (np.uint64(1) << (rows & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[block] + np.bitwise_count(self.bits[block] & mask[:, None]).astype(np.int64)


class TwoWayIndex:
    """A bidirectional FM-index of different words, searched with one error."""

    def __init__(self, words: list[str]):
        points = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(points)  # the border is below every letter
        kinds = len(self.alphabet) + 1
        symbols = (np.searchsorted(self.alphabet, points) + 1).astype(np.uint8 if kinds < 256 else np.uint32)
        end = np.zeros(1, symbols.dtype)
        borders = np.flatnonzero(symbols == BORDER)
        self.forward = Direction(np.concatenate([symbols, end]), kinds)
        self.backward = Direction(np.concatenate([symbols[::-1], end]), kinds)
        # The word behind a border of the text, and of the reversed text.
        self.forward_words = np.searchsorted(borders, self.forward.borders)
        self.backward_words = np.searchsorted(borders, len(symbols) - 1 - self.backward.borders) - 1

    def _symbols(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts as rows of symbols, a border behind each; unknown letters are kind -1."""
        sizes = np.array([len(part) for part in parts])
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        place = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        known = np.where(self.alphabet[place] == points, place + 1, -1)
        rows = np.full((len(parts), int(sizes.max()) + 1), BORDER, np.int64)
        rows[np.arange(rows.shape[1]) < sizes[:, None]] = known
        return rows, sizes

    def near(self, words: list[str], first_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``words``, number of an indexed word) one edit apart whose named half
        of the query stands unchanged at that end of the indexed word; repeats are left in."""
        halves = [(word[: len(word) // 2], word[len(word) // 2 :]) for word in words]
        if first_half:
            exact, free = [one[::-1] for one, _ in halves], [other for _, other in halves]
            here, there, names = self.forward, self.backward, self.backward_words
        else:
            exact, free = [other for _, other in halves], [one[::-1] for one, _ in halves]
            here, there, names = self.backward, self.forward, self.forward_words
        start, end = self._matched(here, there, exact)
        found = self._with_error(there, start, end, *self._symbols(free))
        return found[0], names[found[1] - 1]

    def _matched(self, here: Direction, there: Direction, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Match parts and their border one way; their intervals the other way."""
        symbols, sizes = self._symbols(parts)
        start = np.zeros(len(parts), np.int64)
        other, held = start.copy(), np.full(len(parts), int(here.counts[-1].sum() + np.bitwise_count(here.bits[-1]).sum()))
        for step in range(symbols.shape[1]):
            live = np.flatnonzero((step <= sizes) & (held > 0))
            kind = symbols[live, step]
            low = here.all_before(start[live])
            count = here.all_before(start[live] + held[live]) - low
            rows, known = np.arange(len(live)), kind >= 0
            lower = np.cumsum(count, axis=1) - count
            start[live] = here.below[kind] + low[rows, kind]
            other[live] += lower[rows, kind]
            held[live] = np.where(known, count[rows, kind], 0)
        return other, other + held

    def _with_error(
        self, way: Direction, start: np.ndarray, end: np.ndarray, symbols: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Extend by the symbols with exactly one letter put in, left out or replaced."""
        queries = np.arange(len(start))
        found: list[tuple[np.ndarray, np.ndarray]] = [(queries[:0], queries[:0])]
        for step in range(symbols.shape[1]):
            live = (start < end) & (step <= sizes[queries])
            queries, start, end = queries[live], start[live], end[live]
            kind, inside = symbols[queries, step], step < sizes[queries]
            low, high = way.all_before(start), way.all_before(end)
            low, high = low + way.below, high + way.below
            row, letter = np.nonzero((high > low)[:, BORDER + 1 :])
            letter += BORDER + 1
            changed = (letter != kind[row]) & inside[row]
            states = [
                (queries[row], np.full(len(row), step), low[row, letter], high[row, letter]),
                (queries[row[changed]], np.full(int(changed.sum()), step + 1), low[row[changed], letter[changed]],
                 high[row[changed], letter[changed]]),
                (queries[inside], np.full(int(inside.sum()), step + 1), start[inside], end[inside]),
            ]
            found.append(self._to_the_end(way, *map(np.concatenate, zip(*states, strict=True)), symbols, sizes))
            goes_on = inside & (kind >= 0)
            rows = np.flatnonzero(goes_on)
            queries, start, end = queries[rows], low[rows, kind[rows]], high[rows, kind[rows]]
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def _to_the_end(
        self, way: Direction, queries: np.ndarray, place: np.ndarray, start: np.ndarray, end: np.ndarray,
        symbols: np.ndarray, sizes: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Match what is left of each query, border included; the border's row tells the word."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(queries):
            kind = symbols[queries, place]
            low = way.below[kind] + way.before(start, kind)
            high = way.below[kind] + way.before(end, kind)
            last = place == sizes[queries]
            live = (high > low) & (kind >= 0)
            done.append((queries[live & last], low[live & last]))
            live &= ~last
            queries, place, start, end = queries[live], place[live] + 1, low[live], high[live]
        return tuple(map(np.concatenate, zip(*done, strict=True))) if done else (queries, start)


def searched(index_words: list[str], index_counts: list[int], queries: list[str], first_half: bool) -> Iterator[tuple]:
    """(word, near words, count and name of the most frequent) of every query, in blocks. Pairs
    with both halves to show for it are told by the first half only."""
    index = TwoWayIndex(index_words)
    # The place of every indexed word when the best form comes first.
    by_rank = sorted(range(len(index_words)), key=lambda at: (-index_counts[at], index_words[at]))
    rank = np.empty(len(by_rank), np.int64)
    rank[by_rank] = np.arange(len(by_rank))
    for at in range(0, len(queries), SEARCHED):
        block = queries[at : at + SEARCHED]
        query, name = index.near(block, first_half)
        pairs = np.unique(query * len(index_words) + rank[name])
        query, place = pairs // len(index_words), pairs % len(index_words)
        if not first_half:
            alone = [
                not index_words[by_rank[one]].startswith(block[word][: len(block[word]) // 2])
                for word, one in zip(query.tolist(), place.tolist(), strict=True)
            ]
            query, place = query[alone], place[alone]
        near = np.bincount(query, minlength=len(block)).tolist()
        best = np.full(len(block), len(by_rank))
        np.minimum.at(best, query, place)
        names = [by_rank[one] if one < len(by_rank) else None for one in best.tolist()]
        yield (
            block,
            near,
            [None if one is None else index_counts[one] for one in names],
            [None if one is None else index_words[one] for one in names],
        )


def _borders(words: DataFrame, ranges: int, total: int) -> tuple[list[str], list[str]]:
    """Borders that cut the sorted words, and the sorted reversed words, into ranges. The sample
    holds a fixed number of words per range, picked by hash."""
    if ranges == 1:
        return [], []
    one_in = max(1, total // (ranges * SAMPLED_PER_RANGE))
    sample = [row[0] for row in words.where(F.pmod(F.xxhash64("word"), F.lit(one_in)) == 0).select("word").collect()]
    cut = [len(sample) * place // ranges for place in range(1, ranges)]
    one, other = sorted(sample), sorted(word[::-1] for word in sample)
    return [one[at] for at in cut], [other[at] for at in cut]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best_n, best) for every row (word, n) of different words; ``best`` is the
    near word of largest n, the smallest of those with the same n."""
    total = words.count()
    ranges = max(1, -(-total // INDEX_WORDS))
    borders = _borders(words, ranges, total)

    def places(word: str) -> Iterator[tuple[int, int, int]]:
        """For either direction: the word's own range, the first and last its half reaches."""
        for side, key, half in ((0, word, word[: len(word) // 2]), (1, word[::-1], word[len(word) // 2 :][::-1])):
            cuts = borders[side]
            ends = bisect.bisect_right(cuts, key), bisect.bisect_right(cuts, half), bisect.bisect_right(cuts, half + "\U0010ffff")
            yield tuple(side * ranges + end for end in ends)

    def dealt(copies: dict[int, int] | None):
        """Rows for the indexes (role 0) and queries (role 1); only the queries without copies."""

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows: tuple[list, ...] = ([], [], [], [], [])
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    mark = zlib.crc32(word.encode("utf-8"))
                    for own, first, last in places(word):
                        out = [(at, mark % (copies or {}).get(at, 1), 1) for at in range(first, last + 1)]
                        if copies is not None:
                            out += [(own, copy, 0) for copy in range(copies.get(own, 1))]
                        for at, copy, role in out:
                            for column, value in zip(rows, (at, copy, role, word, n), strict=True):
                                column.append(value)
                types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(rows, types, strict=True)],
                    names=["place", "copy", "role", "word", "n"],
                )

        return words.select("word", "n").mapInArrow(deal, "place long, copy int, role int, word string, n long")

    load = dealt(None).groupBy("place").count().collect()  # two rows per range at most
    copies = {row["place"]: -(-row["count"] // TASK_QUERIES) for row in load}

    def search(table: pa.Table) -> pa.Table:
        columns = {name: table.column(name).to_pylist() for name in ("role", "word", "n")}
        split = ([], [], [], [])
        for role, word, n in zip(*columns.values(), strict=True):
            split[2 * role].append(word)
            split[2 * role + 1].append(n)
        names, counts, queries, own = split
        out: tuple[list, ...] = ([], [], [], [])
        if names:
            for block in searched(names, counts, queries, table.column("place")[0].as_py() < ranges):
                for column, values in zip(out, block, strict=True):
                    column.extend(values)
        else:
            out = (queries, [0] * len(queries), [None] * len(queries), [None] * len(queries))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(column, kind) for column, kind in zip(out, kinds, strict=True)]
        return pa.table([arrays[0], pa.array(own, pa.int64()), *arrays[1:]], names=["word", "n", "near", "best_n", "best"])

    found = dealt(copies).groupBy("place", "copy").applyInArrow(search, "word string, n long, near long, best_n long, best string")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best")))).alias("best")
    return found.groupBy("word", "n").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.best").alias("best")
    )


def followed(links: DataFrame) -> DataFrame:
    """(word, root): links (word, form) followed to their ends. Every look-up doubles the steps
    taken; counts rise along a chain, so it has no ring and few links."""
    now = checkpointed(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = checkpointed(now.join(ahead, "root", "left"))
        now = after.select("word", F.coalesce("further", "root").alias("root"))
        if after.where("further is not null").isEmpty():
            return now


def spelling_groups(documents: DataFrame, column: str = "text", key: str = "doc_id") -> DataFrame:
    """Every frequent word with its more frequent near form and the last form of that chain.

    Columns: word, form (null if none), root (the word itself if it has no form), n, n_near (0
    if none), form_n (null without form). Near words differ by exactly one letter put in, left
    out or replaced. Null and empty texts hold no words, a null key counts as an empty one when
    words are misspelt, repeated rows count each time, other columns do not matter; an empty
    table gives no rows. Of near words with the same n the first in code-point order is taken.
    """
    small_batches(documents.sparkSession)
    texts = documents.select(F.col(key).alias("key"), F.col(column).cast("string").alias("text"))
    words = checkpointed(word_counts(texts))
    has_form = F.col("best_n") >= F.col("n") * FORM_TIMES
    judged = checkpointed(
        near_words(words).select(
            "word", F.when(has_form, F.col("best")).alias("form"), "n", "n_near", F.when(has_form, F.col("best_n")).alias("form_n")
        )
    )
    roots = followed(judged.where("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
