"""Benchmark decontamination with a generalised suffix automaton over words.

All normalised benchmark items go into one suffix automaton. A document's words are streamed
through it, tracking the length of the longest match that ends at each word. Every match of
``window`` words, and every whole item shorter than that, is an occurrence; the words it
covers are hit. A document whose hit words reach the coverage limit is contaminated, and its
spans of hit words are reported so that they can be removed.

Automata are built in tasks, from shares of the benchmark with a bounded number of words, and
packed into arrays. The driver passes them on one at a time.

Words outside the benchmark's vocabulary and neighbouring words that are neighbours in no item
break every match, so only runs of known neighbours, found with array operations, are streamed.
"""

from __future__ import annotations

import pickle
import re
from array import array
from collections.abc import Iterable
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.common import added, checkpointed, shielded, text_pass

WINDOW = 13
# A document is contaminated when at least one word in this many is hit.
COVERAGE = 20
# Words that a span of a document under the coverage limit may have.
LONGEST_SPAN = 26
# Words of benchmark text that one automaton is meant to hold; larger benchmarks are dealt over
# several automata, each of which sees all documents. A task takes about 650 bytes a word to build
# one and 150 to hold it.
AUTOMATON_WORDS = 500_000
_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Word bytes: digits, ASCII letters (lower-cased) and everything beyond ASCII.
_FOLD = bytes(
    byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A else byte + 32 if 0x41 <= byte <= 0x5A else 0x20
    for byte in range(256)
)


def folded(text: str) -> bytes:
    """Text as lower-cased words between blanks; its length in bytes does not change."""
    return text.encode("utf-8").translate(_FOLD)


def _window_state(state: int, link: list[int] | array, length: list[int] | array, window: int) -> int:
    """The state that holds the last ``window`` words of a longer match."""
    while length[link[state]] >= window:
        state = link[state]
    return state


class Automaton:
    """A suffix automaton of several word sequences with the windows that end in its states."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.items = [item for item, _ in items]
        self.word_ids: dict[bytes, int] = {}
        sequences = [[self.word_ids.setdefault(word, len(self.word_ids)) for word in words] for _, words in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = [self._add(sequence) for sequence in sequences]
        self.shortest = min((min(window, len(sequence)) for sequence in sequences if sequence), default=0)
        pairs = {first * len(self.word_ids) + second for sequence in sequences for first, second in pairwise(sequence)}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self._mark(sequences, ends)

    def _add(self, sequence: list[int]) -> list[int]:
        """Add one sequence; the state of its prefix after each word."""
        last, states = 0, []
        for word in sequence:
            last = self._extend(last, word)
            states.append(last)
        return states

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(following)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """A copy of ``child`` for the shorter matches that come from ``parent``."""
        copy = self._state(self.length[parent] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        state = self._state(self.length[last] + 1, {}, 0)
        parent = last
        while parent >= 0 and word not in self.next[parent]:
            self.next[parent][word] = state
            parent = self.link[parent]
        if parent >= 0:
            child = self.next[parent][word]
            self.link[state] = child if self.length[child] == self.length[parent] + 1 else self._split(parent, word, child)
        return state

    def _mark(self, sequences: list[list[int]], ends: list[list[int]]) -> None:
        """Items by the state of their windows, and whole short items by their state."""
        self.windows: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, sequence in enumerate(sequences):
            if 0 < len(sequence) < self.window:
                state = self._walk(sequence)
                self.short.setdefault(state, []).append((len(sequence), item))
                continue
            for end in range(self.window, len(sequence) + 1):
                state = _window_state(ends[item][end - 1], self.link, self.length, self.window)
                self.windows.setdefault(state, set()).add(item)

    def _walk(self, sequence: list[int]) -> int:
        state = 0
        for word in sequence:
            state = self.next[state][word]
        return state

    def packed(self) -> bytes:
        """What ``Matcher`` needs, in arrays: transitions are numbered state * words + word."""
        moves = [(state * len(self.word_ids) + word, to) for state, following in enumerate(self.next) for word, to in following.items()]
        codes, targets = (np.fromiter((move[place] for move in moves), np.int64, len(moves)) for place in (0, 1))
        arrays = (codes, targets.astype(np.int32), *(np.array(one, np.int32) for one in (self.link, self.length)))
        held = (self.items, b" ".join(self.word_ids), self.window, self.shortest, self.pairs, self.windows, self.short)
        return pickle.dumps((arrays, held), protocol=pickle.HIGHEST_PROTOCOL)


class Matcher:
    """Matches of documents in a packed automaton."""

    def __init__(self, packed: bytes):
        (codes, targets, link, length), held = pickle.loads(packed)
        self.items, words, self.window, self.shortest, self.pairs, self.windows, self.short = held
        self.word_ids = {word: number for number, word in enumerate(words.split())}
        self.moves = dict(zip(codes.tolist(), targets.tolist(), strict=True))
        self.link, self.length = array("i", link.tobytes()), array("i", length.tobytes())
        self._short_above: dict[int, list[tuple[int, int]]] = {}

    def _shorts(self, state: int) -> list[tuple[int, int]]:
        """Whole short items that end wherever this state's match ends: (words, item)."""
        path = []
        while state >= 0 and state not in self._short_above:
            path.append(state)
            state = self.link[state]
        found = self._short_above[state] if state >= 0 else []
        for state in reversed(path):
            found = [*found, *self.short[state]] if state in self.short else found
            self._short_above[state] = found
        return found

    def _runs(self, ids: np.ndarray) -> Iterable[tuple[int, int]]:
        """Stretches of known words that are neighbours in some item, long enough to matter."""
        if not self.shortest or len(ids) < self.shortest:
            return ()
        joined = np.zeros(len(ids) + 1, bool)  # joined[i]: word i continues word i - 1
        if len(self.pairs):
            codes = ids[:-1] * len(self.word_ids) + ids[1:]
            at = np.searchsorted(self.pairs, codes)
            found = self.pairs[np.minimum(at, len(self.pairs) - 1)] == codes
            joined[1:-1] = found & (ids[:-1] >= 0) & (ids[1:] >= 0)
        starts = np.flatnonzero((ids >= 0) & ~joined[:-1])
        stops = np.flatnonzero((ids >= 0) & ~joined[1:]) + 1
        kept = stops - starts >= self.shortest
        return zip(starts[kept].tolist(), stops[kept].tolist(), strict=True)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans (first word, word after the last) in order, joined, and the items found."""
        known, moves, width = self.word_ids.get, self.moves, len(self.word_ids)
        ids = np.fromiter((known(word, -1) for word in words), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for start, stop in self._runs(ids):
            state = length = 0
            for at, word in enumerate(ids[start:stop].tolist(), start + 1):
                to = moves.get(state * width + word)
                while state and to is None:
                    state = self.link[state]
                    length = self.length[state]
                    to = moves.get(state * width + word)
                if to is not None:
                    state, length = to, length + 1
                reach = 0
                if length >= self.window:
                    items |= self.windows[_window_state(state, self.link, self.length, self.window)]
                    reach = self.window
                for size, item in self._shorts(state):
                    if size <= length:
                        items.add(item)
                        reach = max(reach, size)
                if reach:
                    first = at - reach
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, at))
        return spans, items


FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
)


def _automata(benchmark: DataFrame, window: int, limit: int) -> tuple[DataFrame, int]:
    """Packed automata (share, packed), kept in the checkpoint folder, and the number of shares.

    Repeated items go first. Items are dealt to shares by a hash, so a share has about ``limit``
    words or less, more only where an item alone is longer.
    """
    item, n_words = F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.regexp_count("text", F.lit(_WORDS))
    items = benchmark.select(item.alias("item"), "text").where(n_words > 0).distinct()
    total = items.agg(F.sum(n_words.cast("long"))).first()[0] or 0
    shares = max(1, -(-total // limit))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sequences = [(name, folded(text).split()) for name, text in zip(rows["item"], rows["text"], strict=True)]
        return pd.DataFrame({"share": [key[0]], "packed": [Automaton(sequences, window).packed()]})

    dealt = items.withColumn("share", F.pmod(F.xxhash64("item", "text"), F.lit(shares)))
    return checkpointed(dealt.groupBy("share").applyInPandas(build, "share long, packed binary")), shares


def matched(
    df: DataFrame, benchmark: DataFrame, column: str = "text", window: int = WINDOW, limit: int = AUTOMATON_WORDS
) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` and ``hit_items`` to every row.

    Spans are [first word, word after the last], in order, joined where they touch. Null and
    empty texts have no words and no hits; null or wordless benchmark texts match nothing; a
    null item id counts as an empty one; items with equal ids count once. Rows keep their
    number and other columns; columns of these names are replaced. Documents are not shuffled.

    Each automaton is broadcast; ``limit`` bounds its words. A larger benchmark is dealt over
    several automata, and the documents, kept in the checkpoint folder in between, pass through
    one after the other, so that a task never holds two.
    """
    automata, shares = _automata(benchmark, window, limit)
    result = None
    for share in range(shares):
        found = automata.where(F.col("share") == share).select("packed").first()
        if found is not None:
            earlier = None if result is None else checkpointed(result)
            result = _matched_once(df if earlier is None else earlier, bytes(found.packed), column, first=earlier is None)
    return _matched_once(df, Automaton([], window).packed(), column, first=True) if result is None else result


def _matched_once(df: DataFrame, packed: bytes, column: str, first: bool) -> DataFrame:
    shipped = df.sparkSession.sparkContext.broadcast(packed)

    def start():
        automaton = Matcher(shipped.value)

        def work(texts: list[str | None]) -> list:
            counts, spans, items = [], [], []
            for text in texts:
                words = folded(text).split() if text else []
                hit, found = automaton.scan(words)
                counts.append(len(words))
                spans.append([list(span) for span in hit])
                items.append(sorted({automaton.items[item] for item in found}))
            return [counts, spans, items]

        return work

    if first:
        return text_pass(df, column, FIELDS, start)
    earlier = df.withColumnsRenamed({"hit_spans": "_spans", "hit_items": "_items"}).drop("n_words")
    both = text_pass(earlier, column, FIELDS, start)
    return (
        both.withColumn("hit_items", F.array_sort(F.array_union("hit_items", "_items")))
        .withColumn("hit_spans", merged_spans(F.concat("hit_spans", "_spans")))
        .drop("_spans", "_items")
    )


def merged_spans(spans):
    """Spans sorted and joined where they touch."""

    def add(done, span):
        last = F.element_at(done, -1)
        touching = (F.size(done) > 0) & (F.try_element_at(F.try_element_at(done, F.lit(-1)), F.lit(2)) >= span[0])
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.array(last[0], F.greatest(last[1], span[1]))))
        return F.when(touching, grown).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<array<bigint>>"), add)


def contamination(
    df: DataFrame, benchmark: DataFrame, column: str = "text", window: int = WINDOW, coverage: int = COVERAGE, limit: int = AUTOMATON_WORDS
) -> DataFrame:
    """``matched`` with ``n_hit`` (hit words) and ``contaminated`` (hit words reach one in
    ``coverage``)."""
    rows = matched(df, benchmark, column, window, limit)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, span: total + span[1] - span[0])
    rows = added(rows, ["n_hit", "contaminated"]).withColumn("n_hit", hit)
    return rows.withColumn("contaminated", F.expr(f"n_hit > 0 and {coverage} * n_hit >= n_words"))


def clean_only(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns and whole texts."""
    return shielded(documents, "text", lambda rows: contamination(rows, benchmark).where("not contaminated"))


_WORD = re.compile(rb"[^ ]+")


def without_spans(df: DataFrame, column: str = "text", spans: str = "hit_spans") -> DataFrame:
    """The texts with the words of their hit spans cut out, from the first byte of a span's
    first word to the last byte of its last word; texts without spans stay as they are."""

    def cut(text: str | None, hit: list | None) -> str | None:
        if not text or not hit:
            return text
        data, places, at, parts = text.encode("utf-8"), [found.span() for found in _WORD.finditer(folded(text))], 0, []
        for first, stop in hit:
            parts.append(data[at : places[first][0]])
            at = places[stop - 1][1]
        return b"".join([*parts, data[at:]]).decode("utf-8")

    fields = T.StructType([T.StructField(column, T.StringType())])
    return text_pass(df, column, fields, lambda: lambda texts, hits: [list(map(cut, texts, hits))], (spans,))


def spans_removed(
    documents: DataFrame, benchmark: DataFrame, longest: int = LONGEST_SPAN, coverage: int = COVERAGE
) -> DataFrame:
    """All documents, with the spans cut out that are over a limit: every span of a document
    whose hit words reach one in ``coverage``, and spans of more than ``longest`` words in others.
    Null texts stay null, rows and all other columns stay as they are."""

    def work(rows: DataFrame) -> DataFrame:
        marked = contamination(rows, benchmark, coverage=coverage)
        long = F.filter("hit_spans", lambda span: span[1] - span[0] > longest)
        return without_spans(marked.withColumn("hit_spans", F.when(F.col("contaminated"), F.col("hit_spans")).otherwise(long)))

    return shielded(documents, "text", work)


def contamination_digests(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contamination of every document with a digest of the items found."""
    rows = contamination(documents.select("doc_id", "text"), benchmark)
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
