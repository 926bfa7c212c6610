"""Byte pair encoding and decoding with forced boundaries.

Two neighbouring symbols that stand side by side in no vocabulary token can never end up in
one token: every merge that covered both would spell such a token. The place between them is
a certain cut. Texts are cut at pre-token borders and at all certain cuts, the fragments are
encoded independently of each other and their ids are concatenated, which gives exactly the
ids of the uncut text while each merge only ever sees a short fragment.

The vocabulary is read from a public tokenizer file (``tokenizers`` format) on the driver and
shipped to the tasks; its size is checked first.
"""

from __future__ import annotations

import array
import heapq
import json
import re
import unicodedata
from collections.abc import Callable
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.common import text_pass

WORD_BPE = "word_bpe_49k.json"
# A vocabulary is shipped whole to every executor: refuse files that are no vocabulary.
MAX_VOCABULARY = 2_000_000
# Bytes that one generation of a worker's memory of words, and of one of fragments, may take; two
# generations are held. Remembering only saves work, results do not depend on it.
MEMORY_BYTES = 24_000_000
# What an entry takes besides its text: table slot, two objects' heads, the value.
ENTRY_BYTES = 220
MEMORY_TEXT = 64
# Longer fragments are merged with a heap instead of a scan; the ids are the same.
SHORT_FRAGMENT = 48
# Code points whose letter, number and space classes and case mapping are the same in Python's
# Unicode tables and the tokenizer library's (checked by a test). Texts with other code points
# are normalised and split by the library itself.
SAME_CLASSES = ((0x0000, 0x052F), (0x2010, 0x205E), (0x20A0, 0x20BF), (0x2190, 0x21FF), (0x3041, 0x3096), (0x30A1, 0x30FA))
# Word pattern of the word-level vocabulary, fixed by the file's format.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def same_classes(kind: str) -> str:
    """The code points of ``SAME_CLASSES`` that match a class, as ranges of a character set."""
    member, ranges = regex.compile(kind), []
    for low, high in SAME_CLASSES:
        for point in range(low, high + 1):
            if member.match(chr(point)):
                if ranges and ranges[-1][1] == point - 1:
                    ranges[-1][1] = point
                else:
                    ranges.append([point, point])
    return "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in ranges)


def unusual_text() -> re.Pattern:
    """Finds a code point outside ``SAME_CLASSES``."""
    return re.compile("[^" + "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in SAME_CLASSES) + "]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return [chr(byte) if byte in shown else chr(256 + hidden.index(byte)) for byte in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.text = file.read()
        content = json.loads(self.text)
        model = content["model"]
        if len(model["vocab"]) > MAX_VOCABULARY:
            raise ValueError(f"{path} has {len(model['vocab'])} tokens, more than {MAX_VOCABULARY}")
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids = model["vocab"]
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        pairs = [tuple(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
        self.ranks = {(self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.ids[a + b] for a, b in pairs]
        symbols = byte_symbols()
        self.inner = [self.ids[symbol] for symbol in symbols]
        self.last = [self.ids[symbol + self.suffix] for symbol in symbols]
        self.joined = self._joined()

    def _symbols(self, token: str) -> list[int] | None:
        ends = bool(self.suffix) and token.endswith(self.suffix) and token != self.suffix
        body = token.removesuffix(self.suffix) if ends else token
        names = [*body[:-1], body[-1] + self.suffix] if ends else list(body)
        return [self.ids[name] for name in names] if all(name in self.ids for name in names) else None

    def _joined(self) -> set[tuple[int, int]]:
        """Neighbouring symbols that occur inside some token; all other pairs are certain cuts."""
        return {pair for token in self.ids for pair in pairwise(self._symbols(token) or [])}

    def symbols(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        symbols = [self.inner[byte] for byte in data]
        symbols[-1] = self.last[data[-1]]
        return symbols

    def fragments(self, symbols: list[int]) -> list[list[int]]:
        """The symbols of a word, cut wherever a pair occurs in no token."""
        if self.joined.issuperset(pairwise(symbols)):
            return [symbols]
        cuts = [at for at, pair in enumerate(pairwise(symbols), 1) if pair not in self.joined]
        return [symbols[start:end] for start, end in zip([0, *cuts], [*cuts, len(symbols)], strict=True)]

    def merged(self, symbols: list[int]) -> list[int]:
        """Apply the merges: always the best rank, the leftmost first."""
        if len(symbols) > SHORT_FRAGMENT:
            return self._merged_long(symbols)
        ids, rank_of, none = list(symbols), self.ranks.get, len(self.made)
        ranks = [rank_of(pair, none) for pair in pairwise(ids)]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            ids[at : at + 2] = [self.made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), none)
        return ids

    def _merged_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n steps however long the fragment."""
        ranks, ids = self.ranks, list(symbols)
        following = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        waiting = [(ranks[pair], at, *pair) for at, pair in enumerate(pairwise(ids)) if pair in ranks]
        heapq.heapify(waiting)

        def wait(at: int, other: int) -> None:
            if 0 <= at and other < len(ids) and (rank := ranks.get((ids[at], ids[other]))) is not None:
                heapq.heappush(waiting, (rank, at, ids[at], ids[other]))

        while waiting:
            rank, at, left, right = heapq.heappop(waiting)
            other = following[at]
            if ids[at] != left or other >= len(ids) or ids[other] != right:
                continue
            ids[at], ids[other] = self.made[rank], -1
            following[at] = after = following[other]
            if after < len(ids):
                before[after] = at
            wait(at, after)
            wait(before[at], at)
        return [token for token in ids if token >= 0]


class Memory(dict):
    """Results by word or fragment, in two generations: a full one becomes the old one, and what
    is asked for again moves back. Long words are not kept."""

    def __init__(self, compute: Callable, size: int = MEMORY_BYTES):
        super().__init__()
        self.compute, self.old, self.size, self.held = compute, {}, size, 0

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        if len(word) <= MEMORY_TEXT:
            self.held += ENTRY_BYTES + 4 * len(word)
            if self.held > self.size:
                self.old = dict(self)
                self.clear()
                self.held = 0
            self[word] = value
        return value


# What a worker process has set up, with the broadcast value it was built from. Workers serve
# many tasks, so later tasks find the words of earlier ones.
_PREPARED: dict[str, tuple] = {}


def prepared(shipped, build: Callable):
    """``build`` of a broadcast value, once per worker process."""
    held = _PREPARED.get(build.__name__)
    if held is None or held[0] is not shipped.value:
        held = _PREPARED[build.__name__] = (shipped.value, build(shipped.value))
    return held[1]


class Splitter:
    """Normalises a text and splits it into pre-tokens, as the tokenizer file says.

    Ordinary texts are split by one pattern over fixed character ranges. Texts that hold other
    code points, as given or once normalised, are left to the library's normaliser and
    splitter, whose Unicode tables decide.
    """

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary.text)
        self.unusual = unusual_text()
        letter, number, other = (same_classes(kind) for kind in (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"))
        self.words = re.compile(f"{CONTRACTIONS}|[{letter}]+|[{number}]|[{other}]+")
        symbols = byte_symbols()
        self.bytes = {symbol: byte for byte, symbol in enumerate(symbols)}

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.words.findall(text.lower())
        if self.unusual.search(text):
            return self._by_library(text)
        # The library lower-cases letter by letter, so a final sigma is no special case.
        normal = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # Composing and lower-casing may lead out of the ranges, which the pattern would drop.
        if self.unusual.search(normal):
            return self._by_library(text)
        return self.words.findall(normal)

    def _by_library(self, text: str) -> list[str]:
        normal = self.library.normalizer.normalize_str(text)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.bytes[symbol] for symbol in piece).decode("utf-8") for piece, _ in pieces]


class Encoder:
    """Encodes and decodes texts of one task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = Splitter(vocabulary)
        self.word_ids = Memory(self._word)
        self.fragment_ids = Memory(self._fragment, MEMORY_BYTES // 4)
        self.special = re.compile("|".join(map(re.escape, vocabulary.special)) or r"(?!)")
        by_number = {number: token for token, number in (vocabulary.special | vocabulary.ids).items()}
        self.tokens = [by_number.get(number) for number in range(max(by_number) + 1)]

    def _fragment(self, symbols: tuple[int, ...]) -> bytes:
        return array.array("i", self.vocabulary.merged(symbols)).tobytes()

    def _word(self, word: str) -> bytes:
        parts = self.vocabulary.fragments(self.vocabulary.symbols(word))
        if len(parts) == 1:
            return self._fragment(parts[0])
        return b"".join([self.fragment_ids[tuple(part)] for part in parts])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.word_ids.__getitem__, self.split(text)))

    def encode(self, text: str) -> np.ndarray:
        found, start = [], 0
        for special in self.special.finditer(text):
            found.append(self._plain(text[start : special.start()]))
            found.append(array.array("i", [self.vocabulary.special[special.group()]]).tobytes())
            start = special.end()
        found.append(self._plain(text[start:] if start else text))
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The file names no decoder: tokens are joined by one space, as the library does."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def vocabulary_of(df: DataFrame, path: str):
    """A tokenizer file as a broadcast; ``Vocabulary`` checks its size."""
    return df.sparkSession.sparkContext.broadcast(Vocabulary(path))


FIELDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])


def encoded(df: DataFrame, column: str = "text", path: str = public_tokenizers.path(WORD_BPE)) -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (string) to every row.

    Whole texts are encoded, special token strings inside them become special tokens, nothing
    is added, cut or padded. Null and empty texts give no ids and an empty decoded text. Rows
    keep their number, repeated rows give repeated results, an empty table an empty result.
    Columns named ``ids`` or ``decoded`` are replaced, others are passed on. One narrow pass:
    no shuffle, and a lost executor's tasks simply run again.
    """
    shipped = vocabulary_of(df, path)

    def start():
        encoder = prepared(shipped, Encoder)

        def work(texts: list[str | None]) -> list:
            rows = [encoder.encode(text or "") for text in texts]
            offsets = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(row) for row in rows], out=offsets[1:])
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), [encoder.decode(row) for row in rows]]

        return work

    return text_pass(df, column, FIELDS, start)


def encoding_digests(documents: DataFrame, path: str = public_tokenizers.path(WORD_BPE)) -> DataFrame:
    """Token count and digests of ids and decoded text, one row per document."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded(documents.select("doc_id", "text"), "text", path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
