"""Token counts by the whole-token shortcut.

Most pre-tokens of real text are vocabulary strings. Before the job starts, every vocabulary
string is merged once on the driver; those that come out as exactly one token are proven to
count one. In the tasks a pre-token found in that table costs one look-up, and only the rest is
merged. A vocabulary string that its own merges do not rebuild is not in the table.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.bpe import CONTRACTIONS, MEMORY_BYTES, Memory, Vocabulary, byte_symbols, prepared, same_classes, unusual_text
from tillmark.llm.common import text_pass

BYTE_BPE = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def proven_tokens(vocabulary: Vocabulary) -> frozenset[str]:
    """Vocabulary strings that encode, taken alone, as one token."""
    byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    proven = set()
    for token, number in vocabulary.ids.items():
        data = bytes(byte_of[symbol] for symbol in token)
        try:
            word = data.decode("utf-8")
        except UnicodeDecodeError:
            continue  # a part of a character is never a whole pre-token
        if vocabulary.merged(vocabulary.symbols(word)) == [number]:
            proven.add(word)
    return frozenset(proven)


class Counter:
    """Tokens by pre-token: the proven ones directly, merged others by a bounded memory."""

    def __init__(self, tables: tuple[Vocabulary, frozenset[str]]):
        from tokenizers import Tokenizer

        self.vocabulary, self.proven = tables
        self.library = Tokenizer.from_str(self.vocabulary.text)
        self.unusual = unusual_text()
        letter, number, space = (same_classes(kind) for kind in (r"\p{L}", r"\p{N}", r"\s"))
        other = same_classes(r"[^\s\p{L}\p{N}]")
        self.words = re.compile(
            f"{CONTRACTIONS}| ?[{letter}]+| ?[{number}]+| ?[{other}]+|[{space}]+(?![^{space}])|[{space}]+"
        )
        self.special = re.compile("|".join(map(re.escape, self.vocabulary.special)) or r"(?!)")
        self.byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        self.merged = Memory(self._word)
        self.fragment_counts = Memory(self._fragment, MEMORY_BYTES // 4)

    def _fragment(self, symbols: tuple[int, ...]) -> int:
        return len(self.vocabulary.merged(symbols))

    def _word(self, word: str) -> int:
        parts = self.vocabulary.fragments(self.vocabulary.symbols(word))
        if len(parts) == 1:
            return self._fragment(parts[0])
        return sum([self.fragment_counts[tuple(part)] for part in parts])

    def _plain(self, text: str) -> int:
        if self.unusual.search(text):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(text)
            words = [bytes(self.byte_of[symbol] for symbol in piece).decode("utf-8") for piece, _ in pieces]
        else:
            words = self.words.findall(text)
        rest = [word for word in words if word not in self.proven]
        return len(words) - len(rest) + sum(map(self.merged.__getitem__, rest))

    def count(self, text: str) -> int:
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


def token_counts(df: DataFrame, column: str = "text", path: str = public_tokenizers.path(BYTE_BPE)) -> DataFrame:
    """Add ``n_tokens`` (long), the tokens of each whole text.

    A special token's string inside a text counts as that one token; nothing is added or cut.
    Null and empty texts count zero. Rows keep their number, an empty table stays empty, a
    column named ``n_tokens`` is replaced. One narrow pass without a shuffle. The shipped
    tables are bounded by the vocabulary, whose size is checked when it is read.
    """
    vocabulary = Vocabulary(path)
    shipped = df.sparkSession.sparkContext.broadcast((vocabulary, proven_tokens(vocabulary)))

    def start():
        counter = prepared(shipped, Counter)
        return lambda texts: [[counter.count(text) if text else 0 for text in texts]]

    return text_pass(df, column, T.StructType([T.StructField("n_tokens", T.LongType())]), start)


def document_counts(documents: DataFrame, path: str = public_tokenizers.path(BYTE_BPE), limit: int = TOKEN_LIMIT) -> DataFrame:
    """Bytes and tokens of every document and whether it is over the token limit."""
    return token_counts(documents.select("doc_id", "text"), "text", path).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
