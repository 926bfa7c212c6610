"""Compression classifier for text quality.

Two zstandard dictionaries are built, one from good and one from bad labelled text. A text is
compressed with both, in blocks of equal size so that long texts lean on the dictionaries as
much as short ones. The difference of the compressed sizes, divided by the text's bytes, says
which dictionary explains it better; a monotone map fitted on other labelled texts turns it
into the share of good texts among those with such a difference.

The classifier is fitted on a bounded sample: ``rows_per_class`` labelled texts of each class
(the smallest by a hash of their id), up to ``bytes_per_text`` of each. Class shares are
counted over all labelled rows, and every text is scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.common import shielded, text_pass

ROWS_PER_CLASS = 3_000
BYTES_PER_TEXT = 8_192
DICTIONARY_BYTES = 65_536
BLOCK = 1_024
LEVEL = 3
THRESHOLD = 0.3
FOLDS = 5


@dataclass(frozen=True)
class Model:
    """Dictionaries by class and the calibrating steps (difference, score), both rising."""

    dictionaries: tuple[bytes, bytes]
    differences: np.ndarray
    scores: np.ndarray

    def score(self, differences: np.ndarray) -> np.ndarray:
        return np.interp(differences, self.differences, self.scores)


class Gauge:
    """Compresses texts with both dictionaries."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        kind = zstandard.DICT_TYPE_FULLDICT
        held = [zstandard.ZstdCompressionDict(data, dict_type=kind) if data else None for data in dictionaries]
        self.compressors = [zstandard.ZstdCompressor(level=LEVEL, dict_data=one, **plain) for one in held]

    def difference(self, data: bytes) -> float:
        """How many bytes fewer, per byte, the good dictionary needs than the bad one."""
        if not data:
            return 0.0
        blocks = [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)]
        bad, good = (sum(len(one.compress(block)) for block in blocks) for one in self.compressors)
        return (bad - good) / len(data)


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.crc32(key.cast("string").cast("binary")) % FOLDS == 0


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of some texts; none if there is too little text to build one from."""
    blocks = [text[at : at + BLOCK] for text in texts for at in range(0, len(text), BLOCK)]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def calibrated(differences: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps from difference to the share of label 1 (pool adjacent violators); one
    row of either label is added at each end, so no score is 0 or 1."""
    order = np.argsort(differences, kind="stable")
    low, high = differences[order][[0, -1]]
    unit = weights.min()
    x = np.r_[low, differences[order], high]
    y = np.r_[1.0, labels[order], 0.0]
    w = np.r_[unit, weights[order], unit]
    pools: list[list[float]] = []
    for place, label, weight in zip(x, y, w, strict=True):
        pools.append([place * weight, label * weight, weight])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    table = np.array(pools)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


def fitted(documents: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """A model of ``labels`` (doc_id, quality) for ``documents`` (doc_id, text).

    Only rows outside the held-out fold are read. Rows without a label of 0 or 1, an id or a
    text teach nothing; an id labelled or stored more than once counts once. Without usable
    rows of both labels every text scores the share of label 1, one half if there is none.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {row.quality: row.n for row in usable.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for quality in (0, 1):
        some = usable.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        picked = some if picked is None else picked.union(some)
    sample = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id")
    once = sample.groupBy("doc_id", "quality").agg(F.min(F.substring("text", 1, BYTES_PER_TEXT)).alias("text"))
    rows = sorted((row.quality, row.doc_id, row.text.encode("utf-8")[:BYTES_PER_TEXT]) for row in once.collect())
    texts = {quality: [text for label, _, text in rows if label == quality] for quality in (0, 1)}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    taught = {quality: some[::2] for quality, some in texts.items()}
    checked = [(text, quality) for quality, some in texts.items() for text in some[1::2]]
    dictionaries = (dictionary(taught[0]), dictionary(taught[1]))
    if not all(dictionaries) or not {0, 1} <= {quality for _, quality in checked}:
        return Model((b"", b""), np.array([0.0]), np.array([share]))
    gauge = Gauge(dictionaries)
    found = np.array([gauge.difference(text) for text, _ in checked])
    marks = np.array([quality for _, quality in checked], float)
    weights = np.where(marks == 1, share / marks.sum(), (1 - share) / (1 - marks).sum())
    return Model(dictionaries, *calibrated(found, marks, weights))


def scored(df: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """Add ``score`` (double, 0 to 1; higher: label 1 is likelier) to every row.

    Texts are compressed whole. Null and empty texts have difference 0 and its score. Rows
    keep their number, repeated rows score alike, an empty table stays empty, a column named
    ``score`` is replaced. One narrow pass without a shuffle; the model is under 200 kB.
    """

    def start():
        gauge = Gauge(model.dictionaries)

        def work(texts: list[str | None]) -> list:
            found = np.array([gauge.difference(text.encode("utf-8") if text else b"") for text in texts], float)
            return [model.score(found)]

        return work

    return text_pass(df, column, T.StructType([T.StructField("score", T.DoubleType())]), start)


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score and decision for every document."""
    rows = scored(documents.select("doc_id", "text"), fitted(documents, labels))
    return rows.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_only(documents: DataFrame, training: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with their own columns."""
    model = fitted(training, labels)
    return shielded(documents, "text", lambda rows: scored(rows, model).where(F.col("score") >= threshold))
