"""Helpers of the training-data operators: passes over texts, checkpoints, linked groups."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows and characters that one output batch of a text pass holds at most (a single text may
# be longer). Batches only bound memory; results do not depend on them.
BATCH_ROWS = 500
BATCH_CHARS = 1_000_000
# Rows and bytes that Spark hands to Python at a time. With its defaults (10,000 rows, 64 MB)
# the batches on both sides of the pipe outgrow small executors.
SENT_ROWS, SENT_BYTES = 1_000, 4_000_000
# Slices that the rows of one group are dealt to before its first ones are found.
SLICES = 16


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names compare without case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def added(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add: the operator's win."""
    clashing = {name.lower() for name in names}
    return df.drop(*[df[column] for column in df.columns if column.lower() in clashing])


def small_batches(spark: SparkSession) -> None:
    """Hand bounded batches to Python; a session that asks for smaller ones keeps them."""
    for name, most in (("maxRecordsPerBatch", SENT_ROWS), ("maxBytesPerBatch", SENT_BYTES)):
        setting = f"spark.sql.execution.arrow.{name}"
        now = _number(str(spark.conf.get(setting)))
        if now is None or not 0 < now <= most:
            spark.conf.set(setting, str(most))


def _number(setting: str) -> int | None:
    """A number, or a size such as ``64m``; None for anything else."""
    found = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", setting.lower())
    return int(found[1]) * 1024 ** (" kmgtp".index(found[2] or " ")) if found else None


def text_pass(
    df: DataFrame, column: str, fields: T.StructType, start: Callable[[], Callable], beside: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``fields`` computed from whole texts, one narrow pass without a shuffle.

    ``start`` runs once per task and returns a function from a list of texts (None for null),
    and one list for each column of ``beside``, to one sequence per field. Columns of ``df``
    named like a field are replaced, all others are passed on.
    """
    small_batches(df.sparkSession)
    read, source = column, df
    if column.lower() in (name.lower() for name in fields.fieldNames()):
        read = fresh(df, "_text")
        source = df.withColumn(read, F.col(column))
    rest = added(source, fields.fieldNames())
    carried = [name for name in rest.columns if name != read or read == column]
    schema = T.StructType([*(rest.schema[name] for name in carried), *fields.fields])
    arrow_fields = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in _parts(batch, read):
                results = work(*(part.column(name).to_pylist() for name in (read, *beside)))
                arrays = [part.column(name) for name in carried]
                arrays += [
                    values if isinstance(values, pa.Array) else pa.array(values, field.type)
                    for values, field in zip(results, arrow_fields, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[*carried, *arrow_fields.names])

    return rest.mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded number of rows and text bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if row > start and (held + size > BATCH_CHARS or row - start >= BATCH_ROWS):
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def first_places(df: DataFrame, group: list[str], order: list[str], count: int, name: str) -> DataFrame:
    """The first ``count`` rows of every group by ``order``, with their place from 1 as ``name``.

    Every group is dealt to slices by a hash of its order columns, and a slice hands on ``count``
    rows. So the task that ranks a group reads ``SLICES`` times ``count`` rows at most, however
    many rows and tasks feed it. Rows that agree in all of ``order`` share a slice.
    """
    dealt, ahead = fresh(df, "_slice"), fresh(df, "_ahead")
    sliced = df.withColumn(dealt, F.pmod(F.xxhash64(*order), F.lit(SLICES)))
    inside = F.row_number().over(Window.partitionBy(*group, dealt).orderBy(*order))
    handed = sliced.withColumn(ahead, inside).where(F.col(ahead) <= count).drop(dealt, ahead)
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return handed.withColumn(name, place).where(F.col(name) <= count)


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """Make sure checkpoints work: the folder of ``spark.checkpoint.dir``, else (local runs
    such as tests) a temporary one. A cluster must name a folder all executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="tillmark-llm-")
        context.setCheckpointDir(folder)
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    with_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def components(edges: DataFrame) -> DataFrame:
    """Connected groups of an undirected graph: (node, root), root the smallest node reached.

    ``edges`` has the columns (a, b), longs without nulls; the result has one row for every
    node that some edge between different nodes names. Alternates the two star rules of Kiveris
    et al. ("Connected Components in MapReduce and Beyond", 2014): every node's larger
    neighbours are hung on its smallest one, then every node's smaller neighbours are hung
    together, until nothing changes. Hubs are never gathered: minima are combined before the
    shuffle, and the joins can be split by adaptive execution.
    """
    stars = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(stars)
    while True:
        stars = checkpointed(_hung_small(_hung_large(stars)))
        now = _mark(stars)
        if now == mark:
            break
        mark = now
    roots = stars.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.union(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _mark(stars: DataFrame) -> tuple:
    """A digest of the edge set: its size and two order-free sums of row hashes."""
    half = F.xxhash64("a", "b")
    sums = [F.sum(F.shiftright(half, 32)), F.sum(half.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))]
    return tuple(stars.agg(F.count(F.lit(1)), *sums).first())


def _hung_large(stars: DataFrame) -> DataFrame:
    both = stars.union(stars.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    hung = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.where("a <> b").distinct()


def _hung_small(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    hung = stars.join(least, F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)


def span_rows(spans: list[tuple[str, int, int]]) -> list[dict]:
    """Spans as rows of ``SPANS``."""
    return [dict(zip(("kind", "start", "end"), span, strict=True)) for span in spans]


def joined_spans(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda one: F.concat_ws(":", one["kind"], one["start"], one["end"])), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda one: one["kind"] == kind)).cast("long")


def shielded(df: DataFrame, column: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` done on rows of ``df``, which keep exactly their columns: whatever names the
    operator adds, no column but ``column`` can clash with them."""
    hidden = [column if name == column else f"_own_{place}" for place, name in enumerate(df.columns)]
    done = work(df.toDF(*hidden))
    return done.select(*[F.col(inner).alias(name) for inner, name in zip(hidden, df.columns, strict=True)])
