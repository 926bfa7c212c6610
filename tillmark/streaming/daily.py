"""The daily price fact kept up to date batch by batch, in buckets of products.

``last`` holds the last trusted observation of every product, ``rows`` the daily fact. Rows
that come after their product's last observation look back to it, and are added to their bucket. A
product with a row at or before its last observation is late: the row that follows it must look
back to it now, so the stored rows of its bucket are ordered anew with the fresh ones and the
bucket is replaced. Whole rows travel once, to the task that writes them (``operators/pieces.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillmark.operators.pieces import CARRIED, PIECE_ROWS, cuts, with_value_before
from tillmark.operators.quality import trusted
from tillmark.plans.marts import DAILY_COLUMNS, DAILY_INPUTS, daily_inputs, with_daily_columns
from tillmark.sources import parted
from tillmark.sources.tables import read_table_stream
from tillmark.streaming.late import late_keys
from tillmark.streaming.runs import run_batches

KEY, DAY, PRICE = "product_sk", "snapshot_date", "price_aud"
# What is read of the price fact.
INPUTS = (*DAILY_INPUTS, "is_quarantined")
BUCKETS = 64


def run_daily(
    spark: SparkSession,
    fact: str,
    schema: T.StructType,
    daily: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Bring the daily fact at ``daily`` up to date with the stored price fact."""

    def update(batch: DataFrame, number: int) -> None:
        bring_up_to_date(batch, daily, number, buckets)

    return run_batches(read_table_stream(spark, fact, schema, files_per_batch), update, checkpoint)


def bring_up_to_date(batch: DataFrame, daily: str, number: int, buckets: int = BUCKETS, piece_rows: int = PIECE_ROWS) -> None:
    spark, part = batch.sparkSession, parted.bucket([KEY], buckets)
    rows, lasts, cut = (f"{daily}/{name}" for name in ("rows", "last", "cuts"))
    fresh = daily_inputs(trusted(batch))
    schema = stored_schema(batch.schema)
    last_schema = T.StructType([schema[name] for name in (KEY, DAY, PRICE)])
    touched = parted.parts_of(fresh, part)

    last = parted.read(spark, lasts, last_schema, number, touched)
    back = parted.parts_of(late_keys(fresh, last, [KEY], DAY), part)
    # the last observation stands before its product's fresh rows, or all stored ones do
    stored = parted.read(spark, rows, schema, number, back).select(*fresh.columns)
    before = last.where(~part.isin(back)).withColumn(CARRIED, F.lit(True))
    seen = fresh.unionByName(stored).withColumn(CARRIED, F.lit(False)).unionByName(before, allowMissingColumns=True)
    seen = seen.withColumn(parted.PART, part)
    cuts(seen, [KEY, DAY, PRICE], piece_rows).write.mode("overwrite").parquet(cut)
    found = spark.read.parquet(cut)
    changed = with_daily_columns(with_value_before(seen, found, touched, KEY, DAY, PRICE, "prev_day_price")).select(*schema.names)
    parted.store(changed, rows, number, F.concat(part, F.when(part.isin(back), "").otherwise(parted.MORE)), together=True)

    newest = last.unionByName(fresh.select(KEY, DAY, PRICE)).groupBy(KEY).agg(F.max(F.struct(DAY, PRICE)).alias("_newest"))
    parted.store(newest.select(KEY, f"_newest.{DAY}", f"_newest.{PRICE}"), lasts, number, part)
    for path in (rows, lasts):
        parted.tidy(spark, path, number)


def stored_schema(fact: T.StructType) -> T.StructType:
    """Columns of the daily fact, and the source file, which orders rows that are otherwise alike."""
    own = {"retailer_sk": T.StringType(), "date_sk": T.IntegerType(), "price_change_pct": T.DoubleType(), "prev_day_price": fact[PRICE].dataType}
    names = (*DAILY_COLUMNS, "_source_file")
    return T.StructType([T.StructField(name, own[name] if name in own else fact[name].dataType) for name in names])


def current(spark: SparkSession, daily: str, fact_schema: T.StructType) -> DataFrame:
    return parted.read(spark, f"{daily}/rows", stored_schema(fact_schema)).select(*DAILY_COLUMNS)
