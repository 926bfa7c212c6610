"""One query per operator, each over whole tables. Callables take (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillmark.functions import keys, lists, numbers, text
from tillmark.functions.staged import staged
from tillmark.functions.taxonomy import category_steps
from tillmark.functions.unit_price import with_unit_price
from tillmark.operators import quality
from tillmark.operators.history import HistorySpec, scd2
from tillmark.plans import dimensions, marts
from tillmark.plans.conform import conform, conform_all
from tillmark.plans.daily import DESCRIBED, TIER
from tillmark.plans.fact import fact_price, fact_price_quarantine
from tillmark.registered import inputs
from tillmark.session import shuffles_released, work_folder
from tillmark.sources import files, landing, parted, types
from tillmark.sources.feeds import ALDI, COLES, IGA, WOOLWORTHS, FeedSpec, stored_name
from tillmark.sources.raw_files import list_files, read_feed
from tillmark.sources.tables import catalogue_table, described, read_table_stream
from tillmark.streaming import daily, distinct, history, ingest
from tillmark.streaming import facts as streamed
from tillmark.streaming import landing as landed
from tillmark.streaming import marts as kept
from tillmark.streaming.checked import expectation_log, store_checked
from tillmark.streaming.distinct import run_distinct
from tillmark.streaming.history import run_history
from tillmark.streaming.runs import run_batches

LINE = ("l_orderkey", "l_linenumber")
DAY = date(2021, 4, 23)
# Parts of the bucketed tables: the test tables are small.
BUCKETS = 16
MART_INPUTS = (
    "source_sku", "snapshot_date", "retailer", "canonical_l1", "canonical_l2", "norm_unit_price", "norm_unit_measure",
    "on_special", "availability", "price_aud", "is_quarantined",
)
EVENT_HISTORY = HistorySpec(keys=("user_id",), sequence="ts", tracked=("event_type",), leave_out=("props", "value"))


# ---- standardisation -----------------------------------------------------------------
def unit_price_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = inputs.observations(spark, sf_dir).selectExpr(*LINE, f"{inputs.UNIT_PRICE_TEXT} as cell")
    return with_unit_price(cells, "cell", "unit").select(
        *LINE,
        F.col("unit.value").alias("unit_price_value"),
        F.col("unit.measure").alias("unit_price_measure"),
        F.col("unit.norm_value").alias("norm_unit_price"),
        F.col("unit.norm_measure").alias("norm_unit_measure"),
    )


def price_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = inputs.observations(spark, sf_dir).selectExpr(*LINE, f"{inputs.PRICE_TEXT} as cell")
    return staged(cells, numbers.price_steps(F.col("cell"), "price_aud")).select(*LINE, "price_aud")


def supplier_list_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem")
    cells = lines.selectExpr(*LINE, f"{inputs.SUPPLIERS_TEXT} as cell")
    split = staged(cells, lists.item_steps(F.col("cell"), "separated"))
    listed = split.select(*LINE, "separated", lists.items(F.col("separated")).alias("items"))
    return listed.select(
        *LINE,
        F.size("items").alias("n_suppliers"),
        F.get("items", F.lit(1)).alias("second_supplier"),
        lists.first_item(F.col("separated")).alias("primary_supplier"),
    )


def primary_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = inputs.table(spark, sf_dir, "part").selectExpr("p_partkey", f"{inputs.DEPARTMENT_TEXT} as cell")
    split = staged(cells, lists.department_steps(F.col("cell"), "separated"))
    return split.select("p_partkey", lists.primary_department(F.col("separated")).alias("department"))


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = inputs.table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "case p_type when 'SMALL' then 'big--deals' when 'PROMO' then 'soft-drinks' when 'LARGE' then '' else p_type end"
        " as main",
        "case p_type when 'MEDIUM' then ' Fruit ' when 'PROMO' then 'none known' end as sub",
        "case p_type when 'MEDIUM' then 'freezer' when 'LARGE' then concat(p_size, 'er set') else p_type end as slug",
    )
    labelled = cells.select(
        "p_partkey",
        "sub",
        text.category_label(F.col("main")).alias("label"),
        text.slug_category(F.col("slug")).alias("slug_label"),
    )
    both = category_steps(F.col("label"), F.col("sub"))
    found = staged(labelled, both, category_steps(F.col("slug_label"), prefix="slug"))
    return found.select("p_partkey", "label", "slug_label", "canonical_l1", "canonical_l2", "slug_l1", "slug_l2")


def label_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = inputs.table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        f"{inputs.PACKAGE_SIZE_TEXT} as package",
        f"{inputs.UNIT_SIZE_TEXT} as size",
        "concat(p_name, ' ', p_size, 'gm') as name",
        "concat(p_partkey, '.0') as sku",
    )
    return cells.select(
        "p_partkey",
        text.package_size_label(F.col("package")).alias("package_size"),
        text.unit_size_label(F.col("size")).alias("unit_size"),
        text.repaired_name(F.col("name")).alias("product_name"),
        text.barcode(F.col("sku")).alias("source_sku"),
    )


def brand_and_match_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = inputs.table(spark, sf_dir, "part").selectExpr(
        "p_partkey", f"{inputs.NAME_TEXT} as name", f"{inputs.PACKAGE_SIZE_TEXT} as size"
    )
    branded = cells.select("*", text.leading_brand(F.col("name")).alias("brand"))
    key = text.match_key(F.col("brand"), F.col("name"), F.col("size"))
    return branded.select("p_partkey", "brand", key.alias("brand_product_size"))


def surrogate_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = inputs.table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "p_type",
        "p_brand",
        "concat(' ', initcap(p_name)) as name",
        "case when p_size > 5 then concat('https://shop.example/p/', p_partkey) end as url",
    )
    sku = keys.surrogate_sku(F.lit("Aldi"), F.col("name"), F.col("url"))
    return cells.select("*", sku.alias("source_sku")).select(
        "p_partkey",
        "source_sku",
        keys.hash_key(F.lit("Aldi"), "source_sku").alias("product_sk"),
        keys.hash_key("p_type", "p_brand").alias("category_sk"),
    )


def availability_special_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = inputs.table(spark, sf_dir, "lineitem").selectExpr(
        *LINE,
        "case l_returnflag when 'R' then ' In Stock ' when 'A' then 'SOLD OUT' else nullif(l_linestatus, 'F') end as status",
        "case when l_discount > 0.07D then 'Save $2' when l_linenumber % 3 = 0 then ' No ' else '0' end as special",
        "case when l_linestatus = 'F' then 'false' end as flag",
    )
    return cells.select(
        *LINE,
        text.availability(F.col("status")).alias("availability"),
        text.any_special(F.col("special"), F.col("flag")).alias("on_special"),
    )


# ---- conform -------------------------------------------------------------------------
def _conformed(feed: FeedSpec):
    """All observations as rows of one feed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return conform(inputs.raw_feed(inputs.observations(spark, sf_dir), feed), feed).drop("_ingest_ts")

    return query


def conformed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_all(inputs.raw_feeds(spark, sf_dir)).drop("_ingest_ts")


def fact_price_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_price(conform_all(inputs.raw_feeds(spark, sf_dir))).drop("_ingest_ts")


# ---- quality -------------------------------------------------------------------------
def _unchecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations some of which break the drop rules."""
    return inputs.observations(spark, sf_dir).selectExpr(
        *LINE,
        "case when l_suppkey % 50 = 0 then 'Costco' else retailer end as retailer",
        "case when p_size = 13 then ' ' when p_size = 14 then '' else p_name end as product_name",
        "case when gone then null when l_quantity = 49 then 0D else cents / 100D end as price_aud",
        "case when gone and l_linenumber < 5 then 'unavailable' else 'available' end as availability",
        "unit_cents / 100D as unit_price_value",
    )


def dq_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_unchecked(spark, sf_dir)).select(*LINE, "retailer", "dq_action", "dq_reason")


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = fact_price_quarantine(inputs.facts(spark, sf_dir))
    return held.select("product_sk", "snapshot_date", "price_aud", "availability", "dq_action", "dq_reason")


def expectation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``expect`` counts while it drops."""
    seen = Observation("expectations")
    quality.expect(_unchecked(spark, sf_dir), into=seen).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(quality.observed_counts(seen.get), quality.COUNTS)


def expectation_log_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stored in two batches, with the counts that the log holds of both."""
    work, rows = work_folder(spark, "expectations"), _unchecked(spark, sf_dir).withColumn("day", F.lit(DAY))

    def judged(batch: DataFrame, seen: Observation, dropped: Observation) -> DataFrame:
        return quality.expect(quality.without_dropped(batch, into=dropped), into=seen)

    def run(table: str) -> None:
        stream = read_table_stream(spark, table, rows.schema)
        run_batches(stream, lambda batch, number: store_checked(batch, judged, "day", f"{work}/kept", f"{work}/log", number), f"{work}/c")

    _in_two_runs(rows, "l_linenumber > 3", work, run)
    stored = parted.read(spark, f"{work}/kept", rows.schema).agg(F.count(F.lit(1)).alias("n_stored"))
    counts = expectation_log(spark, f"{work}/log").groupBy("expectation", "on_fail").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("passed").alias("passed"), F.sum("failed").alias("failed")
    )
    return counts.crossJoin(F.broadcast(stored))


# ---- marts ---------------------------------------------------------------------------
def fact_price_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fact_price_daily(inputs.facts(spark, sf_dir))


def fact_price_daily_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a fact in which one product without a key holds about half of all rows."""
    return marts.fact_price_daily(inputs.crowded_facts(spark, sf_dir))


def _on_daily(mart):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mart(fact_price_daily(spark, sf_dir))

    return query


def _on_fact(mart):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mart(inputs.facts(spark, sf_dir))

    return query


def mart_in_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as a catalogue table, its rows beside what the catalogue says of it."""
    name, tier = "registered_dq_scorecard", {TIER: DESCRIBED["mart_dq_scorecard"][0]}
    rows, place = marts.mart_dq_scorecard(inputs.facts(spark, sf_dir)), work_folder(spark, "catalogue")
    stored = catalogue_table(rows, name, "Quality by day and retailer", tier, "retailer", place)
    comment, properties = described(spark, name)
    return stored.withColumns({"table_comment": F.lit(comment), "table_tier": F.lit(properties.get(TIER))})


# ---- dimensions ----------------------------------------------------------------------
def dim_retailer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retailers that occur in the fact, with their reference rows."""
    seen = inputs.facts(spark, sf_dir).select("retailer").distinct()
    return dimensions.dim_retailer(spark).join(seen, "retailer", "left_semi")


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(inputs.table(spark, sf_dir, "events"), EVENT_HISTORY)


def event_history_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over events of which half have no user, some no time and some a far one."""
    return scd2(inputs.crowded_events(spark, sf_dir), EVENT_HISTORY)


# ---- files and streams ---------------------------------------------------------------
def _write_csv(rows: DataFrame, folder: str) -> None:
    """CSV files in date folders, the way they are landed."""
    writer = rows.hint("rebalance", "date").write.partitionBy("date")
    with shuffles_released(rows.sparkSession):
        writer.option("header", "true").option("quote", '"').option("escape", '"').csv(folder)


def ingested_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files through the ingestion stream, then conformed."""
    work = work_folder(spark, "ingested")
    _write_csv(inputs.feed_text(inputs.observations(spark, sf_dir), COLES, "day as date"), f"{work}/coles")
    ingest.ingest(spark, COLES, f"{work}/coles", f"{work}/raw", f"{work}/checkpoint")
    return conform(ingest.raw_table(spark, COLES, f"{work}/raw"), COLES).drop("_ingest_ts", "_source_file")


def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingested rows by the date in their file's path: the date they were given, and how many
    bear the time of this ingestion."""
    work, started = work_folder(spark, "lineage"), datetime.now(timezone.utc)
    _write_csv(inputs.feed_text(inputs.observations(spark, sf_dir), IGA, "day as date"), f"{work}/iga")
    ingest.ingest(spark, IGA, f"{work}/iga", f"{work}/raw", f"{work}/checkpoint")
    raw = ingest.raw_table(spark, IGA, f"{work}/raw")
    in_time = F.col("_ingest_ts").between(F.lit(started), F.current_timestamp())
    path_date = F.regexp_extract("_source_file", "/iga/date=([^/]+)/[^/]+[.]csv$", 1)
    return raw.groupBy(path_date.alias("path_date"), F.col("_snapshot_date").alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(in_time).alias("n_stamped_in_time")
    )


def inferred_feed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types that the cells of every feed's columns allow."""
    masks = [
        types.type_masks(inputs.feed_text(rows, feed), [header for header in feed.headers if header != "Date"])
        .withColumn("feed", F.lit(feed.folder))
        for feed, rows in inputs.by_feed(inputs.observations(spark, sf_dir))
    ]
    return types.merged_types(reduce(DataFrame.unionByName, masks), ("feed",))


def typed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed in the types learned from a first delivery; later cells that do not fit are rescued."""
    work = work_folder(spark, "typed")
    rows = inputs.feed_text(inputs.observations(spark, sf_dir), COLES, *LINE)
    renamed = rows.select(*[F.col(f"`{name}`").alias(stored_name(name)) for name in rows.columns])
    columns = [name for name in renamed.columns if name not in LINE]
    types.learn(renamed.filter("l_linenumber <= 3").withColumn("_source_file", F.lit("first")), columns, f"{work}/types", 0)
    odd = renamed.withColumns(
        {
            "SKU": F.expr("case when l_linenumber = 7 then concat('X', SKU) else SKU end"),
            "On_Special": F.expr("case when l_linenumber = 6 then '' when l_linenumber = 7 then 'maybe' else On_Special end"),
        }
    )
    found = types.typed(odd, types.learned(spark, f"{work}/types"))
    return found.select(*LINE, "SKU", "Previous_Price", "On_Special", "Brand", "_rescued_data")


def rescued_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two file layouts of one feed; what the feed does not know is rescued as JSON."""
    folder = f"{work_folder(spark, 'rescued')}/aldi"
    more = ("p_brand as Colour", "l_linenumber", "day as date")
    rows = inputs.feed_text(inputs.observations(spark, sf_dir), ALDI, *more)
    usual, other = rows.filter("l_linenumber % 2 = 0"), rows.filter("l_linenumber in (1, 3, 5)")
    _write_csv(usual.drop("Colour", "l_linenumber"), f"{folder}/usual")
    _write_csv(other.select("Product Page", "Colour", "Product", "date"), f"{folder}/other")
    # lines of their own making: two cells too many, one too few, or as many as the header
    ragged = rows.filter("l_linenumber = 7").selectExpr(
        """case length(Product) % 3 when 0 then concat_ws(',', `Product Page`, Colour, Product, 'x y', length(Product))
        when 1 then concat_ws(',', `Product Page`, Colour) else concat_ws(',', `Product Page`, Colour, Product) end
        as `Product Page,Colour,Product`""",
        "date",
    )
    ragged.write.partitionBy("date").option("header", "true").option("sep", "\u0001").csv(f"{folder}/ragged")
    raw = read_feed(spark, ALDI, list_files(spark, folder))
    return raw.select("Product", "Product_Page", "Sub_Category", "_rescued_data", "_snapshot_date")


def fact_price_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds as files, through ingestion and fact streams."""
    work, raw = work_folder(spark, "streamed"), {}
    for feed, rows in inputs.by_feed(inputs.observations(spark, sf_dir)):
        _write_csv(inputs.feed_text(rows, feed, "day as date"), f"{work}/in/{feed.folder}")
        raw = ingest.ingest_all(spark, f"{work}/in", f"{work}/tables", f"{work}/checkpoints")
        # the raw table holds all cells of the files, so they need not lie beside those of the next feed
        files.delete_folder(spark, f"{work}/in/{feed.folder}")
    streamed.run_fact(spark, raw, f"{work}/fact", f"{work}/checkpoints/fact")
    fact = streamed.fact_table(spark, f"{work}/fact")
    return fact.drop("_ingest_ts", "_source_file")


def _in_two_runs(rows: DataFrame, later: str, work: str, run: Callable[[str], object]) -> None:
    """Store rows in two folders, those for which ``later`` holds in the second, and run a stream
    over the first, then over both: it takes what it has not seen yet."""
    comes_later = F.coalesce(F.expr(later), F.lit(False)).cast("int")
    with shuffles_released(rows.sparkSession):
        rows.withColumn("run", comes_later).write.partitionBy("run").parquet(f"{work}/in")
    for folders in ("run=[0]", "run=[01]"):
        run(f"{work}/in/{folders}")


# The second half of the days, and products with some days of the first half that come late.
LATER = "snapshot_date >= date'2021-05-07' or (cast(source_sku as bigint) % 20 = 0 and day(snapshot_date) % 3 = 0)"
# A category whose first day comes late as well.
LATER_FIRST_DAY = f"{LATER} or (canonical_l1 = 'PROMO' and snapshot_date = date'2021-04-23')"


def _event_history(rows: Callable[[SparkSession, str], DataFrame]):
    """Events in two runs, half of all users' events late, into one history."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        work, events = work_folder(spark, "event-history"), rows(spark, sf_dir)
        where = (events.schema, f"{work}/dim", f"{work}/checkpoint", EVENT_HISTORY)
        _in_two_runs(events, "hash(event_id) % 2 = 0", work, lambda table: run_history(spark, table, *where, buckets=BUCKETS))
        return history.current(spark, f"{work}/dim", events.schema, EVENT_HISTORY)

    return query


def dim_product_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product versions from a fact that arrives in two runs, some rows late."""
    work, facts = work_folder(spark, "product-history"), inputs.facts(spark, sf_dir)
    where = (facts.schema, f"{work}/dim", f"{work}/checkpoint", dimensions.PRODUCT_HISTORY)
    _in_two_runs(facts, LATER, work, lambda table: run_history(spark, table, *where, buckets=BUCKETS))
    return history.current(spark, f"{work}/dim", facts.schema, dimensions.PRODUCT_HISTORY)


def _daily_streamed(rows: Callable[[SparkSession, str], DataFrame]):
    """The daily fact kept up over two runs."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        work, facts = work_folder(spark, "daily"), rows(spark, sf_dir).select(*daily.INPUTS)
        where = (facts.schema, f"{work}/daily", f"{work}/checkpoint")
        _in_two_runs(facts, LATER, work, lambda table: daily.run_daily(spark, table, *where, buckets=BUCKETS))
        return daily.current(spark, f"{work}/daily", facts.schema)

    return query


def _mart_streamed(mart: kept.KeptMart):
    """A mart kept up over two runs."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        work, facts = work_folder(spark, "mart"), inputs.facts(spark, sf_dir).select(*MART_INPUTS)
        where = (facts.schema, f"{work}/mart", f"{work}/checkpoint")
        _in_two_runs(facts, LATER_FIRST_DAY, work, lambda table: kept.run_mart(spark, mart, table, *where))
        return kept.current(spark, mart, f"{work}/mart", facts.schema)

    return query


def event_type_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_folder(spark, "distinct")
    schema = inputs.table(spark, sf_dir, "events").schema
    # a pattern finds the table whether it is one file or a folder of files
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    labels = events.select("event_type", F.upper("event_type").alias("label"))
    run_distinct(labels, ["event_type"], f"{work}/types", f"{work}/checkpoint")
    return distinct.current(spark, f"{work}/types", labels.schema)


def dim_category_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of a fact that arrives in two runs; the second adds only new ones."""
    work = work_folder(spark, "categories")
    rows = inputs.facts(spark, sf_dir).select(*dimensions.CATEGORY, "source_sku", "snapshot_date")

    def run(table: str) -> None:
        stream = read_table_stream(spark, table, rows.schema)
        distinct.run_categories(stream, f"{work}/dim", f"{work}/checkpoint")

    _in_two_runs(rows, f"{LATER} or canonical_l1 = 'PROMO'", work, run)
    return distinct.current(spark, f"{work}/dim", rows.select(*dimensions.CATEGORY).schema)


def _file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One messy file name per order."""
    return inputs.table(spark, sf_dir, "orders").selectExpr(
        """concat('/in/', o_custkey % 3, '/', case when o_orderkey % 11 = 0 then '' else date_format(o_orderdate, 'yyyy-MM-dd') end,
        element_at(array(' ALDI', ' Coles', ' iga', ' WOW', ' Woolworths', ' shop'), cast(o_custkey % 6 as int) + 1),
        ' Data ', o_orderkey, '.csv') as path"""
    )


def landing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.landing_plan(_file_names(spark, sf_dir), "raw")


def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_plan(spark, sf_dir).filter("target is null").select("source", "retailer", "date")


def _landed_in_two_runs(result: Callable[[SparkSession, str], DataFrame]):
    """Files that arrive in two runs, many for targets that the first run has filled."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        work, names = work_folder(spark, "landing"), _file_names(spark, sf_dir)

        def run(table: str) -> None:
            stream = read_table_stream(spark, table, names.schema)
            landed.run_landing(stream, "raw", f"{work}/landed", f"{work}/log", f"{work}/checkpoint")

        _in_two_runs(names, "path like '%7.csv' or path like '/in/1/%'", work, run)
        return result(spark, work)

    return query


QUERIES = {
    "unit_price_normalised": unit_price_normalised,
    "price_text_clean": price_text_clean,
    "supplier_list_first": supplier_list_first,
    "primary_department": primary_department,
    "canonical_category": taxonomy,
    "label_cleanup": label_cleanup,
    "brand_and_match_key": brand_and_match_key,
    "surrogate_sku": surrogate_sku,
    "availability_special_flags": availability_special_flags,
    "conform_feed_a": _conformed(ALDI),
    "conform_feed_b": _conformed(COLES),
    "conform_feed_c": _conformed(IGA),
    "conform_feed_d": _conformed(WOOLWORTHS),
    "conformed_union": conformed_union,
    "fact_price": fact_price_from_text,
    "dq_classified": dq_classified,
    "dq_quarantine": dq_quarantine,
    "expectation_metrics": expectation_metrics,
    "expectation_log_streamed": expectation_log_streamed,
    "fact_price_daily": fact_price_daily,
    "fact_price_daily_hot_keys": fact_price_daily_hot_keys,
    "mart_price_comparison": _on_daily(marts.mart_price_comparison),
    "mart_specials_penetration": _on_daily(marts.mart_specials_penetration),
    "mart_category_price_index": _on_daily(marts.mart_category_price_index),
    "mart_availability": _on_fact(marts.mart_availability),
    "mart_dq_scorecard": _on_fact(marts.mart_dq_scorecard),
    "mart_in_catalogue": mart_in_catalogue,
    "dim_product_scd2": _on_fact(dimensions.dim_product),
    "dim_category": _on_fact(dimensions.dim_category),
    "dim_retailer": dim_retailer,
    "dim_date": _on_fact(dimensions.dim_date),
    "event_history_scd2": event_history,
    "event_history_scd2_hot_keys": event_history_hot_keys,
    "event_history_scd2_streamed": _event_history(lambda spark, sf_dir: inputs.table(spark, sf_dir, "events")),
    "event_history_scd2_streamed_hot_keys": _event_history(inputs.crowded_events),
    "dim_product_scd2_streamed": dim_product_streamed,
    "fact_price_daily_streamed": _daily_streamed(inputs.facts),
    "fact_price_daily_streamed_hot_keys": _daily_streamed(inputs.crowded_facts),
    **{f"{name}_streamed": _mart_streamed(mart) for name, mart in kept.KEPT_MARTS.items()},
    "event_type_dedup_stream": event_type_dedup_stream,
    "dim_category_streamed": dim_category_streamed,
    "ingested_feed": ingested_feed,
    "file_lineage": file_lineage,
    "inferred_feed_types": inferred_feed_types,
    "typed_feed": typed_feed,
    "rescued_columns": rescued_columns,
    "fact_price_streamed": fact_price_streamed,
    "landing_plan": landing_plan,
    "landing_rejects": landing_rejects,
    "landing_log_streamed": _landed_in_two_runs(lambda spark, work: landed.landing_log(spark, f"{work}/log")),
    "landed_files_streamed": _landed_in_two_runs(lambda spark, work: landed.landed_files(spark, f"{work}/landed")),
}
