"""Price feeds made out of the order tables.

Every order line is one price observation: the supplier decides the retailer, the part is
the product, the ship date (folded into four weeks) is the snapshot date. ``observations``
carries the plain numbers; ``raw_feeds`` spells them the way the four feeds would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators import quality
from tillmark.plans.fact import with_keys
from tillmark.session import spread
from tillmark.sources.feeds import ALDI, COLES, IGA, WOOLWORTHS, FeedSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their part, price in cents and snapshot date."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey).selectExpr(
        "*",
        "element_at(array('Aldi', 'Coles', 'IGA', 'Woolworths'), cast(l_suppkey % 4 as int) + 1) as retailer",
        "cast(floor(l_extendedprice * 10 / l_quantity) as bigint) as cents",
        "date_add(date'2021-04-23', pmod(datediff(l_shipdate, date'1995-01-01'), 28)) as day",
        "l_returnflag = 'R' and l_quantity = 50 as gone",
    )
    return joined.selectExpr("*", "cents div (4 * p_size) as unit_cents")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price fact with its columns filled from numbers, as if read from storage."""
    rows = observations(spark, sf_dir).selectExpr(
        "retailer",
        "cast(l_partkey as string) as source_sku",
        "p_name as product_name",
        "p_brand as brand",
        "case when not gone then cents / 100D end as price_aud",
        "cast(null as double) as previous_price_aud",
        "unit_cents / 100D as unit_price_value",
        "'per_100g' as unit_price_measure",
        "case when p_size % 7 > 0 then unit_cents / 10D end as norm_unit_price",
        "case when p_size % 7 > 0 then element_at(array('per_kg', 'per_l', 'per_each'), p_size % 3 + 1) end"
        " as norm_unit_measure",
        "case when l_discount > 0.05D then '1L' else '2L' end as package_size_raw",
        "l_discount > 0.07D as on_special",
        "case when gone then 'unavailable' when l_linestatus = 'O' then 'available' else 'unknown' end as availability",
        "p_size / 10D as ratings",
        "cast(null as string) as primary_supplier",
        "p_type as raw_main_category",
        "cast(null as string) as raw_sub_category",
        "p_type as canonical_l1",
        "concat(p_type, ' ', p_size % 5) as canonical_l2",
        "concat('https://shop.example/p/', l_partkey) as product_url",
        "concat(p_brand, ' ', p_name) as brand_product_size",
        "day as snapshot_date",
        "concat(retailer, '/date=', day) as _source_file",
        "timestamp'2021-06-01 00:00:00' as _ingest_ts",
    )
    return with_keys(quality.flag_quarantined(quality.classify(quality.without_dropped(rows))))


def crowded_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with the even products as one product without a key: some rows without a date,
    some on one far day, some twice."""
    sku = "cast(source_sku as bigint)"
    crowded = facts(spark, sf_dir).withColumns(
        {
            "product_sk": F.expr(f"case when {sku} % 2 = 1 then product_sk end"),
            "snapshot_date": F.expr(
                f"case when {sku} % 10 = 0 then null when {sku} % 50 = 2 then date'1999-01-01' else snapshot_date end"
            ),
            "_copy": F.expr(f"explode(sequence(1, case when {sku} % 4 = 0 then 2 else 1 end))"),
        }
    )
    return crowded.drop("_copy")


def crowded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which half have no user, some no time and some a time far before the others."""
    return table(spark, sf_dir, "events").withColumns(
        {
            "user_id": F.expr("case when event_id % 2 = 1 then user_id end"),
            "ts": F.expr("case when event_id % 97 = 0 then null when event_id % 1000 < 3 then ts - interval 20 years else ts end"),
        }
    )


_DOLLARS = "concat(cents div 100, '.', lpad(cents % 100, 2, '0'))"
_UNIT_DOLLARS = "concat(unit_cents div 100, '.', lpad(unit_cents % 100, 2, '0'))"
PRICE_TEXT = f"""case when gone then ''
    when l_linenumber % 4 = 0 then concat('$', format_number(cents div 100, 0), '.', lpad(cents % 100, 2, '0'))
    when l_linenumber % 4 = 1 then {_DOLLARS}
    when l_linenumber % 4 = 2 then concat(' $', {_DOLLARS}, ' ')
    else concat('$ ', {_DOLLARS}) end"""
UNIT_PRICE_TEXT = f"""case when p_size = 50 then '' when p_size = 25 then 'n/a'
    when p_size % 6 = 0 then concat('$', {_UNIT_DOLLARS}, ' per 100g')
    when p_size % 6 = 1 then concat(unit_cents, 'c per tablet')
    when p_size % 6 = 2 then concat('$', {_UNIT_DOLLARS}, ' per 100mL')
    when p_size % 6 = 3 then concat({_UNIT_DOLLARS}, ' per litre')
    when p_size % 6 = 4 then concat('$', {_UNIT_DOLLARS}, ' per 1Kg')
    else concat('$', {_UNIT_DOLLARS}, ' / 250G') end"""
NAME_TEXT = """concat(case when p_size % 2 = 0 then concat(upper(left(p_name, 1)), substr(p_name, 2))
    else initcap(p_name) end, ' ', p_size, 'pk')"""
UNIT_SIZE_TEXT = (
    "case p_size % 3 when 0 then '1 each' when 1 then concat(p_size, 'L') else concat(p_size, '0G') end"
)
PACKAGE_SIZE_TEXT = "case when p_size % 2 = 0 then concat(p_size, 'pk') else concat(p_size, 'l') end"
SUPPLIERS_TEXT = """case when l_suppkey % 5 = 0 then '[]'
    else concat('[\\'', l_suppkey, ' CARTER & CO\\', "', l_partkey, ' COSTA\\'S P/L"]') end"""
DEPARTMENT_TEXT = """case p_type
    when 'MEDIUM' then "['Meat, Seafood & Deli', 'Dairy, Eggs & Fridge']"
    when 'STANDARD' then "['Liquor', 'Pantry']" when 'LARGE' then "['Liquor']" when 'PROMO' then '[]'
    when 'SMALL' then "['Bakery']" else '["Baby", \\'Pet\\']' end"""
URL_TEXT = "concat('https://shop.example/p/', l_partkey)"

_FEED_COLUMNS = {
    ALDI: {
        "Product": NAME_TEXT,
        "Price": PRICE_TEXT,
        "Unit Price": UNIT_PRICE_TEXT,
        "Main Category": "'groceries'",
        "Sub Category": "case p_type when 'MEDIUM' then 'fresh product' when 'STANDARD' then 'beauty'"
        " when 'LARGE' then 'laundry household' when 'PROMO' then 'freezer' when 'SMALL' then 'mystery-dept'"
        " else 'pantry' end",
        "Product Page": URL_TEXT,
    },
    COLES: {
        "Product Name": "p_name",
        "SKU": "cast(l_partkey as string)",
        "Brand": "p_brand",
        "Unit Size": UNIT_SIZE_TEXT,
        "Current Price": PRICE_TEXT,
        "Previous Price": _DOLLARS,
        "Price per unit": UNIT_PRICE_TEXT,
        "On Special": "case when l_discount > 0.07D then 'True' else 'False' end",
        "Availability": "case when gone then 'Unavailable' else 'In Stock' end",
        "Suppliers": SUPPLIERS_TEXT,
        "Category": "case p_type when 'MEDIUM' then 'fruit-vegetables' when 'STANDARD' then 'health-beauty'"
        " when 'LARGE' then 'laundry' when 'PROMO' then 'liquor' when 'SMALL' then \"720488 L'OREAL P/L\""
        " else '' end",
        "URL": URL_TEXT,
    },
    IGA: {
        "Product Name": "concat(p_name, ' ', p_size, 'gm')",
        "SKU": "concat(l_partkey, '.0')",
        "Price": PRICE_TEXT,
        "Price per unit": UNIT_PRICE_TEXT,
        "Main Category": "case p_type when 'LARGE' then 'household' when 'PROMO' then 'frozen'"
        " when 'SMALL' then 'big--deals' when 'ECONOMY' then 'pet' else 'groceries' end",
        "Sub Category": "case p_type when 'MEDIUM' then 'fruit' when 'STANDARD' then 'health'"
        " when 'LARGE' then 'unheard of' when 'ECONOMY' then 'pet' end",
        "Product URL": URL_TEXT,
    },
    WOOLWORTHS: {
        "Product Name": "p_name",
        "SKU": "cast(l_partkey as string)",
        "Brand": "p_brand",
        "Price": PRICE_TEXT,
        "Price per unit": UNIT_PRICE_TEXT,
        "Package Size": PACKAGE_SIZE_TEXT,
        "Specials": "case when l_discount > 0.07D then 'Save $1.00' end",
        "Availability": "case when gone then 'Unavailable' else 'Available' end",
        "Ratings": "concat(p_size % 5, '.5')",
        "Department": DEPARTMENT_TEXT,
        "Product URL": URL_TEXT,
    },
}


def feed_text(rows: DataFrame, feed: FeedSpec, *more: str) -> DataFrame:
    """Observations as one feed's native columns, the way its files would hold them, and
    ``more`` expressions."""
    return rows.selectExpr(*[f"{sql} as `{header}`" for header, sql in _FEED_COLUMNS[feed].items()], *more)


def raw_feed(rows: DataFrame, feed: FeedSpec) -> DataFrame:
    """Observations as one feed's raw table: native columns and lineage."""
    return feed_text(
        rows,
        feed,
        f"concat('{feed.retailer}', '/date=', day) as _source_file",
        "timestamp'2021-06-01 00:00:00' as _ingest_ts",
        "day as _snapshot_date",
    )


def by_feed(rows: DataFrame) -> list[tuple[FeedSpec, DataFrame]]:
    """Every observation in the feed of its own retailer."""
    return [(feed, rows.filter(F.col("retailer") == feed.retailer)) for feed in _FEED_COLUMNS]


def raw_feeds(spark: SparkSession, sf_dir: str) -> list[tuple[FeedSpec, DataFrame]]:
    return [(feed, raw_feed(rows, feed)) for feed, rows in by_feed(observations(spark, sf_dir))]
