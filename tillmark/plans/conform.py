"""Bring any feed to the common model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions import keys, lists, text
from tillmark.functions.numbers import price_steps
from tillmark.functions.staged import Steps, staged
from tillmark.functions.taxonomy import category_steps
from tillmark.functions.unit_price import unit_price, unit_price_steps
from tillmark.sources.feeds import LINEAGE, FeedSpec, From, column_or_null

_FIELDS = (
    "product_name", "source_sku", "brand", "price", "previous_price", "unit_price", "package_size",
    "availability", "ratings", "suppliers", "main_category", "sub_category", "product_url",
)


def conform(df: DataFrame, feed: FeedSpec) -> DataFrame:
    """Project a raw feed, batch or stream, onto the 24 columns of the common model."""
    has = feed.columns.__contains__
    retailer, name, url = F.lit(feed.retailer), F.col("product_name"), F.col("product_url")
    cleaned = {field: _cleaning(source, field) for field, source in feed.columns.items()}
    parsers = [
        *cleaned.values(),
        [{"on_special": text.any_special(*[F.col(f"_special_{place}") for place in range(len(feed.specials))])}],
        price_steps(F.col("price"), "price_aud"),
        price_steps(F.col("previous_price"), "previous_price_aud"),
        _after(cleaned, ("main_category", "sub_category"), category_steps(F.col("main_category"), F.col("sub_category") if has("sub_category") else None)),
    ]
    if has("unit_price"):
        parsers.append(unit_price_steps(F.col("unit_price"), "unit"))
    if not has("brand"):
        parsers.append(_after(cleaned, ("product_name",), text.brand_steps(name, "brand")))
    if has("suppliers"):
        parsers.append(lists.item_steps(F.col("suppliers"), "supplier_items"))
    unit = unit_price("unit") if has("unit_price") else {"value": _null("double"), "measure": _null("string"), "norm_value": _null("double"), "norm_measure": _null("string")}
    supplier = lists.first_item(F.col("supplier_items")) if has("suppliers") else _null("string")
    sku = F.col("source_sku") if has("source_sku") else keys.surrogate_sku(retailer, name, url)
    size = F.col("package_size") if has("package_size") else F.lit("")
    found = staged(_read(df, feed), *parsers)
    return (found if feed.keep is None else found.filter(feed.keep())).select(
        retailer.alias("retailer"),
        sku.alias("source_sku"),
        "product_name",
        "brand",
        "price_aud",
        "previous_price_aud",
        unit["value"].alias("unit_price_value"),
        unit["measure"].alias("unit_price_measure"),
        unit["norm_value"].alias("norm_unit_price"),
        unit["norm_measure"].alias("norm_unit_measure"),
        F.col("package_size").alias("package_size_raw"),
        "on_special",
        text.availability(F.col("availability")).alias("availability"),
        F.col("ratings").try_cast("double").alias("ratings"),
        supplier.alias("primary_supplier"),
        F.col("main_category").alias("raw_main_category"),
        F.col("sub_category").alias("raw_sub_category"),
        "canonical_l1",
        "canonical_l2",
        "product_url",
        text.match_key(F.col("brand"), name, size).alias("brand_product_size"),
        F.col("_snapshot_date").alias("snapshot_date"),
        "_source_file",
        "_ingest_ts",
    )


def conform_all(raw: dict[FeedSpec, DataFrame] | list[tuple[FeedSpec, DataFrame]]) -> DataFrame:
    """All feeds in one table, duplicates kept."""
    pairs = raw.items() if isinstance(raw, dict) else raw
    return reduce(DataFrame.unionByName, [conform(df, feed) for feed, df in pairs])


def _read(df: DataFrame, feed: FeedSpec) -> DataFrame:
    """One column per field of the model, as the feed has it, and its cells that tell specials."""
    headers = {name: column_or_null(df, source.header) for name, source in feed.columns.items()}
    headers |= {f"_special_{place}": column_or_null(df, header) for place, header in enumerate(feed.specials)}
    missing = {name: _null("string") for name in _FIELDS}
    return df.select(*[column.alias(name) for name, column in (missing | headers).items()], *LINEAGE)


def _cleaning(source: From, name: str) -> Steps:
    """A field's parse, if any, and its clean-up, which takes the field's name."""
    steps = source.parse(F.col(name), f"_{name}") if source.parse else []
    return steps if source.clean is None else [*steps, {name: source.clean(F.col(f"_{name}" if source.parse else name))}]


def _after(cleaned: dict[str, Steps], fields: tuple[str, ...], steps: Steps) -> Steps:
    """Steps that begin when the fields are cleaned."""
    return [{}] * max(len(cleaned.get(field, [])) for field in fields) + steps


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)
