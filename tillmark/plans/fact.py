"""The price fact: verdicts, keys and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import types as T

from tillmark.functions.keys import hash_key
from tillmark.operators import quality

# The columns of the fact as they are stored, by type.
_TYPES = {
    T.StringType(): (
        "retailer source_sku product_name brand unit_price_measure norm_unit_measure package_size_raw availability "
        "primary_supplier raw_main_category raw_sub_category canonical_l1 canonical_l2 product_url brand_product_size "
        "_source_file dq_action dq_reason product_sk category_sk"
    ),
    T.DoubleType(): "price_aud previous_price_aud unit_price_value norm_unit_price ratings",
    T.BooleanType(): "on_special is_quarantined",
    T.DateType(): "snapshot_date",
    T.TimestampType(): "_ingest_ts",
}
_ORDER = (
    "retailer source_sku product_name brand price_aud previous_price_aud unit_price_value unit_price_measure "
    "norm_unit_price norm_unit_measure package_size_raw on_special availability ratings primary_supplier "
    "raw_main_category raw_sub_category canonical_l1 canonical_l2 product_url brand_product_size snapshot_date "
    "_source_file _ingest_ts dq_action dq_reason is_quarantined product_sk category_sk"
).split()
_TYPE_OF = {name: kind for kind, names in _TYPES.items() for name in names.split()}
FACT_SCHEMA = T.StructType([T.StructField(name, _TYPE_OF[name]) for name in _ORDER])


def with_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "product_sk": hash_key("retailer", "source_sku"),
            "category_sk": hash_key("canonical_l1", "canonical_l2"),
        }
    )


def fact_price(
    conformed: DataFrame, into: Observation | str = "expectations", dropped: Observation | str | None = None
) -> DataFrame:
    """Conformed rows that no rule drops, each with its verdict and keys. Batch or stream.

    ``into`` receives the counts of the expectations, ``dropped`` those of dropped rows; without
    a name of their own these are named after ``into``, so that two facts can stand in one query.
    """
    if dropped is None:
        dropped = "dropped" if not isinstance(into, str) or into == "expectations" else f"{into}_dropped"
    kept = quality.classify(quality.without_dropped(conformed, into=dropped))
    return quality.expect(with_keys(quality.flag_quarantined(kept)), into=into)


def fact_price_quarantine(fact: DataFrame) -> DataFrame:
    return quality.quarantined(fact)
