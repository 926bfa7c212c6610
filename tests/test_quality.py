"""Verdicts and expectations."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tillmark.operators import quality

SCHEMA = "id long, retailer string, product_name string, price_aud double, availability string, unit_price_value double"
ROWS = [
    (("Costco", "Milk 2L", 3.0, "available", 1.5), ("drop", "invalid_retailer:'Costco'")),
    ((None, "Milk 2L", 3.0, "available", 1.5), ("drop", "invalid_retailer:None")),
    (("Leo's", "Milk 2L", 3.0, "available", 1.5), ("drop", 'invalid_retailer:"Leo\'s"')),
    (("Coles", "", 3.0, "available", None), ("drop", "missing_product_name")),
    (("Coles", " \t", 3.0, "available", None), ("drop", "missing_product_name")),
    (("Coles", None, 3.0, "available", None), ("drop", "missing_product_name")),
    (("IGA", "Bread", None, "available", None), ("drop", "null_price_for_available_item")),
    (("Aldi", "Bread", None, "unknown", None), ("drop", "null_price_for_available_item")),
    (("Aldi", "Bread", None, None, None), ("drop", "null_price_for_available_item")),
    (("IGA", "Bread", 0.0, "available", None), ("drop", "non_positive_price:0.0")),
    (("IGA", "Bread", -0.0005, "available", None), ("drop", "non_positive_price:-0.0005")),
    (("Woolworths", "Mighty Soft", None, "unavailable", None), ("quarantine", "unavailable_no_price")),
    (("Aldi", "Hedanol 20pk", 69.0, "unknown", 0.03), ("quarantine", "price_unit_mismatch:ratio=2300.0")),
    (("Coles", "Gold Bar", 5000.0, "available", 5000.0), ("quarantine", "price_out_of_range:5000.0")),
    (("Coles", "Gold Bar", 12345678.9, "available", 1.0), ("quarantine", "price_out_of_range:12345678.9")),
    (("Coles", "Conditioner", 17.0, "available", 2.58), ("pass", None)),
    (("Coles", "Edge", 1000.0, "available", None), ("pass", None)),
    (("Coles", "Edge", 1000.01, "available", None), ("quarantine", "price_out_of_range:1000.01")),
    (("Coles", "Edge", 100.0, "available", 1.0), ("pass", None)),
    (("Coles", "Edge", 100.5, "available", 1.0), ("quarantine", "price_unit_mismatch:ratio=100.5")),
    (("Coles", "Edge", 1.0, "available", 101.0), ("quarantine", "price_unit_mismatch:ratio=0.0")),
    (("Coles", "Edge", 5.0, "available", 0.0), ("pass", None)),
    (("Coles", "Edge", 5.0, "unavailable", -1.0), ("pass", None)),
    (("Woolworths", "Edge", 3.0, "unavailable", None), ("pass", None)),
]


def table(spark):
    return spark.createDataFrame([(i, *row) for i, (row, _) in enumerate(ROWS)], SCHEMA)


def test_first_failing_rule_decides(spark):
    got = [(row.dq_action, row.dq_reason) for row in quality.classify(table(spark)).orderBy("id").collect()]
    assert list(zip([row for row, _ in ROWS], got)) == ROWS


def test_drop_filter_agrees_with_the_verdict(spark):
    kept = {row.id for row in quality.without_dropped(table(spark)).collect()}
    assert kept == {i for i, (_, (action, _)) in enumerate(ROWS) if action != "drop"}


def test_quarantine_split(spark):
    flagged = quality.flag_quarantined(quality.classify(quality.without_dropped(table(spark))))
    bad, good = quality.quarantined(flagged).count(), quality.trusted(flagged).count()
    actions = [action for _, (action, _) in ROWS]
    assert (bad, good) == (actions.count("quarantine"), actions.count("pass"))


def test_own_rules(spark):
    rules = [
        quality.Rule("flag", F.col("price_aud") > 50, F.lit("dear")),
        quality.Rule("drop", F.col("product_name").isNull(), F.lit("nameless")),
    ]
    actions = [row.dq_action for row in quality.classify(table(spark), rules).orderBy("id").collect()]
    wanted = [
        "flag" if (price or 0) > 50 else "drop" if name is None else "pass" for (_, name, price, _, _), _ in ROWS
    ]
    assert actions == wanted


def test_expectations_count_then_drop(spark):
    seen = Observation("seen")
    kept = quality.expect(table(spark), into=seen).count()
    counts = seen.get
    valid = [r for (r, *_), _ in ROWS if r in ("Aldi", "Coles", "IGA", "Woolworths")]
    assert counts["rows"] == len(ROWS)
    assert counts["valid_retailer_failed"] == len(ROWS) - len(valid)
    assert counts["has_product_name_failed"] == 2
    assert counts["price_present_or_unavailable_failed"] == 3
    assert kept == len(ROWS) - 3 - 2


def test_expectation_report(spark):
    report = {row.expectation: (row.on_fail, row.passed, row.failed) for row in quality.expectation_report(table(spark)).collect()}
    assert report == {
        "valid_retailer": ("drop", len(ROWS) - 3, 3),
        "has_product_name": ("drop", len(ROWS) - 2, 2),
        "price_present_or_unavailable": ("warn", len(ROWS) - 3, 3),
    }
