"""Row verdicts from ordered rules, and expectations that count what they see."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillmark.functions import fixed_values as fixed
from tillmark.functions.numbers import double_text, round_exact
from tillmark.functions.text import strip_plain

PASS, QUARANTINE, DROP = "pass", "quarantine", "drop"


@dataclass(frozen=True)
class Rule:
    """``action`` and ``reason`` for the rows for which ``fails`` is true (NULL counts as false).

    ``given`` names values that are computed once, before the rules are applied.
    """

    action: str
    fails: Column
    reason: Column
    given: dict[str, Column] = field(default_factory=dict)


def retailer_rule(retailer: Column) -> Rule:
    quote = F.when(retailer.contains("'") & ~retailer.contains('"'), '"').otherwise("'")
    inner = F.when(quote == "'", F.replace(retailer, F.lit("'"), F.lit("\\'"))).otherwise(retailer)
    shown = F.coalesce(F.concat(quote, inner, quote), F.lit("None"))
    valid = F.coalesce(retailer.isin(*fixed.VALID_RETAILERS), F.lit(False))
    return Rule(DROP, ~valid, F.concat(F.lit("invalid_retailer:"), shown))


def product_name_rule(name: Column) -> Rule:
    return Rule(DROP, F.coalesce(strip_plain(name) == "", F.lit(True)), F.lit("missing_product_name"))


def price_present_rules(price: Column, availability: Column) -> list[Rule]:
    unavailable = availability.eqNullSafe(F.lit("unavailable"))
    return [
        Rule(DROP, price.isNull() & ~unavailable, F.lit("null_price_for_available_item")),
        Rule(DROP, price <= fixed.PRICE_MIN, F.concat(F.lit("non_positive_price:"), double_text(price))),
    ]


def price_range_rule(price: Column) -> Rule:
    return Rule(QUARANTINE, price > fixed.PRICE_MAX, F.concat(F.lit("price_out_of_range:"), double_text(price)))


def price_unit_rule(price: Column, unit_price: Column, tolerance: float = fixed.UNIT_PRICE_TOLERANCE) -> Rule:
    """Price and unit price orders of magnitude apart; not judged without a positive unit price."""
    ratio = F.col("_ratio")
    shown = F.format_string("%.1f", round_exact(ratio, 1))
    apart = (ratio > tolerance) | (ratio < 1.0 / tolerance)
    given = {"_ratio": F.when(unit_price > 0, F.try_divide(price, unit_price))}
    return Rule(QUARANTINE, apart, F.concat(F.lit("price_unit_mismatch:ratio="), shown), given)


def unavailable_rule(price: Column, availability: Column) -> Rule:
    return Rule(QUARANTINE, price.isNull() & (availability == "unavailable"), F.lit("unavailable_no_price"))


def price_rules() -> list[Rule]:
    """The rules of the price fact, in the order in which they decide."""
    retailer, name, price = F.col("retailer"), F.col("product_name"), F.col("price_aud")
    availability, unit_price = F.col("availability"), F.col("unit_price_value")
    return [
        retailer_rule(retailer),
        product_name_rule(name),
        *price_present_rules(price, availability),
        price_range_rule(price),
        price_unit_rule(price, unit_price),
        unavailable_rule(price, availability),
    ]


def classify(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Add ``dq_action`` and ``dq_reason``: those of the first rule that fails, else a pass."""
    rules = price_rules() if rules is None else rules
    # two separate columns: who needs the action alone does not pay for the reason texts
    action, reason = F.lit(PASS), F.lit(None).cast("string")
    for rule in reversed(rules):
        action = F.when(rule.fails, rule.action).otherwise(action)
        reason = F.when(rule.fails, rule.reason).otherwise(reason)
    given = {name: value for rule in rules for name, value in rule.given.items()}
    return df.withColumns(given).select(
        *[F.col(f"`{name}`") for name in df.columns], action.alias("dq_action"), reason.alias("dq_reason")
    )


def without_dropped(
    df: DataFrame, rules: list[Rule] | None = None, into: Observation | str = "dropped"
) -> DataFrame:
    """Rows that no drop rule rejects; ``into`` receives the number of rows and of rejected ones.

    Tested on the drop rules alone, before the verdict is built, so that rejected rows
    cost no more. The count also keeps the filter above the parsing: pushed below it,
    every parsed column it mentions would be computed a second time.
    """
    rules = price_rules() if rules is None else rules
    dropped = reduce(Column.__or__, [F.coalesce(rule.fails, F.lit(False)) for rule in rules if rule.action == DROP])
    counted = df.observe(into, F.count(F.lit(1)).alias("rows"), F.count_if(dropped).alias("rows_dropped"))
    return counted.filter(~dropped)


def flag_quarantined(df: DataFrame) -> DataFrame:
    return df.withColumn("is_quarantined", F.col("dq_action") == QUARANTINE)


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter("is_quarantined")


def trusted(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_quarantined"))


@dataclass(frozen=True)
class Expectation:
    """A SQL condition rows should meet; rows that do not are counted, and dropped if so asked."""

    name: str
    condition: str
    drops: bool = False

    def met(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


FACT_EXPECTATIONS = (
    Expectation("valid_retailer", "retailer IN ('Aldi', 'Coles', 'IGA', 'Woolworths')", drops=True),
    Expectation("has_product_name", "product_name IS NOT NULL AND product_name <> ''", drops=True),
    Expectation("price_present_or_unavailable", "price_aud IS NOT NULL OR availability = 'unavailable'"),
)


def expect(
    df: DataFrame, expectations: tuple[Expectation, ...] = FACT_EXPECTATIONS, into: Observation | str = "expectations"
) -> DataFrame:
    """Count rows that meet and miss each expectation as the data flows by, then drop as asked.

    ``into`` is an Observation in batch jobs; in a stream, give a name and read the
    counts from the query progress.
    """
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(~e.met()).alias(f"{e.name}_failed") for e in expectations]
    observed = df.observe(into, *counts)
    for expectation in expectations:
        if expectation.drops:
            observed = observed.filter(expectation.met())
    return observed


def expectation_report(df: DataFrame, expectations: tuple[Expectation, ...] = FACT_EXPECTATIONS) -> DataFrame:
    """One row per expectation: action, rows that met it, rows that missed it. One pass."""
    counts = [
        F.struct(
            F.lit(e.name).alias("expectation"),
            F.lit("drop" if e.drops else "warn").alias("on_fail"),
            F.count_if(e.met()).alias("passed"),
            F.count_if(~e.met()).alias("failed"),
        )
        for e in expectations
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


COUNTS = "expectation string, on_fail string, passed long, failed long"
DROP_RULES = "drop_rules"


def observed_counts(
    seen: dict[str, int], dropped: dict[str, int] | None = None, expectations: tuple[Expectation, ...] = FACT_EXPECTATIONS
) -> list[tuple]:
    """What ``expect``, and ``without_dropped``, have counted, as rows of ``COUNTS``."""
    rows = [(DROP_RULES, "drop", dropped["rows"] - dropped["rows_dropped"], dropped["rows_dropped"])] if dropped else []
    for one in expectations:
        failed = seen[f"{one.name}_failed"]
        rows.append((one.name, "drop" if one.drops else "warn", seen["rows"] - failed, failed))
    return rows
