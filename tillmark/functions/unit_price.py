"""Unit prices such as ``$2.58 per 100mL`` or ``3c per tablet``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions import fixed_values as fixed
from tillmark.functions.numbers import double_text, round_exact
from tillmark.functions.staged import Steps, staged
from tillmark.functions.text import lookup, strip

_UNITS = (
    {word: word for word in fixed.WEIGHT_UNITS}
    | {word: "ml" if millilitres == 1.0 else "l" for word, millilitres in fixed.VOLUME_UNITS.items()}
    | {word: "each" for word in fixed.COUNT_WORDS}
)
_AMOUNT = r"[\d.]+"
_CENTS = r"\dc\b|[cC][\x{85}\x{2028}\x{2029}]?[\s\x{a0}]*\z"
# digits, white space and a word; what comes before the word
_QUANTITY = r"^(?:per|/)[\s\x{a0}]*+([\d.]*\s*[a-zA-Z]+)"
_BEFORE_WORD = "0123456789. \t\n\x0b\f\r"


def canonical_unit(word: Column) -> Column:
    return lookup(_UNITS, F.lower(strip(word)))


def unit_price_steps(raw: Column, into: str) -> Steps:
    """What ``unit_price`` makes value and measure of: as shown, and per kg, litre or piece.

    The cell reads "<amount> per <quantity><unit>", cut at its first "per" or slash.
    """

    def part(name: str) -> Column:
        return F.col(f"_{into}_{name}")

    # "per" in any case, and nothing else, is lower case here; texts keep their length
    lower = reduce(lambda text, letter: F.replace(text, F.lit(letter.upper()), F.lit(letter)), "per", raw)
    left = F.substring_index(F.replace(part("lower"), F.lit("per"), F.lit("/")), "/", 1)
    right = F.substring(part("lower"), F.length(left) + 1, F.length(part("lower")))  # from "per" or slash on, else empty
    amount, cents, quantity = part("amount"), part("cents"), part("quantity")
    word = F.ltrim(quantity, F.lit(_BEFORE_WORD))
    count = F.replace(quantity, word, F.lit(""))  # may end in white space, which a cast does not mind
    value, qty, unit = part("value"), part("qty"), part("unit")

    dollars = F.when(cents, round_exact(amount / 100.0, 4)).otherwise(amount)
    # a quantity such as "1.2.3" makes the whole cell unreadable
    readable = (word == "") | (count == "") | count.try_cast("double").isNotNull()

    whole = qty.try_cast("decimal(38,0)").cast("string")
    shown_qty = F.when(qty == 1.0, "").when(qty == F.rint(qty), whole).otherwise(double_text(qty))
    priced = value.isNotNull() & unit.isNotNull()
    comparable = priced & (qty != 0)
    per_thousand = F.when(unit == "mg", 0.001).when(unit.isin("kg", "l"), 1000.0).otherwise(1.0)
    per_base = F.when(unit == "each", F.try_divide(value, qty)).otherwise(
        F.try_divide(value, per_thousand * qty) * 1000.0
    )
    base_name = F.when(unit == "each", "per_each").when(unit.isin("ml", "l"), "per_l").otherwise("per_kg")
    return [
        {f"_{into}_lower": lower},
        {
            f"_{into}_amount": F.when(right != "", F.regexp_extract(left, _AMOUNT, 0)).try_cast("double"),
            f"_{into}_cents": ~left.contains("$") & left.rlike(_CENTS),
            f"_{into}_quantity": F.regexp_extract(right, _QUANTITY, 1),
        },
        {
            f"_{into}_value": F.when(readable, dollars),
            f"_{into}_qty": F.when(count == "", 1.0).otherwise(count.try_cast("double")),
            f"_{into}_unit": lookup(_UNITS, F.lower(word)),
        },
        {
            f"_{into}_measure": F.when(priced, F.concat(F.lit("per_"), shown_qty, unit)),
            f"_{into}_base": F.when(comparable, per_base),
            f"_{into}_base_name": F.when(comparable, base_name),
        },
    ]


def unit_price(into: str) -> dict[str, Column]:
    """Value, measure, comparable value and its measure, after the steps."""
    found = {"value": "value", "measure": "measure", "norm_value": "base", "norm_measure": "base_name"}
    columns = {name: F.col(f"_{into}_{step}") for name, step in found.items()}
    return columns | {"norm_value": round_exact(columns["norm_value"], 4)}


def with_unit_price(df: DataFrame, raw: str, into: str) -> DataFrame:
    parts = F.struct(*[column.alias(name) for name, column in unit_price(into).items()])
    return staged(df, unit_price_steps(F.col(raw), into)).select(
        *[F.col(f"`{name}`") for name in df.columns], parts.alias(into)
    )
