"""Numbers out of text, exact rounding and number texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmark.functions.staged import Steps
from tillmark.functions.text import strip, strip_plain

_DIGITS = r"\d++(?:_\d++)*+"
_DECIMAL = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$|^[+-]?(?i:inf(?:inity)?)$"
_LARGEST_FRACTION = float(2**52)
_SPLITTER = float(2**27 + 1)


def to_double(plain: Column) -> Column:
    """Number of a stripped text, NULL when it is none; hex, suffixes and NaN are no numbers."""
    return F.when(plain.rlike(_DECIMAL), F.replace(plain, F.lit("_"), F.lit("")).try_cast("double"))


def price_text(cell: Column) -> Column:
    """Price cell without dollar signs and thousands commas."""
    return strip(without_signs(cell))


def without_signs(cell: Column) -> Column:
    return F.replace(F.replace(cell, F.lit("$"), F.lit("")), F.lit(","), F.lit(""))


def price_amount(cell: Column) -> Column:
    return to_double(price_text(cell))


def price_steps(cell: Column, into: str) -> Steps:
    signless, plain = F.col(f"_{into}_signless"), F.col(f"_{into}_text")
    return [{f"_{into}_signless": without_signs(cell)}, {f"_{into}_text": strip_plain(signless)}, {into: to_double(plain)}]


def round_exact(value: Column, digits: int) -> Column:
    """Round the binary value itself, ties to even, rather than its shortest text.

    ``value * 10^digits`` is rounded once to a double; the part lost in that product is
    computed exactly by splitting the value in two halves, and decides apparent ties.
    Pass a plain column: the expression mentions it often.
    """
    scale = F.lit(float(10**digits))
    scaled = value * scale
    head = value * _SPLITTER - (value * _SPLITTER - value)
    lost = (head * scale - scaled) + (value - head) * scale
    beyond = scaled - F.rint(scaled)
    step = F.when((beyond == 0.5) & (lost > 0), 1.0).when((beyond == -0.5) & (lost < 0), -1.0).otherwise(0.0)
    return F.when(F.abs(scaled) < _LARGEST_FRACTION, (F.rint(scaled) + step) / scale).otherwise(value)


def double_text(value: Column) -> Column:
    """Shortest text of a double, plain from 1e-4 up to 1e16 and with an exponent beyond."""
    plain = value.cast("string")
    size = F.abs(value)
    digits = F.regexp_replace(value.try_cast("decimal(38,18)").cast("string"), "0+$", "")
    fixed_point = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(plain, "E", 1), r"\.0$", "")
    power = F.substring_index(plain, "E", -1).try_cast("int")
    sign = F.when(power < 0, "e-").otherwise("e+")
    exponent = F.concat(mantissa, sign, F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    infinite = F.when(value > 0, "inf").otherwise("-inf")
    return (
        F.when(size == float("inf"), infinite)
        .when(~plain.contains("E"), plain)
        .when((size >= 1e-4) & (size < 1e16), fixed_point)
        .otherwise(exponent)
    )
