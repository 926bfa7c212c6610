"""List cells such as ``['Bakery', "Baker's Own"]`` as arrays of text.

A regular expression puts a separator after each item, one match after the other from the
start of the list. That keeps the work inside generated code, has no limit on the number
of items, and leaves whatever is no item behind the last separator.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions import fixed_values as fixed
from tillmark.functions.staged import Steps, staged
from tillmark.functions.text import is_empty, strip, strip_plain

# Marks that no cell holds: after an item, before a number, for a backslash.
_SEP, _NUMBER, _BACKSLASH = "\u0001", "\u0002", "\u0003"
# A backslash and what may follow it; other spellings of characters make the cell no list.
_ESCAPE = r"\\(?:x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|[^xuUN0-7])"
_SINGLE = rf"'([^'\\]*+(?:{_ESCAPE}[^'\\]*+)*+)'"
_DOUBLE = rf'"([^"\\]*+(?:{_ESCAPE}[^"\\]*+)*+)"'
_BARE = r"([+-]?(?:0+|[1-9]\d*|\d+\.\d*|\.\d+)|None|True|False)"
_ITEM = rf"(?s)\G\s*(?:{_SINGLE}|{_DOUBLE}|{_BARE})\s*(?:,|$)"
_QUOTED_COMMA = r"""['"],\s*['"]"""
_QUOTES = " '\""


def _charset(chars: str) -> str:
    return "".join(f"\\x{{{ord(char):x}}}" for char in chars)


_SPACE = _charset(fixed.WHITESPACE)
_FIRST = rf"^[{_SPACE}{_SEP}]*+([^{_SEP}]*[^{_SPACE}{_SEP}])"


def item_steps(cell: Column, into: str) -> Steps:
    """Text ``into``: the items, each closed by a separator.

    A cell that is no list is cut at its quoted commas.
    """
    text, found = F.col(f"_{into}_text"), F.col(f"_{into}_found")
    joined = _joined(found)
    loose = F.regexp_replace(F.trim(text, F.lit("[]")), _QUOTED_COMMA, _SEP)
    loose = F.regexp_replace(F.trim(loose, F.lit(_QUOTES)), f"[{_charset(_QUOTES)}]*{_SEP}[{_charset(_QUOTES)}]*", _SEP)
    blank = is_empty(text) | text.isin(*fixed.EMPTY_LISTS)
    return [
        {f"_{into}_text": strip_plain(cell)},
        {f"_{into}_found": _found(text)},
        {into: F.when(blank, "").when(_complete(joined), _unescaped(joined)).otherwise(loose)},
    ]


def department_steps(cell: Column, into: str) -> Steps:
    """The same for departments, whose names may themselves carry a comma.

    A cell that is no list is one department.
    """
    text, found = F.col(f"_{into}_text"), F.col(f"_{into}_found")
    joined = _joined(found)
    commas = fixed.COMMA_DEPARTMENTS.items()
    named = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), commas, strip(cell))
    listed = F.replace(_unescaped(joined), F.lit("'"), F.lit(""))
    return [
        {f"_{into}_text": F.coalesce(named, F.lit(""))},
        {f"_{into}_found": _found(text)},
        {into: F.when(_complete(joined), listed).otherwise(F.trim(text, F.lit("[]'\" ")))},
    ]


def first_item(separated: Column, default: str = "unknown") -> Column:
    """First non-blank item, stripped."""
    first, later = strip_plain(F.substring_index(separated, _SEP, 1)), F.regexp_extract(separated, _FIRST, 1)
    return F.coalesce(*[F.when(item != "", item) for item in (first, later)], F.lit(default))


def items(separated: Column) -> Column:
    """All non-blank items, stripped, as an array."""
    tight = F.regexp_replace(separated, f"[{_SPACE}]*{_SEP}[{_SPACE}]*", _SEP)
    return F.array_remove(F.split(strip(tight), _SEP), "")


def primary_department(separated: Column) -> Column:
    """First department that is in scope; NULL when all of them are out of scope."""
    excluded = F.array(*[F.lit(name) for name in fixed.EXCLUDED_DEPARTMENTS])
    listed = F.when(strip(F.replace(separated, F.lit(_SEP), F.lit(""))) == "", F.array(F.lit(fixed.NO_DEPARTMENT)))
    return F.get(F.array_except(listed.otherwise(items(separated)), excluded), F.lit(0))


def with_items(df: DataFrame, cell: Column, into: str) -> DataFrame:
    """Add array ``into`` of the items of a list cell."""
    steps = item_steps(cell, f"_{into}_separated")
    return staged(df, steps).select(
        *[F.col(f"`{name}`") for name in df.columns], items(F.col(f"_{into}_separated")).alias(into)
    )


def _found(text: Column) -> Column:
    """Items with separators, numbers marked; NULL when the cell has no brackets."""
    bracketed = (text.startswith("[") & text.endswith("]")) | (text.startswith("(") & text.endswith(")"))
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    found = F.regexp_replace(inner, _ITEM, f"$1$2{_NUMBER}$3{_SEP}")
    return F.when(bracketed, F.replace(found, F.lit(_NUMBER + _SEP), F.lit(_SEP)))


def _joined(found: Column) -> Column:
    """The same with the numbers as they are printed."""
    return F.when(found.contains(_NUMBER), _plain_numbers(found)).otherwise(found)


def _plain_numbers(found: Column) -> Column:
    """Numbers, which a mark precedes, the way they are printed: no plus sign, a digit on both
    sides of the point, no zeros at the end."""
    steps = [
        (f"{_NUMBER}\\+", _NUMBER),
        (f"{_NUMBER}-?0+{_SEP}", f"{_NUMBER}0{_SEP}"),
        (f"{_NUMBER}(-?)0*(\\d*)\\.(\\d*?)0*{_SEP}", f"{_NUMBER}$10$2.$30{_SEP}"),
        (f"{_NUMBER}(-?)0([1-9]\\d*\\.)", f"{_NUMBER}$1$2"),
        (f"{_NUMBER}(-?\\d+\\.\\d*[1-9])0{_SEP}", f"{_NUMBER}$1{_SEP}"),
    ]
    plain = reduce(lambda text, step: F.regexp_replace(text, *step), steps, found)
    return F.replace(plain, F.lit(_NUMBER), F.lit(""))


def _complete(joined: Column) -> Column:
    """True when nothing but items was found."""
    rest = F.substring_index(joined, _SEP, -1)
    return (rest == "") | (strip(rest) == "")


def _unescaped(joined: Column) -> Column:
    """Escapes as the characters they stand for. Backslashes that stand for themselves are set
    aside, the others spelled as in JSON, which then reads them all."""
    kept = F.replace(joined, F.lit("\\\\"), F.lit(_BACKSLASH))
    steps = [
        (r"\\\n", ""),
        (r"\\(['\"])", "$1"),
        (r"\\a", r"\\u0007"),
        (r"\\v", r"\\u000b"),
        (r"\\x", r"\\u00"),
        (r"\\(?![bfnrtu])", _BACKSLASH),
    ]
    spelled = reduce(lambda text, step: F.regexp_replace(text, *step), steps, kept)
    spelled = F.replace(F.replace(spelled, F.lit('"'), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    read = F.from_json(F.concat(F.lit('["'), spelled, F.lit('"]')), "array<string>", {"allowUnquotedControlChars": "true"})
    return F.when(joined.contains("\\"), F.coalesce(F.get(read, F.lit(0)), joined)).otherwise(joined)
