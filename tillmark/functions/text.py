"""Text clean-up as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmark.functions import fixed_values as fixed
from tillmark.functions.staged import Steps

_CASED = r"a-z\p{Lu}\p{Ll}\p{Lt}"
_INNER_START = rf"([^ {_CASED}])(?=[{_CASED}])"
_MARK = "\u0001 "


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(fixed.WHITESPACE))


def strip_plain(text: Column) -> Column:
    """``strip`` for a plain column, which it mentions often: a text whose first and last characters
    are visible ASCII ones is left as it is, without the search of both ends."""
    last = F.substring(text.cast("binary"), -1, 1)
    clean = (text >= "!") & (text < "\x7f") & (last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))
    return F.when(clean, text).otherwise(strip(text))


def is_empty(text: Column) -> Column:
    """True for NULL and for the empty text; never NULL."""
    return F.coalesce(text == "", F.lit(True))


def title_case(text: Column) -> Column:
    """Capitalise every letter that follows a non-letter, lower-case the others.

    ``initcap`` starts words at spaces only, so a start after any other character first
    gets a marked space, which is taken out again afterwards.
    """
    lower = F.lower(text)
    marked = F.regexp_replace(lower, _INNER_START, f"$1{_MARK}")
    anywhere = F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))
    return F.when(lower.rlike("[^ a-z]"), anywhere).otherwise(F.initcap(lower))


def lookup(pairs: dict[str, str], key: Column) -> Column:
    """Value of ``key`` in a small fixed table, NULL when it is not there."""
    entries = ", ".join(quoted(part) for pair in pairs.items() for part in pair)
    return F.try_element_at(F.expr(f"map({entries})"), key)


def quoted(text: str) -> str:
    """A SQL literal. One parsed expression is cheaper to build than many literal columns."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def package_size_label(size: Column) -> Column:
    spaced = F.regexp_replace(size, r"(\d)pk\b", "$1 pack")
    return _or_blank(size, strip(_capital_litre(spaced)))


def unit_size_label(size: Column) -> Column:
    single = F.replace(strip_plain(size), F.lit("1 each"), F.lit("each"))
    return _or_blank(size, _capital_litre(F.lower(single)))


def repaired_name(name: Column) -> Column:
    """Name with ``gm``, ``pk`` and ``l`` after numbers spelled as in the other feeds."""
    grams = F.regexp_replace(name, "gm$", "g")
    packs = F.regexp_replace(grams, r"(?<=\d)pk", " pack")
    return _or_blank(name, F.regexp_replace(packs, r"(?<=\d)l", "L"))


def barcode(sku: Column) -> Column:
    """A barcode that went through a float column loses its ``.0``."""
    return _or_blank(sku, F.regexp_replace(strip(sku), r"\.0$", ""))


def category_label(category: Column) -> Column:
    return label_of_spaced(_spaced(category))


def spaced_steps(category: Column, into: str) -> Steps:
    """What ``label_of_spaced`` makes a label of."""
    return [{into: _spaced(category)}]


def label_of_spaced(spaced: Column) -> Column:
    return F.when(is_empty(spaced), fixed.OTHER_CATEGORY).otherwise(title_case(strip_plain(spaced)))


def _spaced(category: Column) -> Column:
    return F.replace(F.replace(category, F.lit("--"), F.lit(" ")), F.lit("-"), F.lit(" "))


def slug_category(slug: Column) -> Column:
    plain = strip(slug)
    named = F.coalesce(lookup(fixed.SLUG_CATEGORIES, F.lower(plain)), plain)
    return F.when(is_empty(slug), fixed.OTHER_CATEGORY).otherwise(title_case(named))


def leading_brand(name: Column) -> Column:
    """The one or two capitalised all-letter words a name starts with, else its first word."""
    return F.nullif(_brand(strip(name)), F.lit(""))


def brand_steps(name: Column, into: str) -> Steps:
    """The same as steps."""
    plain, brand = F.col(f"_{into}_name"), F.col(f"_{into}_words")
    return [{f"_{into}_name": strip_plain(name)}, {f"_{into}_words": _brand(plain)}, {into: F.when(brand != "", brand)}]


def _brand(plain: Column) -> Column:
    brand = F.regexp_extract(plain, r"^(\p{Lu}\p{L}*(?:\s+\p{Lu}\p{L}*)?(?=\s|$)|\S+)", 1)
    return F.regexp_replace(brand, r"\s+", " ")


def availability(status: Column) -> Column:
    return F.coalesce(lookup(fixed.AVAILABILITY, F.lower(strip_plain(status))), F.lit("unknown"))


def any_special(*fields: Column) -> Column:
    """True when at least one cell says anything but "no"."""
    flag = F.lit(False)
    for field in fields:
        word = F.lower(strip_plain(field))
        flag = flag | F.coalesce(~word.isin("", *fixed.NOT_SPECIAL_WORDS), F.lit(False))
    return flag


def match_key(brand: Column, name: Column, size: Column) -> Column:
    """Brand, product and size in one text for matching across feeds."""
    return F.trim(F.concat_ws(" ", brand, name, size))


def _capital_litre(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=\d)l\b", "L")


def _or_blank(raw: Column, cleaned: Column) -> Column:
    return F.when(is_empty(raw), "").otherwise(cleaned)
