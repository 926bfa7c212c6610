"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmark.functions.text import strip_plain


def hash_key(*parts: Column | str) -> Column:
    """md5 of the parts joined by ``|``; NULL parts are left out, as everywhere in the model."""
    return F.md5(F.concat_ws("|", *parts))


def surrogate_sku(retailer: Column, name: Column, url: Column) -> Column:
    """Stable 16-character product key for a feed that has none."""
    parts = [F.coalesce(F.lower(strip_plain(part)), F.lit("")) for part in (retailer, name, url)]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 16)


def date_key(day: Column | str) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")
