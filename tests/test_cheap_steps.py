"""Parsers that do each piece of work once: the same results, fewer evaluations."""

import random
import re

from pyspark.sql import functions as F

from tillmark.functions import lists, numbers, text
from tillmark.functions.unit_price import with_unit_price
from tillmark.operators.quality import product_name_rule
from tillmark.plans.conform import conform
from tillmark.sources import types
from tillmark.sources.feeds import COLES, IGA

SPACES = [" ", "\t", "\n", "\xa0", "\x85", " ", "\x1c"]


def made(pieces, n=400, longest=8):
    rng = random.Random(7)
    return [None, "", *("".join(rng.choices(pieces, k=rng.randint(1, longest))) for _ in range(n))]


def column(spark, cells):
    return spark.createDataFrame([(i, cell) for i, cell in enumerate(cells)], "id int, cell string")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plain_texts_are_stripped_like_others(spark):
    cells = column(spark, made([*SPACES, "a", "Z", "~", "!", "\x7f", "é", "€", "\x00"]))
    odd = cells.filter(~text.strip_plain(F.col("cell")).eqNullSafe(text.strip(F.col("cell"))))
    assert odd.count() == 0


def test_unit_price_cells_are_cut_at_the_first_per_or_slash(spark):
    cells = made(["per", "PER", "Per", "/", " ", "\xa0", "$", "1", "2.5", "c", "C", "g", "kg", "each", "pe", "r", "x", "\n", "\x85"], 1500)
    rows = {r.cell: r.u for r in with_unit_price(column(spark, cells), "cell", "u").collect() if r.cell is not None}
    space = "[ \t\n\x0b\f\r\xa0]"
    for cell, got in rows.items():
        halves = re.split(f"(?i){space}*(?:per|/){space}*", cell.strip(), maxsplit=1, flags=re.A)
        amount = re.search(r"[0-9.]+", halves[0]) if len(halves) == 2 else None
        quantity = re.match(r"([0-9.]+)?[ \t\n\x0b\f\r]*([a-zA-Z]+)", halves[1]) if len(halves) == 2 else None
        readable = quantity is None or quantity[1] is None or _number(quantity[1]) is not None
        shown = _number(amount[0]) if amount and readable else None
        cents = "$" not in halves[0] and re.search("[0-9]c\\b|[cC]$", halves[0].rstrip("\x85"), re.A)
        wanted = shown / 100 if cents and shown is not None else shown
        assert got.value == wanted or abs(got.value - wanted) < 1e-4, cell


def _number(word):
    try:
        return float(word)
    except ValueError:
        return None


def test_numbers_are_the_same_texts_as_before(spark):
    before = r"^[+-]?(?:\d(?:_?\d)*\.?(?:\d(?:_?\d)*)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?$|^[+-]?(?i:inf(?:inity)?)$"
    cells = column(spark, made(["1", "23", "_", ".", "e", "E", "+", "-", "inf", "INFINITY", "nan", "d", "f", "0x"], 1500, 5))
    plain = F.col("cell")
    wanted = F.when(plain.rlike(before), F.translate(plain, "_", "").try_cast("double"))
    assert cells.filter(~numbers.to_double(plain).eqNullSafe(wanted)).count() == 0


def test_cells_are_stripped_and_items_found_once(spark):
    raw = column(spark, ["x"]).select(*[F.lit("['a']").alias(name) for name in COLES.stored_headers])
    lineage = {"_source_file": F.lit("f"), "_ingest_ts": F.current_timestamp(), "_snapshot_date": F.current_date()}
    from_rows = column(spark, ["x"]).select(*[F.concat("cell", F.lit(name)).alias(name) for name in raw.columns]).withColumns(lineage)
    shown = plan(conform(from_rows.repartition(2), COLES).select("primary_supplier"))
    assert shown.count(lists._ITEM[:12]) == 1
    masks = plan(types.type_masks(from_rows.repartition(2), ["SKU"]))
    assert masks.count("trim(") == 1


def test_cell_classes(spark):
    cells = {
        None: 0, " ": 0, "true": 1, "FALSE ": 1, "12": 2, "+7": 2, "99999999999": 4, "9999999999999999999": 8, "1.5": 8,
        ".5e3": 8, "1e400": 8, "2021-04-23": 16, "2021-13-23": 64, "2021-04-23 10:00": 32, "x": 64, "-": 64, "/": 64, ",": 64,
        "é": 64, "1x": 64,
    }
    found = types.type_masks(column(spark, []).withColumnRenamed("cell", "c"), ["c"]).count()
    assert found == 0
    for cell, mask in cells.items():
        rows = types.type_masks(column(spark, [cell]), ["cell"]).collect()
        assert [row.mask for row in rows] == [mask], cell


def test_typed_cells_that_a_cast_takes(spark):
    cells = column(spark, [" yes", "T", "0", "maybe", "", None, "7", "+7 ", "-", "99999999999", "1.5", "\x007"])
    for kind in ("boolean", "int", "bigint", "double"):
        wanted = [r[0] for r in cells.select(text.strip(F.col("cell")).try_cast(kind)).collect()]
        rows = types.typed(cells, {"cell": kind}).collect()
        assert [row.cell for row in rows] == wanted
        kept = [row._rescued_data is not None for row in rows]
        assert kept == [w is None and c.cell not in ("", None) for w, c in zip(wanted, cells.collect())]


def test_labels_and_names_of_odd_texts(spark):
    cells = column(spark, made([*SPACES, "a", "B", "-", "--", "é", "ß", "Σ", "1", "'s", "cd"], 600))
    spaced = F.replace(F.replace("cell", F.lit("--"), F.lit(" ")), F.lit("-"), F.lit(" "))
    marked = F.regexp_replace(F.lower(spaced), text._INNER_START, f"$1{text._MARK}")
    titled = text.strip(F.replace(F.initcap(marked), F.lit(text._MARK), F.lit("")))
    wanted = F.when(text.is_empty(F.col("cell")), "Other").otherwise(titled)
    assert cells.filter(~text.category_label(F.col("cell")).eqNullSafe(wanted)).count() == 0
    missing = product_name_rule(F.col("cell")).fails
    assert cells.filter(missing != F.coalesce(text.strip(F.col("cell")) == "", F.lit(True))).count() == 0
    assert IGA.columns["main_category"].parse is not None
