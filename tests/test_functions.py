"""Literal inputs and the values they must give."""

import pytest
from pyspark.sql import functions as F

from tillmark.functions import keys, lists, numbers, text
from tillmark.functions.staged import staged
from tillmark.functions.taxonomy import with_category
from tillmark.functions.unit_price import canonical_unit, with_unit_price

SUPPLIERS = (
    "['97446 CARTER & SPENCER GROUP P/L', '939301 FRESH PRODUCE DC (WA)', "
    "\"635235 COSTA'S P/L (VIC DC)\", '414760 ST GEORGE PROD PTY LTD']"
)


def check(evaluate, function, cases):
    got = evaluate([(given,) for given, _ in cases], function)
    assert list(zip([given for given, _ in cases], got)) == [(given, want) for given, want in cases]


def check_steps(spark, steps, function, cases):
    table = spark.createDataFrame([(i, given) for i, (given, _) in enumerate(cases)], "id long, cell string")
    result = staged(table, steps(F.col("cell"), "parsed")).select("id", function(F.col("parsed")).alias("result"))
    got = [row.result for row in result.orderBy("id").collect()]
    assert list(zip([given for given, _ in cases], got)) == [(given, want) for given, want in cases]


UNIT_PRICES = [
    ("$11.16 per 100g", (11.16, "per_100g", 111.6, "per_kg")),
    ("3c per tablet", (0.03, "per_each", 0.03, "per_each")),
    ("$2.58 per 100mL", (2.58, "per_100ml", 25.8, "per_l")),
    ("2.46 per litre", (2.46, "per_l", 2.46, "per_l")),
    ("5.50 per kg", (5.5, "per_kg", 5.5, "per_kg")),
    ("$24.75 per 1Kg", (24.75, "per_kg", 24.75, "per_kg")),
    ("$3.00 / 100g", (3.0, "per_100g", 30.0, "per_kg")),
    ("$0.58 / 100G", (0.58, "per_100g", 5.8, "per_kg")),
    ("$20.00 per 1L", (20.0, "per_l", 20.0, "per_l")),
    ("", (None, None, None, None)),
    (None, (None, None, None, None)),
    ("n/a", (None, None, None, None)),
    ("nan", (None, None, None, None)),
    ("5.00 per widget", (5.0, None, None, None)),
    ("4.00 per 4x100g", (4.0, None, None, None)),
    ("$1 per 0.5kg", (1.0, "per_0.5kg", 2.0, "per_kg")),
    ("$5 per 100", (5.0, None, None, None)),
    ("$1,234.50 per kg", (1.0, "per_kg", 1.0, "per_kg")),
    ("Super $3 per kg", (None, None, None, None)),
    ("$3 per 0g", (3.0, "per_0g", None, None)),
    ("  50C PER 2 Each ", (0.5, "per_2each", 0.25, "per_each")),
    ("$50c per kg", (50.0, "per_kg", 50.0, "per_kg")),
    ("1.2.3 per kg", (None, None, None, None)),
    ("2 per 1.2.3kg", (None, None, None, None)),
    ("10 per 250\tmg", (10.0, "per_250mg", 40000.0, "per_kg")),
    ("25.80005 per kg", (25.80005, "per_kg", round(25.80005 / 1000.0 * 1000.0, 4), "per_kg")),
    ("7 per 3 pack", (7.0, "per_3each", 2.3333, "per_each")),
    ("$3 per\n100g", (3.0, "per_100g", 30.0, "per_kg")),
]


def test_unit_price(spark):
    rows = [(i, raw) for i, (raw, _) in enumerate(UNIT_PRICES)]
    table = with_unit_price(spark.createDataFrame(rows, "id long, raw string"), "raw", "unit")
    got = [tuple(row.unit) for row in table.orderBy("id").collect()]
    assert list(zip([raw for raw, _ in UNIT_PRICES], got)) == UNIT_PRICES


def test_comparable_prices_order_as_they_should():
    wanted = dict(UNIT_PRICES)
    assert wanted["$20.00 per 1L"][2] < wanted["$2.58 per 100mL"][2]


def test_canonical_unit(evaluate):
    check(evaluate, canonical_unit, [("Litre", "l"), (" KG ", "kg"), ("pk", "each"), ("washes", "each"), ("x", None)])


def test_list_items(spark):
    cases = [
        ("['Bakery']", ["Bakery"]),
        ("[]", []),
        (None, []),
        ("", []),
        ("nan", []),
        ("None", []),
        ("['a', 'b',]", ["a", "b"]),
        ("('a', \"b\")", ["a", "b"]),
        ("[1, None]", ["1", "None"]),
        ("['  a ', ' ', '']", ["a"]),
        (r"['it\'s', 'x\\y']", ["it's", "x\\y"]),
        ("['a, b', 'c']", ["a, b", "c"]),
        ("plain", ["plain"]),
        ("['a', 'b", ["a", "b"]),
        ("['LEO'S', 'x']", ["LEO'S", "x"]),
        ("\"635 L'OREAL\"", ["635 L'OREAL"]),
        ("[ ]", []),
        ("['a']['b']", ["a']['b"]),
    ]
    check_steps(spark, lists.item_steps, lists.items, cases)


def test_list_items_like_literals(spark):
    """Escapes and numbers as a literal parser reads them."""
    import ast

    cells = [
        r"['a\tb']", r"['caf\xe9', 'x']", r"['\u4e2d\u00e9']", r"""['a\\b', 'it\'s', "q\"q"]""", r"['\q', 'a\\tb', 'c\\']",
        r"['a\nb', 'c']", "[1.50, +1]", "[.5, 1., -0.10, 007.5]", "[0, 00, -0, 10, 100]", "['x', 10.0, -3.1400, 1.05]",
        "[True, None, -.25, 'y']", """['a "b" c']""", "['tab\\there']", r"['a/b\\/c']",
    ]
    cases = [(cell, [text for item in ast.literal_eval(cell) if (text := str(item).strip())]) for cell in cells]
    check_steps(spark, lists.item_steps, lists.items, cases)


def test_supplier_list_with_mixed_quotes(spark):
    items = lists.with_items(spark.createDataFrame([(SUPPLIERS,)], "cell string"), F.col("cell"), "items").first().items
    assert len(items) == 4
    assert items[0] == "97446 CARTER & SPENCER GROUP P/L"
    assert "635235 COSTA'S P/L (VIC DC)" in items


def test_long_list_has_no_limit(spark):
    cell = "[" + ", ".join(f"'item {i}'" for i in range(50_000)) + "]"
    items = lists.with_items(spark.createDataFrame([(cell,)], "cell string"), F.col("cell"), "items").first().items
    assert len(items) == 50_000 and items[-1] == "item 49999"


def test_first_item(spark):
    cases = [
        ("[]", "unknown"),
        ("['Bakery']", "Bakery"),
        (None, "unknown"),
        ("['', '  ', ' a b ', 'c']", "a b"),
        ("x", "x"),
        ("['LEO'S', 'x']", "LEO'S"),
        (SUPPLIERS, "97446 CARTER & SPENCER GROUP P/L"),
    ]
    check_steps(spark, lists.item_steps, lists.first_item, cases)


def test_primary_department(spark):
    cases = [
        ("['Bakery']", "Bakery"),
        ("['Meat, Seafood & Deli', 'Dairy, Eggs & Fridge']", "Meat Seafood & Deli"),
        ("['Liquor']", None),
        ("['Tobacco Product']", None),
        ("['Tobacco Product', 'Liquor']", None),
        ("['Liquor', 'Pantry']", "Pantry"),
        ("[]", "NOT LISTED"),
        (None, "NOT LISTED"),
        ("", "NOT LISTED"),
        ("['']", "NOT LISTED"),
        ("Bakery", "Bakery"),
        ("[\"Baker's\"]", "Bakers"),
    ]
    check_steps(spark, lists.department_steps, lists.primary_department, cases)


def test_price_amount(evaluate):
    cases = [
        ("$17.00", 17.0),
        ("1,234.50", 1234.5),
        ("", None),
        (None, None),
        ("nan", None),
        ("None", None),
        (" $ 5 ", 5.0),
        ("1_000", 1000.0),
        ("1d", None),
        ("0x10", None),
        ("-3", -3.0),
        ("1e3", 1000.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("abc", None),
        ("+nan", None),
        ("inf", float("inf")),
    ]
    check(evaluate, numbers.price_amount, cases)


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_round_exact_rounds_the_binary_value(evaluate, digits):
    import random

    rng = random.Random(7)
    values = [25.80005, 2.675, 1.005, 0.5, 0.25, 0.125, 1e15 + 0.3, 1e17, 0.0, -2.675, -0.25]
    values += [round(rng.uniform(0, 2000), digits + 1) for _ in range(3000)]
    values += [rng.randrange(1, 10**7) / 2 * 10.0**-digits for _ in range(3000)]
    got = evaluate([(v,) for v in values], lambda v: numbers.round_exact(v, digits), ["a double"])
    assert got == [round(v, digits) for v in values]


def test_double_text(evaluate):
    values = [0.0, 1.5, 1000.01, 12345678.9, 2e7, 1e15, 1e16, 1.5e17, 0.0005, 0.00005, -0.0005, 1e300, -3.0, float("inf")]
    got = evaluate([(v,) for v in values], numbers.double_text, ["a double"])
    assert got == [repr(v) for v in values]


def test_brand(evaluate):
    cases = [
        ("Diet Coke Soft Drink 600ml", "Diet Coke"),
        ("granny smith apple", "granny"),
        (None, None),
        ("", None),
        ("  ", None),
        ("Diet 7Up", "Diet"),
        ("Diet   Coke2", "Diet"),
        ("A1 Sauce", "A1"),
        ("Éclair Noir x", "Éclair Noir"),
        ("Bega", "Bega"),
        ("Two  Spaces x", "Two Spaces"),
    ]
    check(evaluate, text.leading_brand, cases)


def test_availability(evaluate):
    cases = [
        ("Available", "available"),
        (" In Stock ", "available"),
        ("Sold Out", "unavailable"),
        ("Unavailable", "unavailable"),
        (None, "unknown"),
        ("weird", "unknown"),
    ]
    check(evaluate, text.availability, cases)


def test_any_special(evaluate):
    cases = [("TRUE", True), ("Save $2", True), (None, False), ("", False), (" No ", False), ("0", False), ("nan", False)]
    check(evaluate, text.any_special, cases)
    several = [("", None, "false"), (None, "x", None)]
    assert evaluate(several, lambda *f: text.any_special(*f), ("a", "b", "c")) == [False, True]
    assert evaluate([("x",)], lambda _: text.any_special()) == [False]


def test_surrogate_sku(evaluate):
    rows = [
        ("Aldi", "Essential Health Paw Paw Ointment ea", "https://shop/x"),
        (" ALDI", "Essential Health Paw Paw Ointment ea ", "https://shop/x"),
        ("Aldi", "Product B", "https://shop/x"),
        ("Aldi", "Product B", None),
    ]
    first, same, other, no_url = evaluate(rows, keys.surrogate_sku, ("a", "b", "c"))
    assert first == same and len(first) == 16
    assert len({first, other, no_url}) == 3
    import hashlib

    assert no_url == hashlib.md5(b"aldi|product b|").hexdigest()[:16]


def test_missing_sku_shares_one_product_key(evaluate):
    import hashlib

    got = evaluate([("IGA", None), ("IGA", "")], keys.hash_key, ("a", "b"))
    assert got == [hashlib.md5(b"IGA").hexdigest(), hashlib.md5(b"IGA|").hexdigest()]


def test_canonical_category(spark):
    cases = [
        (("groceries", "health"), ("Health & Beauty", "Health")),
        (("fruit-vegetables", None), ("Fresh Food", "Fruit & Vegetables")),
        (("fruit-&-veg", "fruit"), ("Fresh Food", "Fruit & Vegetables")),
        (("Health Beauty", ""), ("Health & Beauty", "Health & Beauty")),
        (("Meat  Seafood", None), ("Fresh Food", "Meat & Seafood")),
        (("MysteryDept", None), ("Mysterydept", "Mysterydept")),
        (("soft drinks extra", "nothing"), ("Soft Drinks Extra", "Soft Drinks Extra")),
        (("234966 Leo'S Import And Distributors P/", None), ("Other", "Other")),
        (("720488 L'Oreal Aust P/L\"]", None), ("Other", "Other")),
        ((None, None), ("Other", "Other")),
        (("  ", None), ("Other", "Other")),
        ((None, "pet"), ("Pet", "Pet")),
    ]
    table = spark.createDataFrame([(i, *given) for i, (given, _) in enumerate(cases)], "id long, main string, sub string")
    got = with_category(table, F.col("main"), F.col("sub")).orderBy("id").collect()
    assert [(given, (row.canonical_l1, row.canonical_l2)) for (given, _), row in zip(cases, got)] == cases
    alone = with_category(table.filter("sub is null"), F.col("main")).orderBy("id").collect()
    assert [(row.canonical_l1, row.canonical_l2) for row in alone] == [want for (_, sub), want in cases if sub is None]


def test_slug_category(evaluate):
    cases = [
        ("freezer", "Frozen"),
        (None, "Other"),
        ("", "Other"),
        ("health", "Health & Beauty"),
        (" Fresh Product ", "Dairy Eggs & Fridge"),
        ("pet", "Pet"),
    ]
    check(evaluate, text.slug_category, cases)


def test_package_size(evaluate):
    cases = [("6pk", "6 pack"), ("500l", "500L"), (None, ""), ("500ml ", "500ml"), ("6pkx", "6pkx"), ("2l 4pk", "2L 4 pack")]
    check(evaluate, text.package_size_label, cases)


def test_unit_size(evaluate):
    check(evaluate, text.unit_size_label, [("1 each", "each"), ("1 Each", "1 each"), ("21 each", "2each"), ("2L", "2L"), (None, "")])


def test_category_label(evaluate):
    cases = [
        ("fruit--veg", "Fruit Veg"),
        ("soft-drinks", "Soft Drinks"),
        (None, "Other"),
        ("", "Other"),
        (" ", ""),
        ("leo's", "Leo'S"),
        ("3am SNACKS", "3Am Snacks"),
    ]
    check(evaluate, text.category_label, cases)


def test_title_case_matches_str_title(evaluate):
    words = ["leo's soft-drinks", "ÉCLAIR au café", "x1y2", "a.b_c", "", "HELLO wOrld", "don't (stop)", "ÿ z"]
    assert evaluate([(w,) for w in words], text.title_case) == [w.title() for w in words]


def test_repaired_name(evaluate):
    cases = [
        ("rice 500gm", "rice 500g"),
        ("cola 8pk", "cola 8 pack"),
        ("milk 2l", "milk 2L"),
        ("juice 600ml", "juice 600ml"),
        ("gm 5gm x", "gm 5gm x"),
        (None, ""),
    ]
    check(evaluate, text.repaired_name, cases)


def test_barcode(evaluate):
    check(evaluate, text.barcode, [("9300675009775.0", "9300675009775"), (None, ""), ("12.05", "12.05"), (" 7.0 ", "7")])


def test_strip_removes_all_white_space(evaluate):
    assert evaluate([(" \t x 　\n",)], text.strip) == ["x"]


def test_match_key(evaluate):
    rows = [("Bega", "Cheese", "500g"), (None, "Cheese", ""), ("Bega", None, None)]
    assert evaluate(rows, text.match_key, ("a", "b", "c")) == ["Bega Cheese 500g", "Cheese", "Bega"]


def test_date_key(evaluate):
    assert evaluate([("2021-04-23",)], lambda d: keys.date_key(F.to_date(d))) == [20210423]
