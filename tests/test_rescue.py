"""Cells beyond a file's header are kept in ``_rescued_data``."""

import json

from tillmark.sources.feeds import ALDI
from tillmark.sources.raw_files import list_files, read_feed

HEADER = "Date,Product,Price,Unit Price,Main Category,Sub Category,Product Page"
ROWS = {
    "even": ("2024-01-01,even,$1.00,u,m,s,p", None),
    "longer": ('2024-01-01,longer,$2.00,u,m,s,p,extra,,"a ""b"", c","",é', {"_c7": "extra", "_c9": 'a "b", c', "_c10": "", "_c11": "é"}),
    "quoted, name": ('2024-01-01,"quoted, name",$3.00,u,"m,n",s,p,x', {"_c7": "x"}),
    "no cells": ("2024-01-01,no cells,$3.50,u,m,s,p,,,", None),
    "shorter": ("2024-01-01,shorter,$4.00", None),
}


def rows_of(spark, tmp_path, header, lines):
    folder = tmp_path / "date=2024-01-01"
    folder.mkdir()
    (folder / "aldi.csv").write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return read_feed(spark, ALDI, list_files(spark, str(tmp_path)))


def test_surplus_and_missing_cells(spark, tmp_path):
    rows = rows_of(spark, tmp_path, HEADER, [line for line, _ in ROWS.values()])
    found = {row["Product"]: row for row in rows.collect()}
    assert {name: row._rescued_data and json.loads(row._rescued_data) for name, row in found.items()} == {name: extra for name, (_, extra) in ROWS.items()}
    assert found["longer"]["Product_Page"] == "p" and found["quoted, name"]["Main_Category"] == "m,n"
    assert found["shorter"]["Price"] == "$4.00" and found["shorter"]["Unit_Price"] is None
    # the same when few columns are asked for
    assert rows.select("_rescued_data").where("_rescued_data is not null").count() == 2
    assert rows.select("Price").where("_rescued_data like '%extra%'").collect() == [("$2.00",)]


def test_surplus_beside_unknown_columns(spark, tmp_path):
    row = rows_of(spark, tmp_path, HEADER + ",Colour", [f"2024-01-01,{end}" for end in ("one,$1,u,m,s,p,red,more", "two,$1,u,m,s,p,,more", "three,$1,u,m,s,p,red")])
    found = {one["Product"]: json.loads(one._rescued_data) for one in row.collect()}
    assert found == {"one": {"Colour": "red", "_c8": "more"}, "two": {"_c8": "more"}, "three": {"Colour": "red"}}
