"""Benchmark spans over a limit are cut out of the texts, nothing else is touched."""

from collections import Counter

from tillmark.llm import decontaminate

ITEM = " ".join(f"q{n}" for n in range(40))
SHORT = "red green blue"


def test_limits(spark):
    benchmark = spark.createDataFrame([(1, ITEM), (2, SHORT)], "item_id long, text string")
    filler = " ".join(f"w{n}" for n in range(2_000))
    rows = [
        (1, f"A, {ITEM.upper()}! b"),  # covered: cut
        (2, f"{filler} {ITEM} end"),  # under the coverage limit, over the length limit: cut
        (3, f"{filler} {SHORT} end"),  # under both: kept
        (4, f"x {SHORT}, y {SHORT}-z"),  # covered, two spans
        (5, "é 漢字 clean"), (6, None), (7, ""), (7, ""),
    ]
    docs = spark.createDataFrame([(*row, "c", 1) for row in rows], "doc_id long, text string, hit_spans string, N_Words int")
    got = decontaminate.spans_removed(docs, benchmark)
    assert got.columns == docs.columns
    want = [(1, "A, ! b"), (2, f"{filler}  end"), rows[2], (4, "x , y -z"), *rows[4:]]
    assert Counter((row.doc_id, row.text) for row in got.collect()) == Counter(want)
    assert decontaminate.spans_removed(docs.where("false"), benchmark).collect() == []
    assert decontaminate.spans_removed(docs, benchmark.where("false")).collect() == docs.collect()
