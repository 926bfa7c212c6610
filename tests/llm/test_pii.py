"""Added spans: recall and precision on documents that were not learnt from, windows left out,
overlaps settled, redaction of odd rows."""

import random

import pytest

from tillmark.llm import pii

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").orderBy("doc_id").collect()
    return [row.text for row in rows]


@pytest.fixture(scope="module")
def model(spark, texts):
    return pii.trained([text[:4000] for text in texts[::2]])


def test_held_out_recall_and_precision(model, texts):
    """Spans beyond the base patterns, in forms like those learnt, in other documents."""
    windows = pii.labelled_windows([text[:4000] for text in texts[1::2]], seed=99)
    tagger = pii.Tagger(model.values)
    wanted = hit = added = right = 0
    for spans, (*_, labels, text) in zip(pii.added_spans([one[-1] for one in windows], tagger), windows, strict=True):
        base = pii.base_spans(text)
        beyond = {span for span in labels if span[1:] not in {own[1:] for own in base}}
        got = set(pii.reconciled(base, spans, model.confidence)) - set(base)
        wanted, hit, added, right = wanted + len(beyond), hit + len(beyond & got), added + len(got), right + len(got & set(labels))
    assert wanted > 100
    assert hit >= 0.9 * wanted, (hit, wanted)
    assert right >= 0.9 * added, (right, added)


def test_windows_without_a_sign_have_nothing_to_give(model, texts):
    """All windows decoded give the same spans as those with a digit or an at sign."""
    tagger = pii.Tagger(model.values)
    some = [*texts[:120], "a b c" * 60, "1", "x" * 79 + "@", ""]
    every = pii.added_spans(some, tagger, starts=lambda text: pii.window_starts(len(text)))
    # surenesses differ in the last digits, as the batches do
    for few, all_windows in zip(pii.added_spans(some, tagger), every, strict=True):
        assert {span for _, span in few} == {span for _, span in all_windows}


def test_reconciled_like_a_plain_comparison():
    pick = random.Random(2)
    for _ in range(200):
        def spans(count):
            return [(pick.choice(pii.KINDS), at, at + pick.randint(1, 9)) for at in (pick.randint(0, 60) for _ in range(count))]

        base, added = spans(4), sorted(((pick.random(), span) for span in spans(12)), key=lambda one: -one[0])
        taken, want = [span[1:] for span in base], list(base)
        for level, span in added:
            if level >= 0.3 and all(span[2] <= start or span[1] >= end for start, end in taken):
                taken.append(span[1:])
                want.append(span)
        assert sorted(pii.reconciled(base, added, 0.3)) == sorted(want)


def test_many_spans_take_time_in_proportion():
    base = [("phone", at, at + 5) for at in range(0, 400_000, 20)]
    added = [(0.9, ("email", at, at + 5)) for at in range(7, 400_000, 20)]
    assert len(pii.reconciled(base, added, 0.5)) == 40_000


def test_redacted_rows(spark, model):
    schema = "doc_id long, text string, base_spans string, All_Spans int, lang string"
    rows = [(1, "mail a@b.cd now", "x", 1, None), (1, "mail a@b.cd now", "x", 1, None), (None, None, None, None, "en"), (2, "", "", 2, ""), (3, "x" * 50_000 + " 10.0.0.1", "", 3, "de")]
    got = pii.redacted(spark.createDataFrame(rows, schema), model)
    assert got.columns == ["doc_id", "text", "base_spans", "All_Spans", "lang"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == sorted(
        [(1, "mail [EMAIL] now", "x", 1, None)] * 2 + [rows[2], rows[3], (3, "x" * 50_000 + " [IP]", "", 3, "de")], key=str
    )
    assert pii.redacted(spark.createDataFrame([], schema), model).collect() == []


def test_training_sample_is_bounded_and_the_same_each_time(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    one = pii.training_texts(df, count=40, length=500)
    assert one == pii.training_texts(df.repartition(5), count=40, length=500)
    assert 20 < len(one) <= 40 and max(map(len, one)) <= 500
    assert pii.training_texts(df.where("false")) == []
