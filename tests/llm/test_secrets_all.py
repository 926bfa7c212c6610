"""The network of the secret scan learns from every candidate of every whole text."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm import secrets

SF = "/root/testdata/sf0.01"


def test_every_candidate_of_whole_texts_is_labelled(spark):
    """More documents and longer texts than a sample holds, a finding at the end of each."""
    count, long = secrets.SAMPLE_DOCUMENTS + 50, "plain words and_a_long_name here " * (secrets.SAMPLE_CHARACTERS // 20)
    texts = [f"{long} token={'0123456789abcdef' * 2}{n:04}" for n in range(count)]
    documents = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id long, text string").repartition(3)
    views = secrets.labelled_views(documents)
    found = Counter(row.label for row in views.where(F.col("mixed").isNotNull()).select("label").collect())
    spans, others = secrets.scan(texts[0])
    assert len(others) > 6 and len(spans) == 2
    # three generated ones per text beside all findings; runs without a secret may come with those
    assert found[1] == count * (len(spans) + 3) and found[0] >= count * len(others)


def test_threshold_keeps_the_share_of_all_held_out_findings(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = secrets.trained_on_all(documents)
    views = secrets.labelled_views(documents).where("pmod(mixed, 5) = 0").toPandas()
    raw = secrets.Network(model.values).forward(secrets._stacked(views.view.tolist()))[0]
    over, truth = model.scores(raw) >= model.threshold, views.label.to_numpy() == 1
    assert model.recall >= secrets.RECALL and over[truth].mean() == pytest.approx(model.recall, abs=0.002)
    assert truth[over].mean() == pytest.approx(model.precision, abs=0.002) and model.precision >= 0.95
    again = secrets.trained_on_all(documents.repartition(3))
    assert again.threshold == model.threshold
    assert all(np.array_equal(again.values[name], value) for name, value in model.values.items())


def test_nothing_to_learn_from(spark):
    for rows in ([], [(1, None)], [(1, "")], [(1, "password=abcdefghijklmnop")]):
        documents = spark.createDataFrame(rows, "doc_id long, text string")
        assert secrets.trained_on_all(documents).threshold == float("inf")
        assert secrets.secret_findings(documents).count() == len(rows)
