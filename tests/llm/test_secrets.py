"""Every character of every candidate is read, and the fitted model keeps the recall asked for."""

import re

import numpy as np
import pytest

from tillmark.llm import secrets

SF = "/root/testdata/sf0.01"
SECRET = "sK7fQ2mZp9LxT4vBn8WcR3yHd6Gj"


def test_parts_beside_base_spans():
    hex_piece = "0123456789abcdef"
    text = f"see {SECRET}-{hex_piece}/{SECRET}_{hex_piece}.x end"
    spans, others = secrets.scan(text)
    at = [found.start() for found in re.finditer(hex_piece, text)]
    assert [start for kind, start, _ in spans if kind == "hex"] == at
    assert others == [(4, at[0]), (at[0] + 16, at[1])]
    places = [(0, 40), (50, 70), (80, 100)]
    free = {n for start, end in places for n in range(start, end)} - set(range(15, 20)) - set(range(38, 52)) - set(range(81, 95))
    kept = secrets.apart(places, [("hex", 15, 20), ("hex", 38, 52), ("hex", 81, 95)])
    assert kept == [(0, 15), (20, 38), (52, 70)] and free.issuperset(n for start, end in kept for n in range(start, end))


@pytest.mark.parametrize("length", [12, 48, 49, 58, 72, 73, 96, 97, 500])
def test_bodies_hold_every_character(length):
    bodies = secrets.windows(7, 7 + length)
    assert all(7 <= start < end <= 7 + length and end - start <= secrets.BODY for start, end in bodies)
    assert all(any(start <= at and at + secrets.BODY // 2 <= end for start, end in bodies) for at in range(7, 7 + max(1, length - secrets.BODY // 2 + 1))) or length < 24


def test_secret_in_the_middle_of_a_long_run(spark):
    """A network that answers to upper-case letters only sees them wherever they stand."""
    network = secrets.Network()
    values = {name: np.zeros_like(value) for name, value in network.values.items()}
    for group in (5, 6):  # classes of A-F and G-Z, in a body
        values["filters"][:, group + secrets.CHARACTERS.count] = 1
    values["dense"][:], values["out"][:], values["out_shift"][:] = 0.1, 1, -4
    model = secrets.Model(values, (1.0, 0.0), 0.5)
    texts = ["a " + "p" * before + "QWERTYUIOP" + "q" * behind + " z" for before in range(0, 120, 5) for behind in (0, 30, 60)]
    texts += ["a " + "p" * 100 + " z", f"a {'p' * 40}QWERTYUIOP-0123456789abcdef"]
    rows = secrets.found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    found = {row.doc_id: [one.kind for one in row.all_spans] for row in rows}
    candidates = [len(secrets.CANDIDATE.findall(text)) for text in texts]
    assert [found[n].count("model") for n in range(len(texts))] == [min(count, "Q" in text) for text, count in zip(texts, candidates, strict=True)]


@pytest.fixture(scope="module")
def texts(spark):
    return secrets.training_texts(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.mark.parametrize("rounds", [0, 1, secrets.ROUNDS])
def test_recall_of_held_out_findings(texts, rounds):
    """However well the network is trained, the threshold keeps the share asked for."""
    model = secrets.trained(texts, rounds=rounds)
    views, labels = secrets.labelled_candidates(texts)
    chosen = np.random.default_rng(5).permutation(len(labels))[: secrets.TRAIN_CANDIDATES * 5 // 4]
    held = chosen[len(chosen) * 4 // 5 :]
    over = model.scores(secrets.Network(model.values).forward(views[held])[0]) >= model.threshold
    print("rounds", rounds, "threshold", model.threshold, "recall", model.recall, "precision", model.precision)
    assert model.recall >= secrets.RECALL
    assert over[labels[held] == 1].mean() == pytest.approx(model.recall, abs=0.002)


def test_recall_of_other_findings(spark, texts):
    """Findings of other documents and another seed, which took no part in the fit."""
    model = secrets.trained(texts)
    others = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(400)
    known = set(texts)
    views, labels = secrets.labelled_candidates([row.text[:4_000] for row in others.collect() if row.text and row.text not in known], seed=99)
    over = model.scores(secrets.Network(model.values).forward(views)[0]) >= model.threshold
    print("other findings", labels.sum(), "recall", over[labels == 1].mean(), "others", (labels == 0).sum(), "taken", over[labels == 0].mean())
    assert over[labels == 1].mean() >= secrets.RECALL - 0.02
