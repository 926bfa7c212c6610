"""Secret scan: base patterns and a character convolutional network over all candidates.

Base patterns give assigned passwords and tokens, access keys and long hexadecimal strings.
Every run of twelve or more token characters is a candidate, and where base findings touch one,
each part of twelve or more that they leave free. The network reads its characters with the
surrounding context and scores it; a long candidate is read in overlapping windows and its
score is that of its best one. Candidates over the threshold are added whole under the kind
``model``.

The network is trained on labelled findings: base findings of all documents and generated
secrets of other forms put into them, against all other candidates. Tasks train it in numpy, each
on its part of the documents, and their weights are averaged after every round. On a held-out
fifth of the documents scores are calibrated, and the threshold is the highest that still finds
the required share of the labelled findings. ``trained`` does the same with texts at hand.
"""

from __future__ import annotations

import pickle
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.common import SPANS, checkpointed, count_of, joined_spans, small_batches, span_rows, text_pass
from tillmark.llm.neural import Adam, CharClasses, sigmoid

KINDS = ("assign", "access", "hex", "model")
LEFT, BODY, RIGHT = 24, 48, 8
WIDTH = LEFT + BODY + RIGHT
KERNEL, FILTERS, DENSE = 5, 16, 16
# The training sample (smallest by a hash) and the rounds over it.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 600, 4_000
TRAIN_CANDIDATES, ROUNDS, BATCH, RATE = 6_000, 6, 64, 0.01
# Rounds of training in tasks, the views that a trainer shall have at least, and the views that are
# wanted in all rounds together: small tables are gone through several times, large ones once.
MEETINGS, TRAINER_VIEWS, TRAINERS, WANTED_VIEWS = 6, 6_000, 64, 36_000
# Steps of the raw score in which the held-out views are counted, and its bounds.
SCORE_STEP, SCORE_BOUND = 0.01, 100.0
# Share of the held-out labelled findings that the threshold must keep.
RECALL = 0.98
CHARACTERS = CharClasses(
    ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "_", ".", "-", "=", ":", "\"'`", " ", "\n\r\t", "#$%&*!@", "(){}[]<>", ",;")
)

# Base patterns, fixed by the query's contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
LEAST_ASSIGNED = 12
LEAST_CANDIDATE = 12

Span = tuple[str, int, int]


def scan(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Base findings by start, then kind, and the candidates beside them.

    Access keys and hexadecimal strings consist of token characters and are longer than the
    shortest candidate, so they are searched inside the candidates only.
    """
    spans: list[Span] = []
    low = text.lower()
    if any(name in low for name in NAMES):
        for match in ASSIGN.finditer(text):
            if match.end(2) - match.start(2) >= LEAST_ASSIGNED:
                spans.append(("assign", *match.span()))
    places = [match.span() for match in CANDIDATE.finditer(text)]
    for start, end in places:
        if end - start >= 16:
            spans += [("access", *match.span()) for match in ACCESS.finditer(text, start, end)]
            spans += [("hex", *match.span()) for match in HEX.finditer(text, start, end)]
    spans.sort(key=order)
    return spans, apart(places, spans)


def order(span: Span) -> tuple:
    return span[1], KINDS.index(span[0]), span[2]


def apart(places: list[tuple[int, int]], spans: list[Span]) -> list[tuple[int, int]]:
    """The parts of places that no span covers, if long enough for a candidate; both are sorted
    by start, places do not overlap each other."""
    taken, at, reach, kept = sorted((start, end) for _, start, end in spans), 0, 0, []
    for start, end in places:
        start = max(start, reach)
        while at < len(taken) and taken[at][0] < end:
            if taken[at][0] - start >= LEAST_CANDIDATE:
                kept.append((start, taken[at][0]))
            reach = max(reach, taken[at][1])
            start = max(start, reach)
            at += 1
        if end - start >= LEAST_CANDIDATE:
            kept.append((start, end))
    return kept


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """The bodies in which a candidate is read: each character, and each run of up to half a
    body, lies in one of them whole."""
    if end - start <= BODY:
        return [(start, end)]
    return [(at, at + BODY) for at in [*range(start, end - BODY, BODY // 2), end - BODY]]


def view(classes: np.ndarray, start: int, end: int) -> np.ndarray:
    """A body and its context as classes; those of the body are shifted up."""
    made = np.zeros(WIDTH, np.uint8)
    left = classes[max(0, start - LEFT) : start]
    made[LEFT - len(left) : LEFT] = left
    made[LEFT : LEFT + end - start] = classes[start:end] + CHARACTERS.count
    right = classes[end : end + RIGHT]
    made[LEFT + BODY : LEFT + BODY + len(right)] = right
    return made


class Network:
    """One convolution, the strongest answer of each filter inside and around, two dense steps."""

    def __init__(self, values: dict[str, np.ndarray] | None = None, seed: int = 5):
        if values is None:
            made = np.random.default_rng(seed)
            values = {
                "filters": made.normal(0, 0.3, (KERNEL, 2 * CHARACTERS.count, FILTERS)),
                "shift": np.zeros(FILTERS),
                "dense": made.normal(0, 0.3, (3 * FILTERS, DENSE)),
                "dense_shift": np.zeros(DENSE),
                "out": made.normal(0, 0.3, DENSE),
                "out_shift": np.zeros(1),
            }
            values["filters"][:, 0] = 0
            values = {name: value.astype(np.float32) for name, value in values.items()}
        self.values = values
        places = WIDTH - KERNEL + 1
        self.parts = (slice(0, LEFT - KERNEL + 1), slice(LEFT - KERNEL + 1, LEFT + BODY), slice(LEFT + BODY - KERNEL + 1, places))

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        v, places = self.values, WIDTH - KERNEL + 1
        answers = v["filters"][0][x[:, :places]] + v["shift"]
        for k in range(1, KERNEL):
            answers += v["filters"][k][x[:, k : k + places]]
        tops = [answers[:, part].argmax(axis=1) + part.start for part in self.parts]
        pooled = np.concatenate([np.take_along_axis(answers, top[:, None], 1)[:, 0] for top in tops], axis=1)
        lifted = np.maximum(pooled, 0)
        deep = np.maximum(lifted @ v["dense"] + v["dense_shift"], 0)
        return deep @ v["out"] + v["out_shift"], (tops, pooled, lifted, deep)

    def slopes(self, x: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        v = self.values
        scores, (tops, pooled, lifted, deep) = self.forward(x)
        wrong = (weights * (sigmoid(scores) - labels) / len(x)).astype(np.float32)
        slopes = {"out": deep.T @ wrong, "out_shift": np.array([wrong.sum()], np.float32)}
        inner = wrong[:, None] * v["out"] * (deep > 0)
        slopes["dense"], slopes["dense_shift"] = lifted.T @ inner, inner.sum(axis=0)
        pool = (inner @ v["dense"].T) * (pooled > 0)
        slopes["filters"], slopes["shift"] = np.zeros_like(v["filters"]), np.zeros_like(v["shift"])
        rows, filters = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        for number, top in enumerate(tops):
            part = pool[:, number * FILTERS : (number + 1) * FILTERS]
            slopes["shift"] += part.sum(axis=0)
            for k in range(KERNEL):
                np.add.at(slopes["filters"][k], (x[rows, top + k], np.broadcast_to(filters, top.shape)), part)
        return slopes


@dataclass(frozen=True)
class Model:
    """Weights, calibration (slope, shift) of the raw scores, the threshold, and the recall and
    precision it reached on the held-out candidates."""

    values: dict[str, np.ndarray]
    calibration: tuple[float, float]
    threshold: float
    recall: float = float("nan")
    precision: float = float("nan")

    def scores(self, raw: np.ndarray) -> np.ndarray:
        slope, shift = self.calibration
        return sigmoid(slope * raw.astype(float) + shift)


def _generated(made: random.Random) -> tuple[str, str]:
    """A secret and what leads to it, in forms that the base patterns partly do not know."""

    def some(letters: str, count: int) -> str:
        return "".join(made.choice(letters) for _ in range(count))

    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    every = upper + lower + digits
    value = made.choice(
        [
            some(every, made.randint(20, 48)), some(every + "+/", 40), some("0123456789ABCDEF", 32), some("0123456789abcdef", 40),
            "AKIA" + some(upper + digits, 16), some(every, 12) + "." + some(every + "_-", 24) + "." + some(every + "_-", 20), "key_" + some(every, 24),
        ]
    )
    lead = made.choice(["password = ", "token: ", 'secret="', "api_key=", "Authorization: Bearer ", "credential: ", "private_key ", "auth ", "", ""])
    return lead, value


def _run_of_words(made: random.Random) -> str:
    """An ordinary run of token characters, such as a path or a dotted name."""
    words = ("".join(made.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(made.randint(3, 9))) for _ in range(made.randint(2, 9)))
    return made.choice("/._-=").join(words)


def labelled_candidates(texts: list[str], seed: int = 13, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Views of candidates and whether they are secrets: some of each text, or ``every`` one."""
    made, views, labels = random.Random(seed), [], []

    def keep(text: str, start: int, end: int, label: int) -> None:
        near = max(0, start - LEFT)
        views.append(view(CHARACTERS.of(text[near : end + RIGHT]), start - near, end - near))
        labels.append(label)

    def keep_others(text: str, start: int, end: int) -> None:
        parts = windows(start, end)
        for part in parts if every else made.sample(parts, min(3, len(parts))):
            keep(text, *part, 0)

    for text in texts:
        spans, others = scan(text)
        for _, start, end in spans if every else spans[:5]:
            inner = list(CANDIDATE.finditer(text, start, end))
            if inner:
                keep(text, *windows(*inner[-1].span())[-1], 1)
        for start, end in others if every else made.sample(others, min(6, len(others))):
            keep_others(text, start, end)
        blanks = [match.start() for match in re.finditer(" ", text if every else text[:2_000])]
        for place in made.sample(blanks, min(3, len(blanks))):
            window, after = text[max(0, place - LEFT) : place] + " ", text[place + 1 : place + 40]
            lead, value = _generated(made)
            last = made.choice([" ", '" ', "\n", ", "])
            if made.random() < 0.3:  # the secret in the middle of a run, and a run without one
                before, behind = _run_of_words(made) + made.choice("/=._-"), made.choice("/=._-") + _run_of_words(made)
                plain = _run_of_words(made) + "/" + _run_of_words(made)
                keep_others(window + plain + last + after, len(window), len(window) + len(plain))
                first, whole = len(window) + len(before), window + before + value + behind + last + after
                begin, stop = len(window), len(window) + len(before) + len(value) + len(behind)
            else:
                first, whole = len(window) + len(lead), window + lead + value + last + after
                begin, stop = list(CANDIDATE.finditer(whole, len(window), first + len(value)))[-1].span()
            # the body that holds most of the secret
            body = max(windows(begin, stop), key=lambda part: min(part[1], first + len(value)) - max(part[0], first))
            keep(whole, *body, 1)
    return np.array(views, np.uint8).reshape(-1, WIDTH), np.array(labels, np.float32)


def trained(texts: list[str], kept: int = TRAIN_CANDIDATES, rounds: int = ROUNDS, seed: int = 5) -> Model:
    """A network trained on four fifths of the candidates; the rest calibrates it and sets the
    threshold. With too few candidates nothing is learnt and nothing is ever added."""
    views, labels = labelled_candidates(texts)
    mixed = np.random.default_rng(seed)
    chosen = mixed.permutation(len(labels))[: kept * 5 // 4]
    views, labels = views[chosen], labels[chosen]
    split = len(labels) * 4 // 5
    network = Network(seed=seed)
    share = labels[:split].mean() if split else 0.0
    if split < 2 * BATCH or not 0 < share < 1 or not 0 < labels[split:].mean() < 1:
        return Model(network.values, (1.0, 0.0), float("inf"))
    steps = Adam(network.values, RATE)
    for turn in range(rounds):
        steps.rate = RATE * (1 - turn / rounds)
        order_now = mixed.permutation(split)
        for at in range(0, split - BATCH + 1, BATCH):
            some = order_now[at : at + BATCH]
            _step(network, steps, views[some], labels[some], share)
    raw, truth = network.forward(views[split:])[0].astype(float), labels[split:]
    model = Model(network.values, _calibration(raw, truth, np.ones(len(raw))), float("inf"))
    scores = model.scores(raw)
    found = np.sort(scores[truth == 1])
    threshold = float(found[int((1 - RECALL) * len(found))])
    over = scores >= threshold
    return replace(model, threshold=threshold, recall=float(over[truth == 1].mean()), precision=float(truth[over].mean()))


def _step(network: Network, steps: Adam, views: np.ndarray, labels: np.ndarray, share: float) -> None:
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    steps.step(network.slopes(views, labels, weights))


def _calibration(raw: np.ndarray, truth: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Logistic calibration of raw scores, each of which occurs ``counts`` times."""
    slope, shift, total = 1.0, 0.0, counts.sum()
    for _ in range(200):
        wrong = counts * (sigmoid(slope * raw + shift) - truth)
        slope -= 0.1 * float((wrong * raw).sum() / total) / max(1.0, float((counts * raw * raw).sum() / total) / 4)
        shift -= 0.5 * float(wrong.sum() / total)
    return slope, shift


def labelled_views(documents: DataFrame) -> DataFrame:
    """Views of every labelled candidate of every whole text: ``mixed`` (a hash that tells which
    document it comes from), ``place`` in it, ``label`` and ``view``."""
    small_batches(documents.sparkSession)
    rows = documents.where("text is not null").select(F.xxhash64("doc_id", "text").alias("mixed"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mixed, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                views, labels = labelled_candidates([text], mixed, every=True)
                for at in range(0, len(labels), 8_192):
                    part = slice(at, at + 8_192)
                    some = [one.tobytes() for one in views[part]]
                    columns = ([mixed] * len(some), range(at, at + len(some)), labels[part].astype(np.int32), some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column, kind) for column, kind in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                        names=["mixed", "place", "label", "view"],
                    )

    return rows.mapInArrow(run, "mixed long, place int, label int, view binary")


def trained_on_all(documents: DataFrame, seed: int = 5) -> Model:
    """A network trained on every labelled candidate of four fifths of the documents, whole texts;
    all of the other fifth calibrate it and set the threshold. No view passes through the driver:
    it sees the weights of the trainers and counts of scores. With too few candidates nothing is
    learnt and nothing is ever added."""
    held, network = F.pmod("mixed", F.lit(5)) == 0, Network(seed=seed)
    views = checkpointed(labelled_views(documents))
    counts = {(row.held, row.label): row["count"] for row in views.groupBy(held.alias("held"), "label").count().collect()}
    known, secret = (sum(counts.get((False, label), 0) for label in labels) for labels in ((0, 1), (1,)))
    if known < 2 * BATCH or not 0 < secret < known or not all(counts.get((True, label)) for label in (0, 1)):
        return Model(network.values, (1.0, 0.0), float("inf"))
    trainers = max(1, min(TRAINERS, known // TRAINER_VIEWS))
    turns = max(1, min(ROUNDS, -(-WANTED_VIEWS // known)))
    # every meeting takes the views of its own share of the places, so a turn takes each view once
    dealt = F.pmod(F.xxhash64("mixed", "place"), F.lit(MEETINGS))
    train = checkpointed(
        views.where(~held).withColumn("meeting", dealt).repartition(trainers, "mixed", "place").sortWithinPartitions("meeting", F.xxhash64("place", "mixed"), "mixed", "place")
    )
    steps_done, values = 0, network.values
    for turn in range(turns):
        for meeting in range(MEETINGS):
            rate = RATE * (1 - steps_done / (turns * MEETINGS))
            values = _met(train.where(F.col("meeting") == meeting), values, rate, secret / known)
            steps_done += 1
    return _with_threshold(values, views.where(held))


def _met(views: DataFrame, values: dict[str, np.ndarray], rate: float, share: float) -> dict[str, np.ndarray]:
    """The weights after each task has trained on its views, averaged by how many those were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, count = Network({name: value.copy() for name, value in values.items()}), 0
        steps, views, labels = Adam(network.values, rate), [], []
        for batch in batches:
            views += batch.column(1).to_pylist()
            labels += batch.column(0).to_pylist()
            full = len(views) // BATCH * BATCH
            for at in range(0, full, BATCH):
                some = slice(at, at + BATCH)
                _step(network, steps, _stacked(views[some]), np.array(labels[some], np.float32), share)
            count, views, labels = count + full, views[full:], labels[full:]
        if views:
            _step(network, steps, _stacked(views), np.array(labels, np.float32), share)
        if count + len(views):
            yield pa.RecordBatch.from_arrays([pa.array([count + len(views)], pa.int64()), pa.array([pickle.dumps(network.values)], pa.binary())], names=["n", "values"])

    made = views.select("label", "view").mapInArrow(run, "n long, values binary").collect()
    if not made:
        return values
    made = sorted((row.n, bytes(row["values"])) for row in made)
    total, parts = sum(n for n, _ in made), [(n, pickle.loads(packed)) for n, packed in made]
    return {name: sum(n * part[name].astype(float) for n, part in parts).astype(np.float32) / np.float32(total) for name in values}


def _with_threshold(values: dict[str, np.ndarray], views: DataFrame) -> Model:
    """Calibration and threshold from all views, counted by label and step of the raw score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(values)
        for batch in batches:
            if batch.num_rows:
                raw = np.clip(network.forward(_stacked(batch.column(1).to_pylist()))[0], -SCORE_BOUND, SCORE_BOUND)
                steps = np.floor(raw.astype(float) / SCORE_STEP).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(steps)], names=["label", "step"])

    counted = views.select("label", "view").mapInArrow(run, "label int, step int").groupBy("label", "step").count().orderBy("step", "label").collect()
    truth, step, count = (np.array([row[name] for row in counted], float) for name in ("label", "step", "count"))
    slope, shift = _calibration((step + 0.5) * SCORE_STEP, truth, count)
    model = Model(values, (slope, shift), float("inf"))
    if slope <= 0:
        return model
    secrets = np.where(truth == 1, count, 0)
    missed = np.cumsum(secrets) - secrets  # findings below each step
    lowest = step[np.flatnonzero((missed <= (1 - RECALL) * secrets.sum()) & (truth == 1))[-1]]
    over = step >= lowest
    # half a millionth of a step lower, so that no score on the border falls below by rounding
    threshold = float(model.scores(np.array([(lowest - 1e-6) * SCORE_STEP]))[0])
    return replace(model, threshold=threshold, recall=float(secrets[over].sum() / secrets.sum()), precision=float(secrets[over].sum() / count[over].sum()))


def _stacked(views: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(views), np.uint8).reshape(-1, WIDTH)


def training_texts(documents: DataFrame, count: int = SAMPLE_DOCUMENTS, length: int = SAMPLE_CHARACTERS) -> list[str]:
    """A bounded sample: half documents with a digit run of some length, half others, up to
    ``length`` characters of each around the first such place."""
    hint = "[0-9A-Z]{2}[0-9a-zA-Z]{8}"
    at = F.greatest(F.regexp_instr("text", F.lit("[0-9]")) - length // 2, F.lit(1))
    rows = documents.where("text is not null").select(F.xxhash64("text").alias("mixed"), F.substr("text", at, F.lit(length)).alias("text"))
    parts = [rows.where(f"{kind} text rlike '[0-9]{{2}}[0-9a-zA-Z]{{4}}|{hint}'") for kind in ("", "not")]
    picked = []
    for part in parts:  # hashes are shuffled, texts only once the sample is known
        chosen = F.broadcast(part.select("mixed").distinct().orderBy("mixed").limit(count // 2))
        picked.append(part.join(chosen, "mixed").groupBy("mixed").agg(F.min("text").alias("text")).orderBy("mixed").collect())
    return [row.text for some in picked for row in some]


FIELDS = T.StructType([T.StructField("base_spans", SPANS), T.StructField("all_spans", SPANS)])


def found(df: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``all_spans``: (kind, start, end) by start, then kind.

    Whole texts are read; offsets are code points, ends exclusive. Null and empty texts have no
    spans. Rows keep their number, repeated rows give repeated results, an empty table stays
    empty, columns of these names are replaced. One narrow pass without a shuffle.
    """

    def start():
        network = Network(model.values)

        def judged(views: list[np.ndarray], owners: list[int]) -> set[int]:
            """Candidates with a body over the threshold."""
            parts = [network.forward(np.stack(views[at : at + 512]))[0] for at in range(0, len(views), 512)]
            over = model.scores(np.concatenate(parts)) >= model.threshold
            return set(np.array(owners)[over].tolist())

        def work(texts: list[str | None]) -> list:
            base, places, views, owners = [], [], [], []
            secret: set[int] = set()
            for number, text in enumerate(texts):
                spans, others = scan(text) if text else ([], [])
                base.append(spans)
                classes = CHARACTERS.of(text) if others else None
                for start, end in others:
                    for part in windows(start, end):
                        views.append(view(classes, *part))
                        owners.append(len(places))
                        if len(views) == 8_192:
                            secret |= judged(views, owners)
                            views, owners = [], []
                    places.append((number, start, end))
            if views:
                secret |= judged(views, owners)
            whole = [list(spans) for spans in base]
            for place in sorted(secret):
                number, start, end = places[place]
                whole[number].append(("model", start, end))
            for spans in whole:
                spans.sort(key=order)
            return [list(map(span_rows, side)) for side in (base, whole)]

        return work

    return text_pass(df, column, FIELDS, start)


def secret_findings(documents: DataFrame) -> DataFrame:
    """Counts and digest of the base findings and all findings of every document."""
    rows = found(documents.select("doc_id", "text"), trained_on_all(documents))
    counts = [count_of("base_spans", kind).alias(f"n_{kind}") for kind in KINDS[:3]]
    return rows.select("doc_id", *counts, F.sha2(joined_spans("base_spans"), 256).alias("base_sha256"), joined_spans("all_spans").alias("spans"))
