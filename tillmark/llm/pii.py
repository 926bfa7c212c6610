"""Personal data: base patterns and a character BiLSTM with CRF transitions.

The base patterns give e-mail addresses, IP addresses, card and phone numbers. A bidirectional
LSTM over characters with a linear-chain CRF on top, trained in numpy from labelled spans,
adds spans that the patterns miss (other separators, blanks, missing prefixes). Texts are read
in overlapping windows; each window is decoded by itself. A span cut by a window's edge is left
to the neighbouring window that holds it whole; where none does, the window is grown and read
again until no edge cuts a span, however long it is. What all windows of a text found is
reconciled over the whole text: base spans stay, then the surest span wins an overlap.

A span must hold a digit or an at sign, so windows without either cannot give one and are not
decoded. Labelled spans are the base spans of a bounded sample of documents and generated ones
put into the same documents; part of them is held out to set the confidence a span needs.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.common import SPANS, count_of, first_places, joined_spans, shielded, span_rows, text_pass
from tillmark.llm.neural import Adam, CharClasses, sigmoid

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{mark}-{kind}" for kind in KINDS for mark in "BI"))
WINDOW, STRIDE = 80, 40
HIDDEN = 20
# The training sample: documents (smallest by a hash), windows of them, and rounds over them.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 800, 4_000
TRAIN_WINDOWS, ROUNDS, BATCH, RATE = 3_200, 12, 48, 0.025
# Share of held-out added spans that must be right at the confidence asked for.
PRECISION = 0.95
CHARACTERS = CharClasses(
    ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", " ", "\n\r\t", "@", ".", "-", "+", "(", ")", "_", "%", "/", ":", ",", "=", "#")
)

# Base patterns, fixed by the query's contract. An address needs its local part before the at
# sign, so it is searched from there; digits of an IP address start where a run of digits does.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    spans, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            spans.append(("email", start, found.end()))
        # only characters after this at sign, or after the match, can belong to a later one
        floor = found.end() if found else at + 1
        at = text.find("@", floor)
    return spans


def part_ok(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(letter for letter in text if "0" <= letter <= "9")


def base_spans(text: str) -> list[Span]:
    """Base matches by kind, then start; ends are exclusive code points."""
    spans = emails(text)
    spans += [("ip", *found.span()) for found in IP.finditer(text) if all(map(part_ok, found.groups()))]
    for found in CARD.finditer(text):
        if 16 <= found.end() - found.start() and 16 <= len(digits := digits_of(found.group())) <= 19 and luhn(digits):
            spans.append(("card", *found.span()))
    spans += [("phone", *found.span()) for found in PHONE.finditer(text) if 8 <= len(digits_of(found.group())) <= 15]
    return spans


# --- the network -----------------------------------------------------------------------


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Scores that forbid a span's inside tag without its beginning: (tag to tag, first tag)."""
    between, first = np.zeros((len(TAGS), len(TAGS)), np.float32), np.zeros(len(TAGS), np.float32)
    for to, tag in enumerate(TAGS):
        if tag[0] == "I":
            first[to] = -1e4
            for at, other in enumerate(TAGS):
                if other[1:] != tag[1:]:
                    between[at, to] = -1e4
    return between, first


BETWEEN, FIRST = _allowed()


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """Windows of character classes (time x batch) to tag scores, and the CRF over them."""

    def __init__(self, values: dict[str, np.ndarray] | None = None, seed: int = 7):
        made = np.random.default_rng(seed)
        if values is None:
            values = {}
            for side in ("f", "b"):
                values[f"x{side}"] = made.normal(0, 0.3, (CHARACTERS.count, 4 * HIDDEN))
                values[f"h{side}"] = made.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
                values[f"x{side}"][:, HIDDEN : 2 * HIDDEN] += 1.0  # remember at first
            values["out"] = made.normal(0, 0.3, (2 * HIDDEN, len(TAGS)))
            values["bias"] = np.zeros(len(TAGS))
            values["step"] = np.zeros((len(TAGS), len(TAGS)))
            values = {name: value.astype(np.float32) for name, value in values.items()}
        self.values = values

    def _lstm(self, x: np.ndarray, side: str, keep: bool = True) -> tuple[np.ndarray, list]:
        wide, deep = self.values[f"x{side}"], self.values[f"h{side}"]
        hidden = cell = np.zeros((x.shape[1], HIDDEN), np.float32)
        states, kept = np.empty((len(x), x.shape[1], HIDDEN), np.float32), []
        for at in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            gates = wide[x[at]] + hidden @ deep
            opened = sigmoid(gates[:, : 3 * HIDDEN])
            i, f, o = opened[:, :HIDDEN], opened[:, HIDDEN : 2 * HIDDEN], opened[:, 2 * HIDDEN :]
            g = np.tanh(gates[:, 3 * HIDDEN :])
            before, last = cell, hidden
            cell = f * cell + i * g
            flat = np.tanh(cell)
            hidden = o * flat
            states[at] = hidden
            if keep:
                kept.append((at, i, f, o, g, before, flat, last))
        return states, kept

    def _lstm_slopes(self, x: np.ndarray, side: str, kept: list, slope: np.ndarray, slopes: dict) -> None:
        deep = self.values[f"h{side}"]
        wide_slope, deep_slope = np.zeros_like(self.values[f"x{side}"]), np.zeros_like(deep)
        hidden_slope = cell_slope = np.zeros((x.shape[1], HIDDEN), np.float32)
        for at, i, f, o, g, before, flat, last in reversed(kept):
            to = slope[at] + hidden_slope
            cell_slope = cell_slope + to * o * (1 - flat * flat)
            gates = np.concatenate(
                [cell_slope * g * i * (1 - i), cell_slope * before * f * (1 - f), to * flat * o * (1 - o), cell_slope * i * (1 - g * g)], axis=1
            )
            np.add.at(wide_slope, x[at], gates)
            deep_slope += last.T @ gates
            hidden_slope, cell_slope = gates @ deep.T, cell_slope * f
        slopes[f"x{side}"], slopes[f"h{side}"] = wide_slope, deep_slope

    def scores(self, x: np.ndarray, keep: bool = True) -> tuple[np.ndarray, tuple]:
        """Tag scores and, if kept, what the slopes need."""
        ahead, kept_ahead = self._lstm(x, "f", keep)
        back, kept_back = self._lstm(x, "b", keep)
        both = np.concatenate([ahead, back], axis=2)
        return both @ self.values["out"] + self.values["bias"], (both, kept_ahead, kept_back)

    def _sums(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log sums over all paths up to and from each place, and over all."""
        step = self.values["step"] + BETWEEN
        up, down = np.empty_like(scores), np.zeros_like(scores)
        up[0] = scores[0] + FIRST
        for at in range(1, len(scores)):
            up[at] = scores[at] + _log_sum(up[at - 1][:, :, None] + step[None], 1)
        for at in range(len(scores) - 2, -1, -1):
            down[at] = _log_sum((scores[at + 1] + down[at + 1])[:, None, :] + step[None], 2)
        return up, down, _log_sum(up[-1], 1)

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        up, down, total = self._sums(scores)
        return np.exp(up + down - total[None, :, None])

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best tag path of each window (time x batch)."""
        step = self.values["step"] + BETWEEN
        best, back = scores[0] + FIRST, np.empty(scores.shape, np.int8)
        for at in range(1, len(scores)):
            ways = best[:, :, None] + step[None]
            back[at] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[at]
        path = np.empty(scores.shape[:2], np.int8)
        path[-1] = best.argmax(axis=1)
        for at in range(len(scores) - 1, 0, -1):
            path[at - 1] = np.take_along_axis(back[at], path[at][:, None].astype(np.int64), 1)[:, 0]
        return path

    def slopes(self, x: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the negative log likelihood of the labelled paths, by window."""
        scores, (both, kept_ahead, kept_back) = self.scores(x)
        up, down, total = self._sums(scores)
        wrong = np.exp(up + down - total[None, :, None])
        wrong -= np.eye(len(TAGS), dtype=np.float32)[tags]
        step = self.values["step"] + BETWEEN
        step_slope = np.zeros_like(self.values["step"])
        for at in range(1, len(x)):
            pair = up[at - 1][:, :, None] + step[None] + (scores[at] + down[at])[:, None, :] - total[:, None, None]
            step_slope += np.exp(pair).sum(axis=0)
        np.add.at(step_slope, (tags[:-1].ravel(), tags[1:].ravel()), -1)
        wrong /= x.shape[1]
        flat, flat_wrong = both.reshape(-1, 2 * HIDDEN), wrong.reshape(-1, len(TAGS))
        slopes = {"out": flat.T @ flat_wrong, "bias": flat_wrong.sum(axis=0), "step": step_slope / x.shape[1]}
        inner = wrong @ self.values["out"].T
        self._lstm_slopes(x, "f", kept_ahead, inner[:, :, :HIDDEN], slopes)
        self._lstm_slopes(x, "b", kept_back, inner[:, :, HIDDEN:], slopes)
        return slopes


# --- windows ---------------------------------------------------------------------------


def window_starts(length: int) -> range:
    return range(0, max(1, length - WINDOW + STRIDE), STRIDE)


def triggered(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an at sign.

    Every kind needs one of them, so ``read_spans`` takes no span without; a window that holds
    none therefore has none to give, and decoding it would change nothing (there is a test).
    """
    starts, seen = [], -1
    last = window_starts(len(text))[-1] // STRIDE
    for found in TRIGGER.finditer(text):
        first = max(0, (found.start() - WINDOW) // STRIDE + 1)
        for number in range(max(first, seen + 1), min(found.start() // STRIDE, last) + 1):
            starts.append(number * STRIDE)
            seen = number
    return starts


def padded(classes: list[np.ndarray]) -> np.ndarray:
    """Windows as columns, filled up with padding."""
    made = np.zeros((max([WINDOW, *map(len, classes)]), len(classes)), np.uint8)
    for column, window in enumerate(classes):
        made[: len(window), column] = window
    return made


def path_spans(path: np.ndarray) -> list[Span]:
    """Spans of one decoded window."""
    spans, begun = [], None
    for at, number in enumerate([*path.tolist(), 0]):
        if begun is not None and TAGS[number] != f"I-{begun[0]}":
            spans.append((*begun, at))
            begun = None
        if TAGS[number][0] == "B":
            begun = (TAGS[number][2:], at)
    return spans


@dataclass(frozen=True)
class Model:
    values: dict[str, np.ndarray]
    confidence: float


# A stretch of a text: its number, start and end.
Place = tuple[int, int, int]


def read_spans(texts: list[str], tagger: Tagger, places: list[Place], batch: int) -> Iterator[tuple[Place, float, Span]]:
    """Spans that hold a digit or an at sign, with their sureness, of every stretch."""
    classes: dict[int, np.ndarray] = {}
    at = 0
    while at < len(places):
        # long stretches are read in smaller batches
        some = places[at : at + max(1, batch * WINDOW // max(WINDOW, places[at][2] - places[at][1]))]
        at += len(some)
        wanted = {number for number, *_ in some}
        classes = {number: classes[number] if number in classes else CHARACTERS.of(texts[number]) for number in wanted}
        scores, _ = tagger.scores(padded([classes[number][start:end] for number, start, end in some]), keep=False)
        path = tagger.decode(scores)
        busy = np.flatnonzero((path > 0).any(axis=0))
        sure = tagger.marginals(scores[:, busy])
        for column, place in enumerate(busy.tolist()):
            number, start, stop = some[place]
            for kind, first, end in path_spans(path[:, place]):
                end = min(end, stop - start)
                if end <= first or not TRIGGER.search(texts[number], start + first, start + end):
                    continue
                tags = path[first:end, place].astype(np.int64)
                yield some[place], float(sure[np.arange(first, end), column, tags].min()), (kind, start + first, start + end)


def added_spans(
    texts: list[str], tagger: Tagger, batch: int = 256, starts: Callable[[str], Iterable[int]] = triggered
) -> list[list[tuple[float, Span]]]:
    """What the network finds in whole texts: sureness and span, windows put together."""
    places = [(number, start, min(start + WINDOW, len(text))) for number, text in enumerate(texts) if text for start in starts(text)]
    found: list[dict[Span, float]] = [{} for _ in texts]
    grown = False
    while places:
        cut: list[tuple[Place, Span]] = []
        whole: list[tuple[int, float, Span]] = []
        for place, level, span in read_spans(texts, tagger, places, batch):
            number, start, end = place
            if (span[1] == start and start > 0) or (span[2] == end and end < len(texts[number])):
                cut.append((place, span))
            else:
                whole.append((number, level, span))
        if grown:  # pieces of a span that is now whole
            ordered = {number: sorted(found[number], key=lambda span: span[1]) for number in {number for number, *_ in whole}}
            begins = {number: [span[1] for span in spans] for number, spans in ordered.items()}
            for number, _, (_, start, end) in whole:
                first, last = bisect_left(begins[number], start), bisect_left(begins[number], end)
                for span in ordered[number][first:last]:
                    if span[2] <= end and end - start > span[2] - span[1]:
                        found[number].pop(span, None)
        for number, level, span in whole:
            found[number][span] = max(level, found[number].get(span, 0.0))
        places, grown = larger(texts, found, cut), True
    return [sorted(((level, span) for span, level in spans.items()), key=lambda one: (-one[0], one[1][1:], one[1][0])) for spans in found]


def larger(texts: list[str], found: list[dict[Span, float]], cut: list[tuple[Place, Span]]) -> list[Place]:
    """Stretches grown to the sides where they cut a span that no found span holds, joined
    where they overlap; the longest first. Each grows by its own length, so that reading all of
    a long one costs a few times its length."""
    made: list[Place] = []
    held = {number: sorted(span[1:] for span in found[number]) for number in {place[0] for place, _ in cut}}
    reach = {number: list(accumulate((end for _, end in spans), max)) for number, spans in held.items()}
    for (number, start, end), (_, first, last) in cut:
        before = bisect_right(held[number], (first, len(texts[number])))
        if before and reach[number][before - 1] >= last:
            continue
        size = end - start
        left = max(0, start - size) if first == start else start
        made.append((number, left, min(len(texts[number]), end + size) if last == end else end))
    joined: list[Place] = []
    for number, start, end in sorted(made):
        if joined and joined[-1][0] == number and start < joined[-1][2]:
            joined[-1] = (number, joined[-1][1], max(end, joined[-1][2]))
        else:
            joined.append((number, start, end))
    return sorted(joined, key=lambda place: (place[1] - place[2], place))


def reconciled(base: list[Span], added: list[tuple[float, Span]], confidence: float) -> list[Span]:
    """Base spans and, surest first, added spans that overlap nothing taken before."""
    taken: list[tuple[int, int]] = []  # sorted, none overlaps another
    for _, start, end in sorted(base, key=lambda span: span[1:]):
        if taken and start < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(end, taken[-1][1]))
        else:
            taken.append((start, end))
    spans = list(base)
    for level, (kind, start, end) in added:
        if level < confidence:
            break
        at = bisect_left(taken, (start, end))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
            taken.insert(at, (start, end))
            spans.append((kind, start, end))
    return sorted(spans, key=lambda span: (KINDS.index(span[0]), span[1], span[2]))


# --- training --------------------------------------------------------------------------


def _generated(kind: str, made: random.Random) -> str:
    """A labelled example, partly of forms that the base patterns do not know."""

    def digits(count: int) -> str:
        return "".join(made.choice("0123456789") for _ in range(count))

    def letters(low: int, high: int) -> str:
        return "".join(made.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(made.randint(low, high)))

    if kind == "email":
        local = letters(2, 8) + made.choice(["", "." + letters(2, 7), "_" + digits(2), digits(2)])
        at = made.choice(["@", "@", " @ ", "@ "])
        return local + at + letters(3, 9) + made.choice([".com", ".org", ".net", ".co.uk", ".example.com"])
    if kind == "ip":
        return made.choice([".", ".", " . ", ". "]).join(str(made.randint(0, 255)) for _ in range(4))
    if kind == "card":
        number = made.choice("3456") + digits(14)
        number += next(digit for digit in "0123456789" if luhn(number + digit))
        return made.choice(["", " ", "-", ".", " - "]).join(number[at : at + 4] for at in range(0, 16, 4))
    area, first, last = digits(3), digits(3), digits(4)
    return made.choice(
        [f"+{digits(2)} {area} {first} {last}", f"+1-{area}-{first}-{last}", f"({area}) {first}-{last}", f"00{digits(2)} {area} {first}{last}", f"+{digits(2)}/{area}/{first}{last}", f"{area}-{first}-{last}"]
    )


def labelled_windows(texts: list[str], seed: int = 11) -> list[tuple[np.ndarray, np.ndarray, list[Span], str]]:
    """Windows with tags: real ones with their base spans, and the same with generated spans
    put at a word's place. Numbers that no pattern takes are left as they are: not personal."""
    made, windows = random.Random(seed), []

    def keep(text: str, spans: list[Span]) -> None:
        tags = np.zeros(WINDOW, np.int64)
        for kind, start, end in spans:
            tags[start:end] = TAGS.index(f"I-{kind}")
            tags[start] = TAGS.index(f"B-{kind}")
        windows.append((CHARACTERS.of(text), tags, spans, text))

    for text in texts:
        spans = base_spans(text)
        starts = triggered(text)
        for start in made.sample(starts, min(3, len(starts))):
            inside = [(kind, a - start, b - start) for kind, a, b in spans if a >= start and b <= start + WINDOW]
            crossing = any(a < start + WINDOW and b > start and not (a >= start and b <= start + WINDOW) for _, a, b in spans)
            taken = [span for n, span in enumerate(inside) if all(span[1] >= e or span[2] <= s for _, s, e in inside[:n])]
            if not crossing:
                keep(text[start : start + WINDOW], taken)
        plain = [number for number in window_starts(len(text)) if not TRIGGER.search(text, number, number + WINDOW)]
        for start in made.sample(plain, min(3, len(plain))):
            window = text[start : start + WINDOW]
            blanks = [found.start() for found in re.finditer(" ", window)] or [0]
            place, kind = made.choice(blanks), made.choice([*KINDS, "none", "none"])
            value = _generated(kind, made) if kind != "none" else made.choice(
                [str(made.randint(1, 10**made.randint(1, 12))), f"{made.randint(1, 31)}.{made.randint(1, 12)}.{made.randint(1900, 2030)}",
                 f"{made.randint(0, 99)}.{made.randint(0, 99)}", "".join(made.choice("0123456789abcdef") for _ in range(made.choice((8, 16, 32, 40)))),
                 f"{made.randint(2000, 2030)}-{made.randint(10, 12)}-{made.randint(10, 28)}", f"v{made.randint(0, 9)}.{made.randint(0, 9)}.{made.randint(0, 99)}"]
            )
            lead = window[:place] + (" " if place else "")
            whole = lead + value + made.choice([" ", ". ", ", "]) + window[place + 1 :]
            if len(lead) + len(value) <= WINDOW:
                keep(whole[:WINDOW], [(kind, len(lead), len(lead) + len(value))] if kind != "none" else [])
    made.shuffle(windows)
    return windows


def trained(texts: list[str], windows_kept: int = TRAIN_WINDOWS, rounds: int = ROUNDS, seed: int = 7) -> Model:
    """A tagger trained on four fifths of the labelled windows; the rest sets the confidence.
    With too few windows nothing is learnt and no span is ever added."""
    windows = labelled_windows(texts)[: windows_kept * 5 // 4]
    split = len(windows) * 4 // 5
    learnt, checked = windows[:split], windows[split:]
    tagger = Tagger(seed=seed)
    if len(learnt) < 2 * BATCH:
        return Model(tagger.values, float("inf"))
    steps, order = Adam(tagger.values, RATE), random.Random(seed)
    for turn in range(rounds):
        steps.rate = RATE * (1 - turn / rounds)
        order.shuffle(learnt)
        for at in range(0, len(learnt) - BATCH + 1, BATCH):
            some = learnt[at : at + BATCH]
            steps.step(tagger.slopes(padded([window for window, *_ in some]), np.stack([tags for _, tags, *_ in some], axis=1)))
    found = added_spans([text for *_, text in checked], tagger)
    judged = []
    for spans, (*_, labels, text) in zip(found, checked, strict=True):
        base = {(start, end) for _, start, end in base_spans(text)}
        judged += [(level, span in labels) for level, span in spans if span[1:] not in base]
    confidence, right = float("inf"), 0
    for number, (level, good) in enumerate(sorted(judged, reverse=True), 1):
        right += good
        if right >= PRECISION * number:
            confidence = level
    return Model(tagger.values, max(confidence, 0.5))


def training_texts(documents: DataFrame, count: int = SAMPLE_DOCUMENTS, length: int = SAMPLE_CHARACTERS) -> list[str]:
    """A bounded sample: half documents with a digit or an at sign, half others, up to ``length``
    characters around a sign, or place, that a hash picks anywhere in the text.

    One pass over the texts finds the smallest hashes of both halves, one fetches their texts.
    """
    rows = documents.where("text is not null").select(
        F.xxhash64("text").alias("mixed"), F.col("text").rlike("[0-9@]").alias("signed"), "text"
    )
    hashes = first_places(rows.select("signed", "mixed").distinct(), ["signed"], ["mixed"], count // 2, "place")
    chosen = F.broadcast(hashes.select("signed", "mixed"))
    begin = F.pmod("mixed", F.greatest(F.length("text"), F.lit(1))).cast("int") + 1
    sign = F.regexp_instr(F.substr("text", begin), F.lit("[0-9@]"))
    place = F.when(sign > 0, begin + sign - 1).when(F.col("signed"), F.regexp_instr("text", F.lit("[0-9@]"))).otherwise(begin)
    cut = F.substr("text", F.greatest(place - length // 2, F.lit(1)), F.lit(length))
    found = rows.join(chosen, ["signed", "mixed"]).select("signed", "mixed", cut.alias("text"))
    picked = found.groupBy("signed", "mixed").agg(F.min("text").alias("text"))
    return [row.text for row in picked.orderBy(F.desc("signed"), "mixed").collect()]


# --- the operator ----------------------------------------------------------------------

FIELDS = T.StructType([T.StructField("base_spans", SPANS), T.StructField("all_spans", SPANS)])


def found(df: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``all_spans``: (kind, start, end) by kind, then start.

    Whole texts are read; offsets are code points, ends exclusive. Null and empty texts have no
    spans. Rows keep their number, repeated rows give repeated results, an empty table stays
    empty, columns of these names are replaced. One narrow pass without a shuffle.
    """

    def start():
        tagger = Tagger(model.values)

        def work(texts: list[str | None]) -> list:
            texts = [text if text and TRIGGER.search(text) else "" for text in texts]
            base = [base_spans(text) for text in texts]
            added = added_spans(texts, tagger)
            whole = [reconciled(own, more, model.confidence) for own, more in zip(base, added, strict=True)]
            return [list(map(span_rows, side)) for side in (base, whole)]

        return work

    return text_pass(df, column, FIELDS, start)


def redacted(df: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """The texts with every span replaced by its kind in brackets; overlapping spans become
    one, named after the first. Null texts stay null, all other columns stay as they are."""
    fields = T.StructType([T.StructField(column, T.StringType())])

    def cut(text: str | None, spans: list[dict] | None) -> str | None:
        if not spans:
            return text
        parts, at = [], 0
        for span in sorted(spans, key=lambda one: (one["start"], -one["end"])):
            if span["start"] >= at:
                parts += [text[at : span["start"]], f"[{span['kind'].upper()}]"]
            at = max(at, span["end"])
        return "".join([*parts, text[at:]])

    def work(rows: DataFrame) -> DataFrame:
        return text_pass(found(rows, model, column), column, fields, lambda: lambda *lists: [list(map(cut, *lists))], ("all_spans",))

    return shielded(df, column, work)


def personal_data(documents: DataFrame) -> DataFrame:
    """Counts and digest of the base spans and all spans of every document."""
    rows = found(documents.select("doc_id", "text"), trained(training_texts(documents)))
    counts = [count_of("base_spans", kind).alias(f"n_{kind}") for kind in KINDS]
    return rows.select("doc_id", *counts, F.sha2(joined_spans("base_spans"), 256).alias("base_sha256"), joined_spans("all_spans").alias("spans"))
