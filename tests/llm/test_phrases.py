"""Collocations against a plain count, small summaries, blocks and filters included."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tillmark.llm import phrases

UPPER = {code: code + 32 for code in range(65, 91)}


def plain(rows, least, top):
    """The contract, word by word, over (text, lang) rows."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for at in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[at : at + size])] += 1
    out = []
    for lang, found in counts.items():
        frequent = {phrase: a for phrase, a in found.items() if len(phrase) > 1 and a >= least}
        scored = []
        for phrase, a in frequent.items():
            if any(
                len(other) == 3 and len(phrase) == 2 and phrase in (other[:2], other[1:]) and 100 * f >= 50 * a
                for other, f in frequent.items()
            ):
                continue
            cuts = [(10**6 * a * a // (found[phrase[:k]] * found[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), found[phrase[:k]], found[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def made_rows(seed, texts=250):
    pick = random.Random(seed)
    words = ["The", "of", "été", "Été", "漢字", "a", "b", "c", "x-y", "\x00", "b\xa0c"]
    rows = [
        ("".join(pick.choice(words) + pick.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n"]) for _ in range(pick.randint(0, 80))),
         pick.choice(["en", "fr", None, "", "und"]))
        for _ in range(texts)
    ]
    return rows + [(None, "en"), ("", "xx"), (" ", None), ("hot pair " * 3000, "en"), rows[0], rows[0]]


def as_table(spark, rows):
    schema = "text string, lang string, phrase string, Score int, a int, rank string"
    return spark.createDataFrame([(*row, "p", 1, 2, "r") for row in rows], schema).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_like_a_plain_count(spark, seed, monkeypatch):
    monkeypatch.setattr(phrases, "PARTITION_BYTES", 2_000 if seed == 1 else 10**7)
    monkeypatch.setattr(phrases, "FILTER_BITS", 256 if seed == 1 else 1 << 20)
    rows = made_rows(seed)
    found = sorted(map(tuple, phrases.collocations(as_table(spark, rows), top=50).collect()))
    assert found == plain(rows, 10, 50)
    assert len(found) > 20


def test_no_rows(spark):
    assert phrases.collocations(as_table(spark, [("x", "en")]).where("false")).collect() == []
    assert phrases.collocations(as_table(spark, [("once only", "en"), (None, None)])).collect() == []


def test_long_pieces_go_on_in_the_next_block():
    """Phrases across a block's end are counted once, whatever the block size."""
    import pyarrow as pa

    pick = random.Random(5)
    words = [pick.choice("abcd") for _ in range(997)]
    batch = pa.record_batch({"text": [" ".join(words), "a b. c d"], "lang": ["en", "en"]})
    want = Counter()
    for run in (words, ["a", "b"], ["c", "d"]):
        for size in (1, 2, 3):
            want.update(tuple(run[at : at + size]) for at in range(len(run) - size + 1))
    for most in (1, 2, 3, 7, 100, 10_000):
        got = Counter()
        for block in phrases.blocks(iter([batch]), most):
            for size, flat, places, counts in block.phrases():
                for place, count in zip(places, counts):
                    got[tuple(block.words[int(n)].decode() for n in flat[place : place + size])] += int(count)
        assert got == want, most


@pytest.mark.parametrize("seed", range(5))
def test_summaries_keep_every_frequent_key(seed):
    """However the blocks are cut, a key as frequent as the threshold survives, and the merged
    summary never holds more than its capacity."""
    made = np.random.default_rng(seed)
    keys = np.concatenate([made.zipf(1.3, 20_000) % 5_000, np.arange(10**6, 10**6 + 30_000)]).astype(np.uint32)
    made.shuffle(keys)
    blocks = [np.unique(part, return_counts=True) for part in np.array_split(keys, 13)]
    total = Counter(keys.tolist())
    for least in (2, 10, 100, 1000):
        kept = set(phrases.survivors(blocks, least).tolist())
        assert {key for key, count in total.items() if count >= least} <= kept
        assert len(kept) <= len(keys) // least + 1
    summary = blocks[0]
    for block in blocks[1:]:
        summary = phrases.merged(summary, block, 50)
        assert len(summary[0]) <= 50
    error = len(keys) // 51 + 1
    assert all(count - error <= dict(zip(*map(np.ndarray.tolist, summary))).get(key, 0) <= count for key, count in total.most_common(60))
