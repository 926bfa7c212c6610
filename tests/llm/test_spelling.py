"""Spelling variants against all pairs, over given and made texts, few and many ranges."""

import random
import re
import zlib
from collections import Counter

import pytest

from tillmark.llm import spelling

SF = "/root/testdata/sf0.001"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:at] + b[at + 1 :] == a for at in range(len(b)))


def plain(rows):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(letter) + 32) if "A" <= letter <= "Z" else letter for letter in run)
            mark = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if mark % 199 == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            total[run] += 1
    n = {word: count for word, count in total.items() if len(word) >= 6 and count >= 5}
    by_size = {}
    for word in n:
        by_size.setdefault(len(word), []).append(word)
    found, form = {}, {}
    for word in n:
        found[word] = [o for size in (-1, 0, 1) for o in by_size.get(len(word) + size, ()) if near(word, o)]
        best = min(found[word], key=lambda other: (-n[other], other), default=None)
        form[word] = best if best is not None and n[best] >= 5 * n[word] else None

    def root(word):
        while form[word] is not None:
            word = form[word]
        return word

    return {word: (word, form[word], root(word), n[word], len(found[word]), n.get(form[word])) for word in n}


def made_rows():
    """Chains of forms, ties, hot beginnings, words that differ anywhere by one letter."""
    pick, words = random.Random(4), {}
    for stem in ("aaaaaa", "abcdef", "prefixes", "préfixes", "ÿÀ×÷öä", "theword"):
        for _ in range(25):
            at, letter = pick.randrange(len(stem) + 1), pick.choice("abcdéÿ")
            words[pick.choice([stem[:at] + letter + stem[at:], stem[:at] + letter + stem[at + 1 :], stem[:at] + stem[at + 1 :]])] = pick.choice([5, 6, 30, 160])
        words[stem] = 800
    words |= {"chainee": 6, "chained": 40, "shained": 300}  # each the form of the one before
    flat = [word for word, times in words.items() for _ in range(times)]
    pick.shuffle(flat)
    rows = [(at, pick.choice([" ", "-", "1", "ğ"]).join(flat[at : at + 40]).title()) for at in range(0, len(flat), 40)]
    return rows + [(None, "Nullkey " * 7), (3, None), (4, ""), (5, "x" * 30_000 + " " + "y" * 30_000), (3, rows[3][1]), (3, rows[3][1])]


@pytest.mark.parametrize(("words", "queries"), [(50_000, 400_000), (15, 10)])
def test_like_all_pairs(spark, monkeypatch, words, queries):
    monkeypatch.setattr(spelling, "INDEX_WORDS", words)
    monkeypatch.setattr(spelling, "TASK_QUERIES", queries)
    rows = made_rows()
    schema = "doc_id long, text string, word string, N string, form string, root int"
    table = spark.createDataFrame([(*row, "w", "n", "f", 1) for row in rows], schema).repartition(3)
    want = plain(rows)
    assert {row.word: tuple(row) for row in spelling.spelling_groups(table).collect()} == want
    assert sum(form is not None for _, form, *_ in want.values()) > 20
    assert any(root != form for _, form, root, *_ in want.values() if form is not None)


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(row.doc_id, row.text) for row in table.collect()]
    want = plain(rows)
    assert {row.word: tuple(row) for row in spelling.spelling_groups(table).collect()} == want
    assert want


def test_no_rows(spark):
    assert spelling.spelling_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert spelling.spelling_groups(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("first_half", [True, False])
def test_index_finds_the_letters_of_no_word(first_half):
    """Letters that the index does not know never match, but may be replaced or left out."""
    words = ["abcdef", "abcxdef", "bcdefg"]
    found = {word: names for block in spelling.searched(words, [5, 9, 7], ["abc?def", "?bcdef", "abcde?", "??????"], first_half) for word, _, _, names in zip(*block)}
    assert found["??????"] is None
    got = found["abc?def"], found["?bcdef"], found["abcde?"]
    assert got == (("abcxdef", None, "abcdef") if first_half else (None, "abcdef", None))
