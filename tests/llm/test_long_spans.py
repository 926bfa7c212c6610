"""Added spans of any length are found at every place of a text."""

import numpy as np
import pytest

from tillmark.llm import pii


class Marked(pii.Tagger):
    """Takes every run of at signs and hyphens for one address."""

    def scores(self, x, keep=True):
        self.values["step"][:] = 0
        scores = np.zeros((*x.shape, len(pii.TAGS)), np.float32)
        marked = np.isin(x, pii.CHARACTERS.of("@-"))
        scores[..., 0] = np.where(marked, -20, 20)
        scores[..., pii.TAGS.index("B-email")] = np.where(marked, 10, -20)
        scores[..., pii.TAGS.index("I-email")] = np.where(marked, 20, -20)
        return scores, ()


@pytest.mark.parametrize("length", [12, 39, 40, 41, 60, 79, 80, 81, 120, 400])
@pytest.mark.parametrize("marks", ["@", "-"])
def test_every_offset(length, marks):
    # the at sign stands in the middle; the rest of a span holds no sign that opens a window
    span = marks * (length // 2) + "@" + marks * (length - length // 2 - 1)
    texts = ["x" * before + span + "y" * behind for before in range(0, 90) for behind in (0, 1, 30, 200)]
    found = pii.added_spans(texts, Marked())
    assert [[one for _, one in spans] for spans in found] == [[("email", text.index(span), text.index(span) + length)] for text in texts]
    levels = [level for spans in found for level, _ in spans]
    assert min(levels) > 0.9, (min(levels), max(levels))


def test_neighbouring_long_spans():
    text = "x" * 33 + "@" * 90 + " " + "@" * 61 + "y" * 50 + "@" * 10 + "z" * 100 + "@" * 300
    expected = [("email", 33, 123), ("email", 124, 185), ("email", 235, 245), ("email", 345, 645)]
    for batch in (1, 256):
        assert sorted(one for _, one in pii.added_spans([text, "", text], Marked(), batch)[2]) == expected


def test_nothing_learnt_adds_nothing():
    assert pii.trained([]).confidence == float("inf")
    assert pii.added_spans(["no sign here", ""], pii.Tagger()) == [[], []]
