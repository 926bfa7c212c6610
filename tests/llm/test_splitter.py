"""The word splitter against the tokenizer library, over all code points it splits by itself."""

import unicodedata

import public_tokenizers
import pytest

from tillmark.llm import bpe


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(public_tokenizers.path(bpe.WORD_BPE)))


def same_pieces(split, texts):
    return [text for text in texts if split(text) != split._by_library(text)]


def points():
    return [chr(point) for low, high in bpe.SAME_CLASSES for point in range(low, high + 1)]


def test_code_points_of_the_ranges(encoder):
    texts = [text for one in points() for text in (one, f"a{one}b", f"1{one} {one}{one}.", f"É{one}Σ")]
    assert not same_pieces(encoder.split, texts)


def test_base_and_mark_pairs(encoder):
    marks = [one for one in points() if unicodedata.combining(one)]
    bases = [one for one in points() if not unicodedata.combining(one)]
    composed = [a + b for a in bases for b in marks if len(unicodedata.normalize("NFC", a + b)) == 1]
    assert len(composed) > 416
    assert not same_pieces(encoder.split, [text for pair in composed for text in (pair, f"x{pair}y z")])


def test_letters_that_leave_the_ranges(encoder):
    library = encoder.split.library
    library.no_truncation(), library.no_padding()
    outside = (0x1EA1, 0x1EBD, 0x1F00, 0x2260)
    for text in [unicodedata.normalize("NFD", chr(point)) + "b c" for point in outside] + [chr(0x23A) + chr(0x23E)]:
        assert list(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids
