import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm.words import Words, alphanumeric, blank_separated, covered, gram_places, grams, steps

LETTERS = st.text(st.sampled_from("ab C.9é日 \n\t\x0b-"), max_size=40)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), LETTERS), max_size=6))
def test_words_equal_the_patterns(texts):
    for marks, pattern in (
        (blank_separated(), r"[^\x20\x09-\x0D]+"),
        (alphanumeric(), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
    ):
        words = Words(pa.array(texts, pa.string()), marks, lower=True)
        expected = [re.findall(pattern, lowered(t or "")) for t in texts]
        assert [words.word(i).decode() for i in range(len(words.starts))] == [w for ws in expected for w in ws]
        assert words.counts.tolist() == [len(ws) for ws in expected]


def test_hashes_tell_words_apart_and_agree():
    texts = ["a b ab ba a", "x" * 600 + " " + "x" * 601 + " b", "abcdefgh abcdefghi " + "x" * 600]
    words = Words(pa.array(texts), blank_separated())
    seen = {}
    for i, h in enumerate(words.hashes().tolist()):
        assert seen.setdefault(words.word(i), h) == h
    assert len(set(seen.values())) == len(seen)


def test_grams_stay_within_rows():
    words = Words(pa.array(["a b c", "b c", "a b"]), blank_separated())
    places = gram_places(words, 2)
    assert places.tolist() == [0, 1, 3, 5]
    values = grams(words.hashes(), 2)[places]
    assert values[0] == values[3] and values[1] == values[2] and values[0] != values[1]


def test_steps_and_covered():
    batch = pa.RecordBatch.from_pydict({"text": ["aaaa", None, "bb", "c" * 50]})
    assert [s.num_rows for s in steps(batch, limit=6)] == [3, 1]
    assert covered(np.array([1, 2]), 3, 6).tolist() == [False, True, True, True, True, False]
