import re

import numpy as np
import pyarrow as pa
import pytest

from rillstone.llm import kernels as k
from rillstone.llm.suffixes import suffix_array

TEXTS = ["", "a", " a  b\tc\n", "ÄÖ ü x y z A B", None, "one two three four five six", "x" * 300, "\x0b\x0c", "a b c d e"]
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(t):
    return WORD.findall((t or "").encode())


@pytest.mark.parametrize("most", [1, 16, 1 << 20])
def test_words(most):
    got = []
    for _, _, buf, offs in k.slices(pa.array(TEXTS), most):
        starts, ends, first = k.words(buf, offs)
        got += [[buf[a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(first[:-1], first[1:])]
    assert got == [words_of(t) for t in TEXTS]


def test_span_hash_is_by_content():
    buf = np.frombuffer(b"abcXXabcYabd", np.uint8)
    h = k.span_hash(k.prefix_hash(buf), np.array([0, 5, 9, 0]), np.array([3, 8, 12, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


def test_shingle_sets():
    texts = ["A b c d e f", "a B c d e", "a b", "a b ", "", None, "a b c d e f a b c d e f"]
    buf, offs = k.raw_column(pa.array(texts))
    h, at = k.sets(*k.shingles(buf, offs))
    s = [frozenset(h[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
    want = []
    for t in texts:
        w = [x.lower() for x in words_of(t)]
        want.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    for i in range(len(texts)):
        assert len(s[i]) == len(want[i])
        for j in range(len(texts)):
            assert len(s[i] & s[j]) == len(want[i] & want[j])


def test_sliced_columns():
    col = pa.array(TEXTS)[2:6]
    buf, offs = k.raw_column(col)
    assert [buf[a:b].tobytes().decode() for a, b in zip(offs[:-1], offs[1:])] == [t or "" for t in TEXTS[2:6]]


def test_suffix_array():
    r = np.random.default_rng(1)
    for _ in range(300):
        s = r.integers(1, r.integers(2, 6), r.integers(0, 60))
        assert suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    s = np.tile(np.array([3, 1, 2, 1]), 50)
    assert suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
