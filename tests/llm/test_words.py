import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import shingles, words
from marketlake.llm import words as W
from marketlake.llm.elias_fano import EliasFano, encode

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abAB1é .\n\t", max_size=40)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 30))
def test_words_and_hashes(texts, limit):
    seen = {}
    for part in W.chunks(pa.array(texts, pa.string()), limit):
        found = W.words(part)
        codes = W.hashes(part, found)
        for r in range(part.rows):
            own = slice(found.first[r], found.first[r + 1])
            want = words(texts[part.first_row + r])
            got = [part.data[a:b].tobytes().decode().lower() for a, b in zip(found.start[own], found.end[own], strict=True)]
            assert got == [w.lower() for w in want]
            for w, c in zip(want, codes[own].tolist(), strict=True):
                assert seen.setdefault(w, c) == c
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_shingle_sets(texts):
    got = []
    for part in W.chunks(pa.array(texts, pa.string())):
        value, first = W.shingle_sets(part, 5)
        got += [set(value[a:b].tolist()) for a, b in zip(first, first[1:], strict=False)]
    want = [shingles(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for a, x in zip(got, want, strict=True):
        for b, y in zip(got, want, strict=True):
            assert len(a & b) == len(x & y)


def test_sorted_values_round_trip():
    values = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (W.unpack_sorted(W.pack_sorted(values)) == values).all()
    assert len(W.unpack_sorted(W.pack_sorted(values[:0]))) == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=200), st.lists(st.integers(0, 2**40), max_size=50))
def test_elias_fano(values, asked):
    values = np.array(sorted(values), np.uint64)
    read = EliasFano(np.frombuffer(encode(values, 2**40 + 1), np.uint8))
    assert (read.access(np.arange(len(values))) == values).all()
    asked = np.array(asked + values.tolist(), np.uint64)
    assert (read.successor(asked) == np.searchsorted(values, asked)).all()
    assert [k >= 0 for k in read.index(asked)] == [x in set(values.tolist()) for x in asked.tolist()]
