import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from opsignal.llm import textbuf

TEXT = st.text(alphabet=" \t\n\x0b\x0c\r.aAbBzZ019é漢", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8))
def test_words_are_those_of_plain_splitting(texts):
    for _, _, offsets, data in textbuf.pieces(pa.array(texts, pa.string()), 16):
        got = textbuf.tokens(offsets, data, textbuf.SPACE, textbuf.LOWER_VALUES)
        words = [bytes(data[s:e]) for s, e in zip(got.starts, got.ends)]
        plain = [bytes(data[a:b]).split() for a, b in zip(offsets, offsets[1:])]
        assert words == [w for ws in plain for w in ws]
        assert list(np.diff(got.first)) == [len(ws) for ws in plain]


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8))
def test_equal_hashes_mean_equal_words(texts):
    seen = {}
    for _, _, offsets, data in textbuf.pieces(pa.array(texts), 16):
        got = textbuf.tokens(offsets, data, textbuf.SPACE, textbuf.LOWER_VALUES)
        for s, e, h in zip(got.starts, got.ends, got.hashes):
            seen.setdefault(int(h), set()).add(bytes(data[s:e]).lower())
    assert all(len(v) == 1 for v in seen.values())
    assert len({next(iter(v)) for v in seen.values()}) == len(seen)


def test_pieces_cover_all_rows_once_and_long_texts_hash_alike():
    texts = ["w%d " % i * 200_000 for i in range(3)] + ["tail"]
    rows = [r for a, b, _, _ in textbuf.pieces(pa.array(texts)) for r in range(a, b)]
    assert rows == [0, 1, 2, 3]
    for _, _, offsets, data in textbuf.pieces(pa.array(texts[:1])):
        assert len(set(textbuf.tokens(offsets, data, textbuf.SPACE, textbuf.BYTE_VALUES).hashes)) == 1


def test_run_hash_does_not_depend_on_the_place():
    values = np.array([5, 9, 2, 5, 9, 2, 7], np.uint64)
    total = textbuf.run_sums(values)
    h = textbuf.run_hash(total, np.array([0, 3, 1, 0]), np.array([3, 6, 4, 2]))
    assert h[0] == h[1] and len({int(x) for x in h[[0, 2, 3]]}) == 3
