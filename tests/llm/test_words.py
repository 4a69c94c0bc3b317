import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from txnguard.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \té\n\u00a0", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 12))
def test_words_are_those_of_split_whatever_the_block(texts, block):
    column = pa.array(texts, pa.string())
    expected = [(t or "").encode().split() for t in texts]
    whole = W.find_words(column)
    before, W.BLOCK = W.BLOCK, block
    try:
        cut = W.find_words(column)
    finally:
        W.BLOCK = before
    assert whole.counts.tolist() == [len(x) for x in expected]
    assert (whole.hash == cut.hash).all() and (whole.start == cut.start).all()
    flat = [w for x in expected for w in x]
    names = dict(zip(flat, whole.hash.tolist(), strict=True))
    assert [names[w] for w in flat] == whole.hash.tolist()
    assert len(set(names.values())) == len(names)


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_windows(texts, width):
    found = W.find_words(pa.array(texts, pa.string()))
    expected = []
    for t in texts:
        w = (t or "").encode().split()
        if 0 < len(w) < width:
            expected.append(tuple(w))
        expected += [tuple(w[k : k + width]) for k in range(len(w) - width + 1)]
    hashes, _ = W.windows(found, width, short=True)
    assert len(hashes) == len(expected)
    assert len(set(hashes.tolist())) == len(set(expected))


def test_a_slice_of_a_column():
    column = pa.array(["a b", None, "c", "d e f"])
    assert W.find_words(column.slice(1, 3)).counts.tolist() == [0, 1, 3]
    assert sum(b - a for a, b in W.row_slices(column, 2)) == 4
