"""Words, hashes and shingles of byte buffers against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from loomwork.llm import vectorwords as vw

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abAB \n\t\r\x0b é日#.", max_size=40)), max_size=12)


def found_words(texts, **kind):
    column = pa.array(texts, pa.string())
    data, offsets = vw.column_bytes(column)
    words = vw.find_words(data, offsets, **kind)
    raw = data.tobytes()
    return [[raw[words.start[k]:words.end[k]].decode() for k in range(a, b)]
            for a, b in zip(words.first[:-1], words.first[1:])]


@settings(deadline=None, max_examples=200)
@given(TEXTS)
def test_words(texts):
    assert found_words(texts) == [brute.WORD.findall(t or "") for t in texts]


@settings(deadline=None, max_examples=100)
@given(TEXTS, st.integers(1, 5))
def test_shingle_sets(texts, size):
    sets = vw.shingle_sets(pa.array(texts, pa.string()), size)
    plain = [brute.shingle_set(t, size) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_sliced_columns_and_large_strings():
    whole = pa.array(["a b", None, "c", "", "d e f"])
    assert found_words(whole.slice(1, 4).to_pylist()) == [[], ["c"], [], ["d", "e", "f"]]
    data, offsets = vw.column_bytes(whole.slice(2))
    assert data.tobytes() == b"cd e f" and offsets.tolist() == [0, 1, 1, 6]
    data, offsets = vw.column_bytes(whole.cast(pa.large_string()).slice(2))
    assert data.tobytes() == b"cd e f" and offsets.tolist() == [0, 1, 1, 6]


def test_hash_does_not_depend_on_place():
    data = np.frombuffer(("x" * 700_000 + " word " + "y" * 600_000 + " word").encode(), np.uint8)
    words = vw.find_words(data, np.array([0, len(data)]))
    hashes = vw.hash_spans(data, words.start, words.end)
    assert len(hashes) == 4 and hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3


def test_set_keys():
    sets = [np.array([3, 5], np.uint64), np.zeros(0, np.uint64), np.array([5, 3], np.uint64), np.array([3], np.uint64)]
    keys = vw.set_keys(sets)
    assert keys[0].tolist() == keys[2].tolist() != keys[3].tolist() and keys[1].tolist() == [0, 0]


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(6)), pa.array(["a" * 10, "b" * 50, "", None, "c" * 3, "d"])], ["id", "text"])
    parts = list(vw.slices([batch], limit=12))
    assert sum((p.column(0).to_pylist() for p in parts), []) == list(range(6)) and len(parts) > 2
