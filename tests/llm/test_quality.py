"""Operator 10: counts against plain Python, label model against votes with known accuracies."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa

import brute
from brute import clashing, documents  # noqa: F401  fixtures
from loomwork.llm import quality


@settings(deadline=None, max_examples=200)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\r\t#|", max_size=60)), max_size=8))
def test_counts(texts):
    found = quality._text_counts(pa.array(texts, pa.string()))
    rows = list(zip(*[found[c].tolist() for c in quality.COUNTS]))
    assert rows == [brute.text_counts(t) for t in texts]


def test_label_model_finds_accuracies():
    draw = np.random.default_rng(1)
    good = draw.random(40_000) < 0.8
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.85]
    votes = np.zeros((len(good), 5), dtype=np.int64)
    for r, share in enumerate(accuracy):
        right = draw.random(len(good)) < share
        votes[:, r] = np.where(right, np.where(good, 1, -1), np.where(good, -1, 1))
        votes[draw.random(len(good)) < 0.3, r] = 0
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = quality.fit_label_model(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.02
    for r, share in enumerate(accuracy):
        assert abs(model.good[r, 2] / (model.good[r, 0] + model.good[r, 2]) - share) < 0.03
    kept = model.posterior(patterns)[place.ravel()] >= 0.5
    assert (kept == good).mean() > 0.95


def clean(draw):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randrange(2, 9))) for _ in range(120))


def test_operator(documents, clashing):
    draw = random.Random(2)
    texts = [clean(draw) for _ in range(60)]
    junk = [" ".join(w + "$%&" for w in clean(draw).split()) for _ in range(12)]
    copies = ["\n".join([" ".join(clean(draw).split()[:12])] * 14) for _ in range(6)]
    edge = ["", None, "few words", " ".join(["same"] * 80)]
    rows = {r["doc_id"]: r for r in quality.quality(clashing(documents(texts + junk + copies + edge))).collect()}
    assert len(rows) == 82
    assert all(rows[i]["kept"] for i in range(60))
    assert not any(rows[i]["kept"] for i in range(60, 82))
    assert [rows[i]["base_failed"] for i in range(78, 82)] == [True] * 4
    assert (rows[78]["n_words"], rows[79]["n_words"], rows[81]["n_repeat_words"]) == (0, 0, 80)


def test_empty_table(documents):
    assert quality.quality(documents(["a"]).limit(0)).collect() == []
