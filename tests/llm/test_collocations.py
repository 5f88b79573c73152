"""Operator 11: summaries against their bound, the whole operator against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import clashing, documents  # noqa: F401  fixtures
from loomwork.llm import collocations as C


def brute(rows, least, share, best):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in found.items():
            if any(100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in found.items() if len(q) > len(p)):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(draw, n=60):
    heads = ["New York", "new york CITY", "é ü", "in  the\tend", "a a a a", "x", "of the", "the"]
    rows = []
    for i in range(n):
        text = "".join(draw.choice(heads) + draw.choice([" ", " ", "\t ", ", ", "\n", ". ", "!"])
                       for _ in range(draw.randrange(0, 120)))
        rows.append((text, [None, "en", "und", "de"][i % 4]))
    return rows + [(None, "en"), ("", None), (" ,.; ", "en"), ("long tail " * 30_000, "fr"), ("q r s " * 40, "fr")]


@pytest.mark.parametrize("part_bytes,merged", [(C.PART_BYTES, C.MERGED), (40_000, 500)])
def test_against_plain_python(spark, clashing, monkeypatch, part_bytes, merged):
    monkeypatch.setattr(C, "PART_BYTES", part_bytes)
    monkeypatch.setattr(C, "MERGED", merged)
    rows = corpus(random.Random(3))
    docs = spark.createDataFrame([(i, t, g, i, i, i, i) for i, (t, g) in enumerate(rows)],
                                 "doc_id long, text string, lang string, phrase long, f long, part long, n long")
    for least, best in ((10, 2000), (25, 3)):
        got = C.collocations(clashing(docs.repartition(3)), least=least, best=best)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == brute(rows, least, 50, best)


def test_marks_only_filter(spark, monkeypatch):
    """With a field so small that every bit is set the second pass still counts exactly."""
    monkeypatch.setattr(C, "FIELD_BITS", 64)
    rows = corpus(random.Random(5), 20)
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, C.collocations(docs, least=12).collect())) == brute(rows, 12, 50, 2000)


def test_empty_table(documents):
    assert C.collocations(documents(["a b"]).limit(0)).collect() == []
    assert C.collocations(documents([None, "", " . "])).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 5 * 10**12
    counts = spark.createDataFrame(
        [("en", "", big), ("en", "a", big), ("en", "b", big - 7), ("en", "a b", big - 11)], "lang string, phrase string, f long")
    row = C.scored(counts, 3, 10, 50).first()
    assert row["score"] == 1000000 * (big - 11) ** 2 // (big * (big - 7))


@settings(deadline=None, max_examples=150)
@given(st.lists(st.lists(st.integers(0, 60), max_size=80), max_size=12), st.integers(2, 12))
def test_summary_keeps_every_frequent_key(slices, least):
    truth = Counter(k for s in slices for k in s)
    summary = C.Summary(sum(truth.values()) // least + 1)
    for s in slices:
        keys, counts = np.unique(np.array(s, dtype=np.uint32), return_counts=True)
        summary.add(keys, counts)
        assert len(summary.keys) <= summary.capacity
    assert summary.lost < least
    assert {k for k, n in truth.items() if n >= least} <= set(summary.reaching(least).tolist())
    held = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert all(truth[k] - summary.lost <= c <= truth[k] for k, c in held.items())


def test_sequences_are_words_of_one_piece():
    found = C.Sequences(pa.array(["Ab  c\td, e", "f", "", "a\nb"]), pa.array(["x", "y", "x", "x"]), 3)
    phrases = found.phrases(np.arange(len(found.at))).to_pylist()
    assert sorted(phrases) == sorted(["ab", "c", "d", "e", "f", "a", "b", "ab c", "c d", "ab c d"])
