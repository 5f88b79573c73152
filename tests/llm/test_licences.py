"""Operator 13: the automaton and the base phrases against plain Python, spans of planted texts."""

import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import clashing, documents  # noqa: F401  fixtures
from loomwork.llm import licences as L
from loomwork.llm.licence_texts import BASE_PHRASES, TEMPLATES

MIT = TEMPLATES[3][1]


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base(text):
    w = words(text)
    places = [(i, label) for phrase, label in BASE_PHRASES for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


@settings(deadline=None, max_examples=200)
@given(st.lists(st.lists(st.integers(0, 3), max_size=12), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=25))
def test_matching_statistics(sequences, walk):
    steps, length, link, places = L.suffix_automaton(sequences)
    factors = {}
    for n, s in enumerate(sequences):
        for i in range(len(s)):
            for j in range(i, len(s)):
                factors.setdefault(tuple(s[i:j + 1]), []).append((n, j))
    longest = [max(k for k in range(i + 2) if k == 0 or tuple(walk[i + 1 - k:i + 1]) in factors)
               for i in range(len(walk))]
    wanted = [(i, k, sorted(set(factors[tuple(walk[i + 1 - k:i + 1])]))) for i, k in enumerate(longest)
              if k >= 2 and (i + 1 == len(walk) or longest[i + 1] != k + 1)]
    assert [(i, k, places[s]) for i, k, s in L.anchors(walk, steps, length, link, 2)] == wanted


@settings(deadline=None, max_examples=100)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(
    ["cc", "CC", "by", "General", "public", "license", "all", "rights", "reserved", "é", "x1", "-", "\n", ",", "ccby"]),
    max_size=25).map(" ".join)), max_size=6))
def test_base_places(texts):
    found = list(L.Scanner().texts(pa.array(texts, pa.string())))
    got = [(n, len(b), min((i for i, _ in b), default=None), max((i for i, _ in b), default=None),
            ",".join(sorted({label for _, label in b}))) for n, b, _ in found]
    assert got == [base(t) for t in texts]


def filler(draw, n):
    return " ".join("".join(draw.choice("bcdfgklmnpq") for _ in range(6)) for _ in range(n))


def test_scan(documents, clashing):
    draw = random.Random(6)
    broken = MIT.replace("merge,", "").replace("AS IS", "as it is").replace("Software is furnished", "Sofftware is given")
    texts = [filler(draw, 40) + " Released under the MIT License. " + filler(draw, 30),
             "This work is licensed under the GNU General Public License, version 3.\nAll rights reserved.",
             "LICENSED under CC  BY-NC 4.0", filler(draw, 25) + " " + broken + " " + filler(draw, 9),
             MIT[:len(MIT) // 3], "", None, filler(draw, 200), "the license of the software is not the license",
             (filler(draw, 20_000) + " " + MIT + "\n") * 3, "cc by " * 3]
    df = clashing(documents(texts))
    rows = {r["doc_id"]: r for r in L.scan(df).collect()}
    assert [rows[i]["labels"] for i in range(11)] == [
        "mit", "gpl,gpl-3.0,reserved", "cc-by,cc-by-nc-4.0", "mit", "", "", "", "", "", "mit", "cc-by"]
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(text)
    assert rows[0]["score"] == rows[1]["score"] == rows[2]["score"] == 1.0
    assert 0.9 < rows[3]["score"] < 1 and 0.2 < rows[4]["score"] < 0.5
    assert [rows[i]["score"] for i in (5, 6, 7)] == [0.0] * 3 and rows[8]["score"] < 0.5
    spans = sorted((r["doc_id"], r["label"], r["first_word"], r["last_word"]) for r in L.licence_spans(df).collect())
    size = len(words(MIT))
    assert spans[0] == (0, "mit", 40, 44)
    assert [s for s in spans if s[0] == 9] == [
        (9, "mit", k * (20_000 + size) + 20_000, (k + 1) * (20_000 + size) - 1) for k in range(3)]
    assert [s[:2] for s in spans if s[0] == 1] == [(1, "gpl-3.0"), (1, "reserved")]


def test_repeated_rows_and_empty_table(documents):
    df = documents([(7, "All rights reserved"), (7, "All rights reserved"), (None, "cc by")])
    assert sorted((r["doc_id"] or 0, r["labels"]) for r in L.scan(df).collect()) == [
        (0, "cc-by"), (7, "reserved"), (7, "reserved")]
    assert L.scan(df.limit(0)).collect() == [] and L.licence_spans(df.limit(0)).collect() == []
