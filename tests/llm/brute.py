"""Plain Python versions of the operators' definitions, and fixtures for small tables."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingle_set(text, size):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def groups(links, ids):
    """Smallest id reachable from each id."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def similar_pairs(texts, size, num=80, den=100):
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    ids = sorted(sets)
    return [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]


def text_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), copies, len(covered))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A documents table from texts; ids from 0 on, or (id, text) pairs."""
    def make(texts, lang="en", start=0):
        pairs = texts if texts and isinstance(texts[0], tuple) else list(enumerate(texts, start))
        return spark.createDataFrame(
            [(i, t, lang, "s", None if t is None else len(t)) for i, t in pairs], SCHEMA)
    return make


@pytest.fixture
def clashing(spark):
    """Adds columns whose names the operators use inside."""
    def add(df):
        names = ["id", "family", "hash", "place", "token", "_gone", "_id", "main", "v", "n", "shard", "votes"]
        return df.withColumns({c: F.lit(f"own {c}") for c in names if c not in df.columns})
    return add
