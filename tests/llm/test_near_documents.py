"""Operator 2: near-duplicate documents against all pairs."""

import random

import pytest

import brute
from brute import clashing, documents  # noqa: F401  fixtures
from loomwork.llm import components, minhash_docs


def varied(seed, count=90):
    """Texts with exact copies, near copies around the threshold, short and empty ones."""
    draw = random.Random(seed)
    word = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(count // 6):
        base = [draw.choice(word) for _ in range(draw.choice([3, 5, 30, 60, 120]))]
        texts.append(" ".join(base))
        for _ in range(5):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = draw.choice(word)
            texts.append((" " if draw.random() < 0.5 else "\n").join(copy))
    texts += ["", None, "  \n", "one", "ONE", "one two", "two one", None]
    draw.shuffle(texts)
    return texts


def expected(texts, size=4):
    texts = dict(enumerate(texts)) if isinstance(texts, list) else texts
    component = brute.groups(brute.similar_pairs(texts, size), texts)
    return {i: (len(brute.shingle_set(t, size)), component[i], component[i] == i) for i, t in texts.items()}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("seed,block", [(1, 128), (2, 4)])
def test_against_all_pairs(documents, seed, block):
    texts = varied(seed)
    assert result(minhash_docs.near_duplicates(documents(texts), block=block)) == expected(texts)


def test_one_large_family_in_small_tiles(documents):
    """A third of the rows are near copies of one text, compared in tiles of a few."""
    draw = random.Random(5)
    base = [f"b{k}" for k in range(60)]
    texts = []
    for _ in range(70):
        copy = list(base)
        for _ in range(draw.randrange(6)):
            copy[draw.randrange(60)] = f"x{draw.randrange(1000)}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"u{draw.randrange(500)}" for _ in range(40)) for _ in range(30)]
    assert result(minhash_docs.near_duplicates(documents(texts), block=6)) == expected(texts)


def test_clashing_columns_nulls_and_repeated_rows(spark, documents, clashing):
    texts = ["a b c d e f", "a b c d e f", "", None]
    docs = documents([*enumerate(texts), (0, texts[0]), (None, "a b c d e f")])
    rows = minhash_docs.near_duplicates(clashing(docs)).collect()
    assert len(rows) == 6
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in rows} == {
        (0, 0, True), (1, 0, False), (2, 2, True), (3, 3, True), (None, None, True)}


def test_long_text(documents):
    long_ = " ".join(f"w{k % 50_000}" for k in range(120_000))
    rows = result(minhash_docs.near_duplicates(documents([long_, long_ + " end", "short one here now"])))
    assert rows[1][1] == 0 and rows[2][1] == 2


def test_empty_table(documents, spark):
    empty = documents(["a"]).limit(0)
    assert minhash_docs.near_duplicates(empty).collect() == []


def test_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(120), draw.randrange(120)) for _ in range(90)] + [(200 + k, 201 + k) for k in range(40)]
    links += [(5, 5), (7, 6), (7, 6), (300, 300)]
    ids = {i for pair in links for i in pair}
    found = components.components(spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint"))
    assert {r["id"]: r["component"] for r in found.collect()} == brute.groups(links, ids)
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components.components(none).collect() == []
