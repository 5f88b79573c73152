"""Operator 12: eigenpairs and whitened vectors against NumPy, sums against Python's integers."""

import math

import numpy as np
import pytest

from brute import clashing  # noqa: F401  fixture
from loomwork.llm import eigen, whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def matrices():
    draw = np.random.default_rng(4)
    for size in (1, 2, 3, 17, 64, 150):
        a = draw.standard_normal((size, size))
        yield a @ a.T
    yield np.diag(np.repeat([3.0, 2.0, 1.0], 7))
    yield np.ones((9, 9))
    yield np.zeros((4, 4))
    q, _ = np.linalg.qr(draw.standard_normal((40, 40)))
    for values in (np.r_[np.full(10, 5.0), 5 + 1e-13, np.linspace(1, 2, 29)], 10.0 ** -np.arange(40)):
        a = (q * values) @ q.T
        yield (a + a.T) / 2
    yield 1e-200 * np.diag([1.0, 2.0, 3.0])


def test_leading_eigenpairs():
    for a in matrices():
        values, rows = eigen.leading(a, 32)
        wanted = np.sort(np.linalg.eigvalsh(a))[::-1][:32]
        top = max(abs(wanted[0]), 1e-300)
        assert np.abs(values - wanted).max() <= 1e-13 * top * len(a)
        assert np.abs(a @ rows.T - rows.T * values).max() <= 1e-13 * top * len(a)
        assert np.abs(rows @ rows.T - np.eye(len(rows))).max() < 1e-12


def brute(vectors, k):
    x = np.floor(np.array(vectors, dtype=np.float32).astype(float) * 64) + 1_000_000
    sums = [sum(int(v) for v in column) for column in x.T]
    n = len(x)
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = x - x.mean(axis=0)
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    values, columns = values[::-1][:k], columns[:, ::-1][:, :k]
    return deviation, centred @ columns / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_against_numpy(spark, clashing):
    draw = np.random.default_rng(5)
    vectors = (draw.standard_normal((300, 40)) * np.linspace(0.2, 2, 40)).astype(np.float32)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors)]
    bad = [(900, None, 0), (901, [None] + [1.0] * 39, 0), (902, [math.nan] * 40, 0), (903, [math.inf] * 40, 0),
           (904, [], 0), (905, [1.0] * 7, 0)]
    df = clashing(spark.createDataFrame(rows + bad, SCHEMA).repartition(5))
    got = W.whitened_components(df).collect()
    assert W.whitened_components(df).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                                                 "identity_error"]
    assert len(got) == 300 * 32 and {r["vec_id"] for r in got} == set(range(300))
    deviation, whitened, explained = brute(vectors, 32)
    mine = np.zeros((300, 32))
    for r in got:
        mine[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[r["vec_id"]] and r["n"] == 300
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-10
        assert r["identity_error"] < 1e-10
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine * signs - whitened).max() < 1e-8


def test_repeated_ids_and_low_rank(spark):
    rows = [(None, [1.0, 0.0, 5.0], 0), (1, [2.0, 0.0, 5.0], 0), (1, [4.0, 0.0, 5.0], 0), (2, [2.0, 0.0, 5.0], 0)]
    got = W.whitened_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 4 and {r["component"] for r in got} == {1}
    assert sum(r["vec_id"] is None for r in got) == 1 and abs(got[0]["explained"] - 1) < 1e-12


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0], 0), (2, [1.0], 0)]])
def test_nothing_to_whiten(spark, rows):
    assert W.whitened_components(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_huge_entries_stay_exact(spark):
    big = 2.0 ** 54
    rows = [(i, [big * i, float(i % 2)]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    n, sums = W._sums(W._only(df, "vec_id", "embedding"), 2)
    assert (n, sums) == (4, [64 * 2 ** 54 * 6 + 4_000_000, 64 * 2 + 4_000_000])
    spread = W._covariance(W._only(df, "vec_id", "embedding"), 2, n, sums)
    assert spread[0, 0] == 1.25 * 2.0 ** 120 and spread[0, 1] == 2.0 ** 60 * 64 * 0.25 and spread[1, 1] == 1024
    assert [r["deviation"] for r in W.whitened_components(df, components=1).collect()] == [None] * 4


def test_vectors_beyond_longs_are_left_out(spark):
    rows = [(0, [1e300, 1.0]), (1, [0.0, 1.0]), (2, [3.0, 2.0]), (3, [1.0, 7.0])]
    got = W.whitened_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3} and got[0]["n"] == 3
