"""Arrays, matrices, images and states on literals."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.functions import arrays as A
from loomwork.functions import images as I
from loomwork.operators import matrices, qvalues


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def vec(*items):
    return F.array(*[F.lit(float(x)) for x in items])


def mat(*rows):
    return F.array(*[vec(*r) for r in rows])


@pytest.mark.parametrize("column,want", [
    (lambda: A.add(vec(1, 2, 3), vec(4, 5, 6)), [5, 7, 9]), (lambda: A.subtract(vec(1, 2, 3), vec(4, 5, 6)), [-3, -3, -3]),
    (lambda: A.multiply(vec(1, 2, 3), vec(4, 5, 6)), [4, 10, 18]), (lambda: A.divide(vec(4, 5, 6), vec(1, 2, 3)), [4, 2.5, 2]),
    (lambda: A.divide(vec(1), vec(0)), [None]), (lambda: A.outer_add(vec(1, 2), vec(10, 20, 30)), [[11, 12], [21, 22], [31, 32]]),
    (lambda: A.matmul(mat([1, 2], [3, 4]), mat([2, 0], [1, 3])), [[4, 6], [10, 12]]),
    (lambda: A.transpose(mat([1, 2, 3], [4, 5, 6])), [[1, 4], [2, 5], [3, 6]]),
    (lambda: A.reshape(vec(1, 2, 3, 4, 5, 6), 2, 3), [[1, 2, 3], [4, 5, 6]]),
    (lambda: A.gram(mat([1, 2], [0, 3])), [[5, 6], [6, 9]]), (lambda: A.squeeze(A.unsqueeze(vec(1, 2))), [1, 2]),
    (lambda: A.half_open(vec(0, 1, 2, 3), 1, 3), [1, 2]), (lambda: A.one_hot(F.lit(2), 4), [0, 0, 1, 0]),
    (lambda: A.arange(F.lit(1), F.lit(8), 3), [1, 4, 7]), (lambda: A.arange(F.lit(1), F.lit(7), 3), [1, 4]),
    (lambda: A.arange(F.lit(9), F.lit(7), 3), []), (lambda: A.filled(0, F.lit(2)), [0, 0]),
    (lambda: A.quantize(vec(0, 0), F.lit(0.0)), [0, 0]), (lambda: A.quantize(vec(1, -0.5), F.lit(1 / 127)), [127, -64])])
def test_expressions(spark, column, want):
    assert value(spark, column()) == want


def test_argmax_takes_the_first(spark):
    assert value(spark, A.argmax(vec(1, 3, 3))) == 1


def test_softmax(spark):
    big = vec(1000, 1001, 1002)
    odds = [math.exp(x) for x in (0, 1, 2)]
    assert value(spark, A.softmax(big)) == pytest.approx([o / sum(odds) for o in odds])
    assert value(spark, A.log_softmax(big)) == pytest.approx([math.log(o / sum(odds)) for o in odds])
    assert value(spark, A.confidence(big)) == pytest.approx(odds[2] / sum(odds))


def img():
    return mat([1, 2, 3], [4, 5, 6], [7, 8, 9])


@pytest.mark.parametrize("column,want", [
    (lambda: I.flip_horizontal(img()), [[3, 2, 1], [6, 5, 4], [9, 8, 7]]), (lambda: I.flip_vertical(img()), [[7, 8, 9], [4, 5, 6], [1, 2, 3]]),
    (lambda: I.center_crop(img(), 1, 1), [[5]]), (lambda: I.resize(img(), 2, 2), [[1, 2], [4, 5]]),
    (lambda: I.scale_intensity(mat([2, 2], [2, 2])), [[0, 0], [0, 0]]), (lambda: I.scale_intensity(mat([0, 5], [10, 10])), [[0, .5], [1, 1]]),
    (lambda: I.normalize(mat([1, 0]), 0.5, 0.5), [[1, -1]]), (lambda: I.denormalize(mat([1, -1])), [[1, 0]]),
    (lambda: I.warp(img(), I.rotation(F.lit(0.0))), [[1, 2, 3], [4, 5, 6], [7, 8, 9]]),
    (lambda: I.warp(img(), I.rotation(F.lit(180.0))), [[9, 8, 7], [6, 5, 4], [3, 2, 1]]),
    (lambda: I.warp(img(), I.affine(F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))), [[0, 1, 2], [0, 4, 5], [0, 7, 8]]),
    (lambda: I.warp(img(), I.perspective(3, 0.0, F.lit(1), 1)), [[1, 2, 3], [4, 5, 6], [7, 8, 9]])])
def test_images(spark, column, want):
    assert value(spark, column()) == want


def test_blur_keeps_a_constant_image(spark):
    got = value(spark, I.blur(mat([2, 2, 2], [2, 2, 2], [2, 2, 2]), 5, F.lit(1.0)))
    assert [x for row in got for x in row] == pytest.approx([2] * 9)


def test_placeholder(spark):
    got = value(spark, F.coalesce(F.lit(None).cast("array<array<double>>"), I.placeholder(4, 6)))
    assert got == [[255.0] * 6] * 4


def test_matmul_of_long_tables(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)], "i int, k int, v double")
    b = spark.createDataFrame([(0, 0, 2.0), (1, 0, 1.0), (1, 1, 3.0)], "k int, j int, v double")  # a zero left out
    got = {(r["i"], r["j"]): r["v"] for r in matrices.relational_matmul(a, b).collect()}
    assert got == {(0, 0): 4, (0, 1): 6, (1, 0): 10, (1, 1): 12}


def test_average_states(spark):
    rows = [(w, "w", p, float(w + p)) for w in (0, 1) for p in (0, 1)] + [(0, "n", 0, 5.0), (1, "n", 0, 9.0)]
    merged = matrices.average_states(
        spark.createDataFrame(rows, "worker int, key string, pos int, value double"), F.col("key") == "n")
    got = {r["key"]: r["values"] for r in matrices.rebuild_states(merged).collect()}
    assert got == {"w": [0.5, 1.5], "n": [5.0]}


@pytest.mark.parametrize("values,share", [
    ([3.0, -1.0, 2.0, 0.5, -0.5, 4.0, 0.0, 1.0, 1.0, -1.0], 0.4), ([1.0] * 10, 0.3), ([0.0] * 4 + [2.0] * 6, 0.2),
    ([float(i) for i in range(10)], 0.0), ([1e-300, 1e300, -1e-9, 5.0], 0.5)])
def test_magnitude_prune(spark, values, share):
    rows = [(i // 2, i % 2, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, pos int, value double")
    got = {(r["id"], r["pos"]): r["pruned"] for r in matrices.magnitude_prune(df, "id", share, 3).collect()}
    order = sorted(rows, key=lambda r: (abs(r[2]), r[0], r[1]))
    gone = {(r[0], r[1]) for r in order[:round(share * len(rows))]}
    assert {k for k, v in got.items() if v} == gone and len(got) == len(rows)


def test_value_sweeps(spark):
    rows = [(0, 0, 0.0, 1), (0, 0, 0.0, 0), (0, 1, 1.0, 2), (1, 0, 1.0, 2)]
    df = spark.createDataFrame(rows, "state int, action int, reward double, next_state int")
    got = {(r["state"], r["action"]): r["q"] for r in qvalues.q_value_iteration(df, 5).collect()}
    q = {(s, a): 0.0 for s, a, _, _ in rows}
    for _ in range(5):
        best = {s: max(v for (t, _), v in q.items() if t == s) for s, _ in q}
        mean = {}
        for s, a, r, n in rows:
            mean.setdefault((s, a), []).append(r + 0.9 * best.get(n, 0.0))
        q = {k: 0.9 * v + 0.1 * sum(mean[k]) / len(mean[k]) for k, v in q.items()}
    assert got == pytest.approx(q)
    tied = spark.createDataFrame([(0, 2, 1.0), (0, 1, 1.0), (0, 0, 0.5)], "state int, action int, q double")
    assert [(r["state"], r["action"]) for r in qvalues.greedy_action(tied).collect()] == [(0, 1)]


@pytest.mark.parametrize("tile", [2, 5, 128])
def test_matmul_of_tiles(spark, tile):
    """Sparse factors, a dense k, repeated entries and a null place against NumPy."""
    draw = np.random.default_rng(1)
    a = [(i, k, float(draw.normal())) for i in range(9) for k in range(7) if k == 3 or draw.random() < 0.4]
    b = [(k, j, float(draw.normal())) for k in range(7) for j in range(11) if k == 3 or draw.random() < 0.4]
    x, y = np.zeros((9, 7)), np.zeros((7, 11))
    for m, entries in ((x, a), (y, b)):
        for r, c, v in entries:
            m[r, c] += v
    left = spark.createDataFrame([*a, (1, None, 5.0)], "i long, k long, v double")
    right = spark.createDataFrame(b, "k long, j int, v double")
    got = {(r["i"], r["j"]): r["v"] for r in matrices.relational_matmul(left, right, tile).collect()}
    assert len(got) == 99 and all(abs((x @ y)[i, j] - v) < 1e-9 for (i, j), v in got.items())


def test_matmul_keeps_nan_to_its_row(spark):
    left = spark.createDataFrame([(0, 0, float("nan")), (1, 0, 2.0), (0, 1, 3.0), (1, 1, None)], "i int, k int, v double")
    right = spark.createDataFrame([(0, 0, 5.0), (1, 1, float("inf")), (1, 2, 7.0)], "k int, j int, v double")
    got = {(r["i"], r["j"]): r["v"] for r in matrices.relational_matmul(left, right).collect()}
    assert math.isnan(got.pop((0, 0))) and got == {(1, 0): 10.0, (0, 1): math.inf, (0, 2): 21.0}
