"""Dense indexes and running values, with blocks and hot keys forced by small limits."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from loomwork.operators import matrices, metrics, scan, splits


@pytest.fixture(scope="module")
def skewed(spark):
    """1000 rows of which a third belong to key 7 and a tenth to the null key; many rows share a t."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 11)
    return (spark.range(1000).withColumn("key", key)
            .withColumn("t", F.when(F.col("id") % 7 == 2, F.lit(None))
                        .otherwise(F.floor(F.col("id") * 37 % 1000 / 5)))).repartition(5)


def place(t, i):
    """Sort key of an order that has nulls first."""
    return (t is not None, t or 0, i)


@pytest.mark.parametrize("limit", [10, 64, 5000])
def test_dense_index(skewed, limit):
    out, rows = scan.dense_index(skewed, ["t", "id"], rows_per_block=limit)
    got = sorted(out.collect(), key=lambda r: r["idx"])
    assert rows == 1000 and [r["idx"] for r in got] == list(range(1000))
    assert [r["id"] for r in got] == [r["id"] for r in sorted(got, key=lambda r: place(r["t"], r["id"]))]


DAY = datetime.date(2024, 1, 1)
ORDERS = {
    "string": ([None, "", "b", "a", "10", "9", "é", "a"] * 8, lambda x: (x is not None, (x or "").encode())),
    "date": ([None, *[DAY + datetime.timedelta(d) for d in (5, 1, 3, 1)]] * 12, lambda x: (x is not None, x or DAY)),
    "double": ([None, float("nan"), 1.5, -2.0, float("inf"), 1.5] * 10,
               lambda x: (x is not None, x is not None and math.isnan(x), 0 if x is None or math.isnan(x) else x)),
}


@pytest.mark.parametrize("kind", list(ORDERS))
@pytest.mark.parametrize("limit", [7, 1000])
def test_order_columns_of_any_type(spark, kind, limit):
    values, rank = ORDERS[kind]
    df = spark.createDataFrame(list(enumerate(values)), f"id bigint, s {kind}").repartition(4)
    out, rows = scan.dense_index(df, ["s", "id"], rows_per_block=limit)
    got = sorted(out.collect(), key=lambda r: r["idx"])
    want = sorted(range(len(values)), key=lambda i: (rank(values[i]), i))
    assert rows == len(values) and [r["id"] for r in got] == want and [r["idx"] for r in got] == list(range(rows))
    batched = splits.ordered_batches(df, "s", 10, rows_per_block=limit).collect()
    assert len(batched) == rows and max(r["batch_id"] for r in batched) == (rows - 1) // 10
    summed = {r["id"]: r["n"] for r in scan.running(df, [], ["s", "id"], {"n": F.lit(1)}, limit).collect()}
    assert [summed[i] for i in want] == list(range(1, rows + 1))


@pytest.mark.parametrize("limit", [20, 100, 5000])
def test_running_and_following(skewed, limit):
    order = ["t", "id"]
    summed = scan.running(skewed, ["key"], order, {"n": F.lit(1), "s": F.col("id")}, limit)
    after = scan.following(skewed, ["key"], order, "id", "next", limit)
    rows = {r["id"]: r for r in summed.collect()}
    nexts = {r["id"]: r["next"] for r in after.collect()}
    assert len(rows) == len(nexts) == 1000
    groups = {}
    for r in sorted(skewed.collect(), key=lambda r: place(r["t"], r["id"])):
        groups.setdefault(r["key"], []).append(r["id"])
    for ids in groups.values():
        for at, this in enumerate(ids):
            assert rows[this]["n"] == at + 1
            assert rows[this]["s"] == sum(ids[:at + 1])
            assert nexts[this] == (ids[at + 1] if at + 1 < len(ids) else None)


@pytest.mark.parametrize("limit", [7, 5000])
def test_index_with_next(skewed, limit):
    out = scan.index_with_next(skewed, ["id"], "t", sized_by=skewed, rows_per_block=limit)
    t = {r["id"]: r["t"] for r in skewed.collect()}
    got = {r["idx"]: (r["id"], r["next"]) for r in out.collect()}
    assert got == {i: (i, t[(i + 1) % 1000]) for i in range(1000)}


def test_split_marks_only_hot_keys(skewed):
    out, split = scan.split_hot_keys(skewed, ["key"], ["t", "id"], limit=80)
    blocks = {r["key"]: r["b"] for r in out.groupBy("key").agg(F.countDistinct("_blk").alias("b")).collect()}
    assert split and blocks[7] > 1 and blocks[None] >= 1
    assert all(n == 1 for key, n in blocks.items() if key not in (7, None))
    assert out.count() == 1000


def test_a_value_that_fills_blocks_is_cut_too(spark):
    """Half of the rows share the first order column."""
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 9).alias("t"),
                                  (F.col("id") * 7919 % 1000).alias("id")).repartition(3)
    sizes = [r["count"] for r in scan.cut(df, ["t", "id"], 20, "cut").groupBy("_blk").count().collect()]
    assert max(sizes) < 150


@pytest.mark.parametrize("pieces,rows", [(5, 3), (5, 5), (4, 11), (3, 0)])
def test_pieces(spark, pieces, rows):
    """n div k rows each: with fewer rows than pieces all go to the last shard, and no chunk is full."""
    df = spark.range(rows).withColumnRenamed("id", "k")
    shards = {r["k"]: r["shard"] for r in splits.contiguous_shards(df, "k", pieces, rows_per_block=2).collect()}
    size = rows // pieces
    assert shards == {i: min(i // size, pieces - 1) if size else pieces - 1 for i in range(rows)}
    chunks = {r["k"]: r["chunk"] for r in splits.chunk_partitions(df, "k", pieces, rows_per_block=2).collect()}
    assert chunks == {i: i // size for i in range(size * pieces)}


def test_curves_with_nan_scores(spark):
    """Cut classes give the same curve as whole ones; NaN is the largest score."""
    rows = [(i, i % 2, [float("nan") if i % 10 == 0 else (i * 7 % 23) / 23, (i % 5) / 5]) for i in range(80)]
    df = spark.createDataFrame(rows, "id bigint, label int, scores array<double>")
    auc = [{r["class"]: r["auc"] for r in metrics.auc_ovr(df, 2, limit).collect()} for limit in (None, 4)]
    assert auc[0] == pytest.approx(auc[1])
    curves = [sorted((r["class"], r["fpr"], r["tpr"]) for r in metrics.roc_curve_ovr(df, 2, limit).collect())
              for limit in (None, 4)]
    assert curves[0] == curves[1] and len(curves[0]) > 20


@pytest.mark.parametrize("values", [[5e-324, 1e-323, 0.0, 5e-324, 2.0], [10.0 ** k for k in range(-300, 301, 100)],
                                    [1.0] * 9, [3.0, -1.0, 2.0, -5.0, 0.5, 0.5, 0.5, float("nan"), None]])
@pytest.mark.parametrize("share", [0.2, 0.5, 1.0])
def test_prune_any_range(spark, values, share):
    entries = spark.createDataFrame([("w", i, v) for i, v in enumerate(values)], "key string, pos int, value double")
    got = matrices.magnitude_prune(entries, "key", share, rows_per_block=2).collect()

    def size(v):
        return (v is not None, v is not None and math.isnan(v), 0 if v is None or math.isnan(v) else abs(v))
    first = sorted(range(len(values)), key=lambda i: (size(values[i]), i))[:round(share * len(values))]
    assert {r["pos"] for r in got if r["pruned"]} == set(first) and len(got) == len(values)


def test_empty_input(skewed):
    none = skewed.where("id < 0")
    out, rows = scan.dense_index(none, ["id"])
    assert rows == 0 and out.count() == 0


@pytest.mark.parametrize("values", [
    [0.0] * 50 + [-0.0] * 10 + [1.0, -2.0, 5e-324], [None, None, 3.0, float("nan"), float("-inf"), 1e308, -1e-300, 0.1],
    [float(i % 7 - 3) for i in range(80)], [None] * 4, [float("nan")] * 3 + [1.0]])
def test_radix_selection(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "m double").repartition(3)
    rank = [(0, 0) if v is None else (2, 0) if math.isnan(v) else (1, abs(v)) for v in values]
    ordered = sorted(rank)
    for k in range(1, len(values) + 1, max(1, len(values) // 9)):
        found, below = matrices._kth_smallest(df, k)
        got = (0, 0) if found is None else (2, 0) if math.isnan(found) else (1, found)
        assert got == ordered[k - 1] and below == sum(r < got for r in rank)


def test_pruning_equal_magnitudes(spark):
    """Of many equal magnitudes the first by key and place go, and no sort gathers them."""
    rows = [(f"k{i % 3}", i, 0.0 if i % 10 else 1.0 + i) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, pos int, value double").repartition(4)
    out = matrices.magnitude_prune(df, "key", 0.5, rows_per_block=30).collect()
    zeros = sorted((k, p) for k, p, v in rows if v == 0)
    assert {(r["key"], r["pos"]) for r in out if r["pruned"]} == set(zeros[:200])
