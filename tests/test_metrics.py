"""Classifier metrics on small cases and as properties."""

import random

import pytest
from pyspark.sql import functions as F

from loomwork.operators import metrics

SCHEMA = "id long, label int, pred int, scores array<double>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def random_rows():
    """Three classes; class 2 is never present, scores are tied often."""
    draw = random.Random(4)
    rows = []
    for i in range(200):
        scores = [draw.randint(0, 6) / 2 for _ in range(3)]
        rows.append((i, draw.randint(0, 1), scores.index(max(scores)), scores))
    return rows


def pairwise_auc(rows, c):
    good = [s[c] for _, label, _, s in rows if label == c]
    bad = [s[c] for _, label, _, s in rows if label != c]
    if not good or not bad:
        return None
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_confusion_has_every_cell(spark, random_rows):
    cells = {(r["label"], r["pred"]): r["count"] for r in
             metrics.confusion_matrix(frame(spark, random_rows), 3).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 200
    assert cells[2, 0] == cells[2, 1] == cells[2, 2] == 0


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_auc_is_the_pairwise_one(spark, random_rows, limit):
    got = {r["class"]: r["auc"] for r in metrics.auc_ovr(frame(spark, random_rows), 3, limit).collect()}
    for c in range(3):
        want = pairwise_auc(random_rows, c)
        assert got[c] == (want if want is None else pytest.approx(want))


def test_auc_of_negated_scores(spark, random_rows):
    turned = [(i, label, pred, [-x for x in s]) for i, label, pred, s in random_rows]
    plain = {r["class"]: r["auc"] for r in metrics.auc_ovr(frame(spark, random_rows), 2).collect()}
    other = {r["class"]: r["auc"] for r in metrics.auc_ovr(frame(spark, turned), 2).collect()}
    assert all(plain[c] + other[c] == pytest.approx(1) for c in (0, 1))


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_roc_curve(spark, random_rows, limit):
    curve = metrics.roc_curve_ovr(frame(spark, random_rows), 2, limit).where("class = 0").orderBy(
        F.col("threshold").desc_nulls_first()).collect()
    assert (curve[0]["fpr"], curve[0]["tpr"], curve[0]["threshold"]) == (0, 0, None)
    assert (curve[-1]["fpr"], curve[-1]["tpr"]) == (1, 1)
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(curve, curve[1:]))
    assert area == pytest.approx(pairwise_auc(random_rows, 0))


def test_weighted_recall_is_accuracy(spark, random_rows):
    df = frame(spark, random_rows)
    right = metrics.accuracy(df).first()
    weighted = metrics.weighted_prf(df, 3).first()
    assert weighted["recall"] == pytest.approx(right["correct"] / right["total"])
    assert weighted["support"] == 200
    report = {r["name"]: r for r in metrics.classification_report(df, 3, ["a", "b", "c"]).collect()}
    assert report["c"]["support"] == 0 and report["c"]["recall"] == 0
    assert report["accuracy"]["f1"] == pytest.approx(weighted["recall"])


def test_batch_mean_is_not_row_mean(spark):
    rows = [(i, 0, 0, [float(i), 0.0]) for i in range(5)]
    df = frame(spark, rows).withColumn("batch_id", F.floor(F.col("id") / 4))
    by_row = metrics.nll_loss(df).first()
    by_batch = metrics.cross_entropy_batch_mean(df).first()
    import math
    loss = [math.log(1 + math.exp(-i)) for i in range(5)]
    assert by_row["loss_mean"] == pytest.approx(sum(loss) / 5)
    assert by_batch["loss"] == pytest.approx((sum(loss[:4]) / 4 + loss[4]) / 2)


def test_flag_without_label(spark):
    got = spark.createDataFrame([(1, 1), (1, 0), (1, None)], "p int, l int").select(
        metrics.flag_correct(F.col("p"), F.col("l")).alias("ok")).collect()
    assert [r["ok"] for r in got] == [True, False, None]
