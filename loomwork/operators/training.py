"""Classifier training and parameter averaging."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.operators import matrices, metrics, splits
from loomwork.operators.inference import batch_score, linear_model
from loomwork.session import materialize


def _buckets(text: Column, features: int) -> Column:
    """The hashed word of each place of a text."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    return F.transform(F.coalesce(words, F.array()), lambda w: F.pmod(F.xxhash64(w), F.lit(features)).cast("int"))


def _weighted(buckets: pd.Series, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the texts' word counts times ``idf``, each text of length 1."""
    rows = np.repeat(np.arange(len(buckets)), buckets.str.len().astype(int))
    flat = np.concatenate([np.zeros(0, dtype=np.int64), *buckets])
    cells, counts = np.unique(rows * len(idf) + flat.astype(np.int64), return_counts=True)
    row, bucket = cells // len(idf), cells % len(idf)
    value = counts * idf[bucket]
    length = np.sqrt(np.bincount(row, value * value, len(buckets)))
    return row, bucket, value / np.where(length > 0, length, 1.0)[row]


def _margins(batch: pd.DataFrame, idf: np.ndarray, weights: np.ndarray):
    row, bucket, value = _weighted(batch["buckets"], idf)
    return row, bucket, value, np.bincount(row, weights[bucket] * value, len(batch)) + weights[-1]


def _slopes(idf: np.ndarray, weights: np.ndarray):
    """A function of batches: the sum of the logistic loss's slopes over a task, where it is not zero."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(weights))
        for batch in batches:
            row, bucket, value, z = _margins(batch, idf, weights)
            slip = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - batch["label"].to_numpy()
            total[:-1] += np.bincount(bucket, slip[row] * value, len(idf))
            total[-1] += slip.sum()
        held = np.flatnonzero(total)
        yield pd.DataFrame({"pos": held, "value": total[held]})
    return run


def score_texts(rows: DataFrame, idf: np.ndarray, weights: np.ndarray) -> DataFrame:
    """(label, pred) of rows (label, buckets)."""
    def run(batches):
        for batch in batches:
            z = _margins(batch, idf, weights)[-1]
            yield pd.DataFrame({"label": batch["label"].astype("int32"), "pred": (z > 0).astype("int32")})
    return rows.select("label", "buckets").mapInPandas(run, "label int, pred int")


def train_text_classifier(labelled: DataFrame, key: str, seed: int, epochs: int, steps: int = 5,
                          features: int = 1 << 16, rate: float = 0.2, save: str | None = None) -> DataFrame:
    """(epoch, accuracy, precision, recall, f1, is_best) of a two-class model of hashed words.

    ``labelled`` is (key, text, label).  Split 80/20; an epoch is ``steps`` optimiser
    steps over all training rows and goes on from the weights the one before left.
    The best accuracy is marked, the first one among equals, and its weights are
    written to ``save`` as (pos, idf, value), the bias last.  A step is one sum by
    feature: the driver holds the weights, ``features`` + 1 numbers.
    """
    spark = labelled.sparkSession
    split = splits.split_fraction(labelled, key, seed).select(
        "split", "label", _buckets(F.col("text"), features).alias("buckets"))
    split = materialize(split.where(F.col("label").isNotNull()), "text-split")
    train, test = split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")
    held = train.select(F.explode(F.array_distinct("buckets")).alias("pos")).groupBy("pos").count().toPandas()
    n = train.count()
    found = np.zeros(features)
    found[held["pos"]] = held["count"]
    idf = np.log((n + 1) / (found + 1))
    weights, mean, square = np.zeros(features + 1), np.zeros(features + 1), np.zeros(features + 1)
    rows, best = [], None
    for epoch in range(1, epochs + 1):
        for step in range((epoch - 1) * steps + 1, epoch * steps + 1):
            total = train.mapInPandas(_slopes(idf, weights), "pos long, value double").groupBy("pos").agg(
                F.sum("value").alias("value")).toPandas()
            slope = np.zeros(features + 1)
            slope[total["pos"]] = total["value"] / max(n, 1)
            mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
            weights = weights - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        scored = materialize(score_texts(test, idf, weights), "text-scored")
        right, prf = metrics.accuracy(scored).first(), metrics.weighted_prf(scored, 2).first()
        percent = float(right["percent"] or 0)
        rows.append((epoch, percent, prf["precision"], prf["recall"], prf["f1"]))
        if best is None or percent > best[1]:
            best = epoch, percent, weights
    if save and best:
        table = pd.DataFrame({"pos": np.arange(features + 1), "idf": np.append(idf, 0.0), "value": best[2]})
        spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(save)
    return spark.createDataFrame(
        [(*r, r[0] == best[0]) for r in rows],
        "epoch int, accuracy double, precision double, recall double, f1 double, is_best boolean")


def load_text_classifier(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(idf, weights) as ``train_text_classifier`` saved them."""
    table = spark.read.parquet(path).toPandas().sort_values("pos")
    return table["idf"].to_numpy()[:-1], table["value"].to_numpy()


def train_vector_classifier(vectors: DataFrame, key: str, classes: int, seed: int,
                            iterations: int = 20) -> DataFrame:
    """(split, rows, accuracy, macro_auc): a new last layer on fixed features, split 80/10/10."""
    split = materialize(splits.split_three_way(vectors, key, seed).withColumn(
        "features", array_to_vector("vec")).select(key, "label", "features", "split"), "vector-split")
    train = split.where("split = 'train'")
    model = LogisticRegression(maxIter=iterations, family="multinomial").fit(train)
    scored = model.transform(split).select(
        "split", "label", F.col("prediction").cast("int").alias("pred"),
        vector_to_array("probability").alias("scores"))
    rows = []
    for name in ("val", "test"):
        part = scored.where(F.col("split") == name)
        right, area = metrics.accuracy(part).first(), metrics.macro_auc(part, classes).first()
        rows.append((name, right["total"], float(right["percent"]), area["macro_auc"]))
    return vectors.sparkSession.createDataFrame(
        rows, "split string, rows long, accuracy double, macro_auc double")


def _sgd(weights: dict[int, np.ndarray], classes: int, rate: float, size: int):
    """A function of Arrow batches: one pass of softmax regression per shard in the task, from the shard's weights.

    Rows stream through in steps of ``size``; only the weights are kept.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local: dict[int, np.ndarray] = {}
        rest: dict[int, tuple] = {}

        def learn(shard, x, y):
            w = local[shard]
            z = x @ w.T
            z = np.exp(z - z.max(axis=1, keepdims=True))
            w -= rate * ((z / z.sum(axis=1, keepdims=True) - y).T @ x) / len(x)

        for batch in batches:
            for shard, rows in batch.groupby("shard"):
                local.setdefault(shard, weights[shard].copy())
                x = np.stack(rows["vec"].to_numpy())
                x = np.hstack([x, np.ones((len(x), 1))])
                y = np.eye(classes)[rows["label"].to_numpy()]
                if shard in rest:  # steps do not depend on how rows fall into batches
                    x, y = np.vstack([rest[shard][0], x]), np.vstack([rest[shard][1], y])
                whole = len(x) - len(x) % size
                for start in range(0, whole, size):
                    learn(shard, x[start:start + size], y[start:start + size])
                rest[shard] = x[whole:], y[whole:]
        for shard, (x, y) in rest.items():
            if len(x):
                learn(shard, x, y)
        for shard, w in local.items():
            yield pd.DataFrame({"worker": shard, "key": "weights", "pos": np.arange(w.size),
                                "value": w.ravel()})
    return run


def parameter_averaging_rounds(vectors: DataFrame, key: str, classes: int, dim: int, shards: int | None,
                               rounds: int, rate: float = 0.5, size: int = 32, every: int = 1) -> DataFrame:
    """(round, averaged, accuracy): shards train on their own; every ``every`` rounds and at the end they average.

    Between averagings a shard goes on from its own weights.  The accuracy is that of
    the mean of the shards' weights, whether they take it over or not.  ``shards`` is
    the number of workers, that of the cluster's task slots if None.  The driver
    holds the weights only: classes * (dim + 1) numbers a shard.
    """
    shards = shards or vectors.sparkSession.sparkContext.defaultParallelism
    rows = materialize(splits.contiguous_shards(vectors, key, shards), "shards")
    # One shuffle for all rounds; a lost piece is rebuilt from the written table in the same order.
    data = rows.repartition(shards, "shard").sortWithinPartitions("shard", key).persist()
    own = {shard: np.zeros((classes, dim + 1)) for shard in range(shards)}
    out = []
    for step in range(1, rounds + 1):
        local = materialize(data.select("shard", "vec", "label").mapInPandas(
            _sgd(own, classes, rate, size), "worker int, key string, pos int, value double"), "local")
        weights = np.zeros((classes, dim + 1))
        for entry in matrices.average_states(local, F.lit(False)).select("pos", "value").collect():
            weights.flat[entry["pos"]] = entry["value"]
        averaged = step % every == 0 or step == rounds
        if averaged:
            own = {shard: weights for shard in own}
        else:
            for shard, part in local.toPandas().groupby("worker"):
                own[shard] = part.sort_values("pos")["value"].to_numpy().reshape(classes, dim + 1)
        load = linear_model(weights[:, :dim].tolist(), weights[:, dim].tolist())
        scored = batch_score(rows, key, "vec", load, keep=("label",))
        out.append((step, averaged, float(metrics.accuracy(scored).first()["percent"])))
    data.unpersist()
    return vectors.sparkSession.createDataFrame(out, "round int, averaged boolean, accuracy double")
