"""Operator 5, toxicity by a factorization machine over hashed terms.

A text's features are its distinct terms: runs of letters and digits, lower-cased
in A-Z, and their first ``STEM`` bytes (so an inflected insult is known by its stem),
hashed to 64 bits (no shared buckets, so a rare word cannot pass for an insult).  Which hashed terms become features is learned: terms frequent enough
among the training texts, those that separate the labels and those that are most
common (a group mention may say nothing alone).  The machine adds a linear
weight per term and, for every pair of terms, the product of their factor vectors:
an insult beside a mention may weigh more than both alone.

Training takes at most ``bound`` labelled texts, drawn by the digest of their id;
equal texts count once, with the mean of their labels.  Each round every task
improves its own copy of the machine on its share (Adam on the logistic loss) and
the copies are averaged, weighed by rows.

A null or empty text has no terms and scores the bias.  Labels that are null are
not used; several labels of one document are averaged.  Repeated rows get equal
scores.  An empty table gives an empty result; without labels every score is 0.5.
Only the key and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm import vectorwords as vw
from loomwork.session import materialize

BOUND = 40_000         # labelled texts used in training
STEM = 7               # bytes of a word that make its stem
MIN_TEXTS = 3          # training texts a term must occur in
FAR = 4.0              # deviations from the base rate that make a term telling
TELLING, COMMON = 4_096, 512
FACTORS = 4
SHARDS, ROUNDS, STEPS = 4, 6, 25
RATE, SHRINK = 0.2, 1e-4
CLEAR = 6.0            # deviations at which a telling term's value reaches 1
FAINT = 0.05           # value of the other terms
THRESHOLD = 0.7

# A term ends at any ASCII character that is no letter or digit.
_GAP = np.zeros(256, dtype=bool)
_GAP[:0x80] = [not chr(b).isalnum() for b in range(0x80)]


class Machine(NamedTuple):
    """Sorted term hashes with value, linear weight and factors, and the bias."""
    terms: np.ndarray
    values: np.ndarray
    linear: np.ndarray
    factors: np.ndarray
    bias: float

    def scores(self, texts: np.ndarray, features: np.ndarray, rows: int) -> np.ndarray:
        """Probability of label 1 for ``rows`` texts from (text, feature) pairs."""
        x = self.values[features]
        raw = np.full(rows, self.bias) + np.bincount(texts, self.linear[features] * x, rows)
        for k in range(self.factors.shape[1]):
            vx = self.factors[features, k] * x
            raw += 0.5 * (np.bincount(texts, vx, rows) ** 2 - np.bincount(texts, vx * vx, rows))
        return 1 / (1 + np.exp(-np.clip(raw, -60, 60)))


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every term, first term of every text): two terms a word, itself and its stem."""
    data, offsets = vw.column_bytes(column)
    found = vw.find_words(data, offsets, _GAP)
    whole = vw.hash_spans(data, found.start, found.end, vw.LOWER)
    stems = vw.hash_spans(data, found.start, np.minimum(found.end, found.start + STEM), vw.LOWER)
    both = np.stack([whole, vw.mix(stems + np.uint64(1))], axis=1).ravel()
    return vw.as_long(both), 2 * found.first


def _features(hashes: np.ndarray, first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs of the terms that are features."""
    if len(terms) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    held = np.flatnonzero(terms[place] == hashes)
    text = np.searchsorted(first, held, side="right") - 1
    both = np.unique(text * len(terms) + place[held])
    return both // len(terms), both % len(terms)


def _training_terms(docs: DataFrame, labels: DataFrame, training: Column, key: str, text: str, label: str,
                    bound: int) -> DataFrame:
    """(label, terms): distinct training texts with the mean of their labels."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("_id"), F.col(label).cast("double").alias("_label")).where(training)
    share = int(min(1.0, bound / max(1, known.count())) * (1 << 30))
    drawn = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < share).groupBy("_id").agg(
        F.avg("_label").alias("_label"))
    # about ``bound`` rows of 16 bytes: a broadcast is safe
    rows = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(drawn), "_id").select("_label", "text")

    def work(batches):
        for batch in vw.slices(batches):
            hashes, first = _terms(batch.column(1))
            sets = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]
            keys = vw.set_keys([s.view(np.uint64) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(sets, pa.list_(pa.int64()))],
                ["label", "k1", "k2", "terms"])

    hashed = rows.mapInArrow(work, "label double, k1 bigint, k2 bigint, terms array<bigint>")
    return hashed.groupBy("k1", "k2").agg(F.avg("label").alias("label"), F.first("terms").alias("terms")).select(
        "k1", "label", "terms")


def _choose(train: DataFrame, rows: int, base: float, min_texts: int, telling: int, common: int) -> pd.DataFrame:
    """(term, value): the chosen terms; at most ``telling + common`` rows reach the driver."""
    counts = materialize(train.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("n"), F.sum("label").alias("s")).where(F.col("n") >= min_texts), "terms")
    far = F.abs(F.col("s") - F.col("n") * base) / F.sqrt(F.col("n") * F.lit(base * (1 - base)) + 1e-9)
    scored = counts.withColumn("far", far)
    best = scored.where(F.col("far") >= FAR).orderBy(F.desc("far"), "term").limit(telling).toPandas()
    most = scored.orderBy(F.desc("n"), "term").limit(common).toPandas()
    chosen = pd.concat([best, most]).drop_duplicates("term").sort_values("term", ignore_index=True)
    value = np.where(chosen["far"] >= FAR, np.minimum(chosen["far"] / CLEAR, 1.0), FAINT)
    return chosen.assign(value=value)[["term", "value"]]


def _improve(machine: Machine, label: np.ndarray, texts: np.ndarray, features: np.ndarray, steps: int) -> Machine:
    """Adam steps on the mean logistic loss of all rows, given as (text, feature) pairs."""
    rows, width, count = len(label), len(machine.terms), machine.factors.shape[1]
    x = machine.values[features]
    now = [machine.linear, machine.factors, np.array(machine.bias)]
    mean, square = [np.zeros_like(p) for p in now], [np.zeros_like(p) for p in now]
    for step in range(1, steps + 1):
        linear, factors, bias = now
        slip = (machine._replace(linear=linear, factors=factors, bias=float(bias)).scores(texts, features, rows)
                - label) / rows
        push = slip[texts] * x
        slope = np.empty((width, count))
        for k in range(count):
            vx = factors[features, k] * x
            slope[:, k] = np.bincount(features, push * (np.bincount(texts, vx, rows)[texts] - vx), width)
        slopes = [np.bincount(features, push, width) + SHRINK * linear, slope + SHRINK * factors, slip.sum()]
        for i, g in enumerate(slopes):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.99 * square[i] + 0.01 * g * g
            now[i] = now[i] - RATE * (mean[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.99 ** step)) + 1e-8)
    return machine._replace(linear=now[0], factors=now[1], bias=float(now[2]))


def _shard_step(shared):
    """One round on a shard: its rows to a row with the improved machine."""
    def improve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k1")
        texts = np.repeat(np.arange(len(rows)), [len(f) for f in rows["features"]])
        features = np.concatenate([np.asarray(f, dtype=np.int64) for f in rows["features"]])
        new = _improve(Machine(*shared.value), rows["label"].to_numpy(), texts, features, STEPS)
        return pd.DataFrame({"n": [len(rows)], "bias": [new.bias], "linear": [new.linear.tolist()],
                             "factors": [new.factors.ravel().tolist()]})
    return improve


def train(docs: DataFrame, labels: DataFrame, training: Column, key: str = "doc_id", text: str = "text",
          label: str = "toxic", bound: int = BOUND, rounds: int = ROUNDS, shards: int = SHARDS,
          min_texts: int = MIN_TEXTS) -> Machine:
    """Fit on the labelled documents for which ``training`` (over the id as ``_id``) holds."""
    rows = materialize(_training_terms(docs, labels, training, key, text, label, bound), "training")
    n, mean = rows.agg(F.count("*"), F.avg("label")).first()
    if not n:
        return Machine(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0), np.zeros((0, FACTORS)), 0.0)
    base = min(max(float(mean), 1e-6), 1 - 1e-6)
    chosen = _choose(rows, n, base, min_texts, TELLING, COMMON)
    terms, values = chosen["term"].to_numpy(dtype=np.int64), chosen["value"].to_numpy()
    spark = docs.sparkSession
    shared_terms = spark.sparkContext.broadcast(terms)

    def locate(batches):
        terms = shared_terms.value
        for batch in batches:
            places = []
            for own in batch.column(1).to_numpy(zero_copy_only=False):
                own = np.asarray(own, dtype=np.int64)
                at = np.searchsorted(own, terms) if len(own) else np.zeros(len(terms), dtype=int)
                held = own[np.minimum(at, len(own) - 1)] == terms if len(own) else np.zeros(len(terms), bool)
                places.append(np.flatnonzero(held).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(places, pa.list_(pa.int32())), batch.column(2), batch.column(3)],
                ["label", "features", "k1", "shard"])

    located = materialize(rows.select("label", "terms", "k1", F.pmod(F.xxhash64("k1"), F.lit(shards)).cast("int").alias("shard"))
                          .mapInArrow(locate, "label double, features array<int>, k1 bigint, shard int"), "located")
    draw = np.random.default_rng(3)
    machine = Machine(terms, values, np.zeros(len(terms)), draw.normal(0, 0.02, (len(terms), FACTORS)),
                      float(np.log(base / (1 - base))))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(tuple(machine))

        # a row per shard, each the size of the machine
        parts = located.groupBy("shard").applyInPandas(
            _shard_step(shared), "n bigint, bias double, linear array<double>, factors array<double>").toPandas()
        weight = parts["n"].to_numpy() / parts["n"].sum()
        machine = machine._replace(
            bias=float((parts["bias"] * weight).sum()),
            linear=np.average(np.stack([np.asarray(v) for v in parts["linear"]]), axis=0, weights=weight),
            factors=np.average(np.stack([np.asarray(v) for v in parts["factors"]]), axis=0, weights=weight)
            .reshape(len(terms), FACTORS))
        shared.unpersist()
    return machine


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """(key, score, predicted) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(machine))

    def work(batches):
        machine = Machine(*shared.value)
        for batch in vw.slices(batches):
            hashes, first = _terms(batch.column(1))
            texts, features = _features(hashes, first, machine.terms)
            found = machine.scores(texts, features, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                [key, "score", "predicted"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(
        work, f"`{key}` {kind}, score double, predicted int")


def acceptable(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text scores below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(machine))

    def work(batches):
        machine = Machine(*shared.value)
        for batch in vw.slices(batches, text):
            hashes, first = _terms(batch.column(batch.schema.get_field_index(text)))
            texts, features = _features(hashes, first, machine.terms)
            yield batch.filter(pa.array(machine.scores(texts, features, batch.num_rows) < threshold))

    return docs.mapInArrow(work, docs.schema)
