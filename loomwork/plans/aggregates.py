"""Counts, totals, classifier metrics, losses and averaged states."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.functions import arrays
from loomwork.functions import text as tx
from loomwork.operators import counts, matrices, metrics, series, splits
from loomwork.plans import fragments as S
from loomwork.plans.registry import query
from loomwork.sources import tables as t

CLASSES = 10
RATES = ("precision", "recall", "f1")

# (label, precision, recall, f1, support), each class counted on its own
PRF = S.PRED + """,
tally AS (SELECT c::INTEGER AS label, count(*) FILTER (label = c AND pred = c) AS tp,
  count(*) FILTER (pred = c) AS predicted, count(*) FILTER (label = c) AS support FROM pred, range(10) k(c) GROUP BY c),
rates AS (SELECT label, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM tally),
prf AS (SELECT label, precision, recall, CASE WHEN precision + recall > 0
  THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1, support FROM rates)"""

# (class, score, label) one row per row and class
SCORED = S.PRED + """,
scored AS (SELECT id, label, (k - 1)::INTEGER AS class, scores[k] AS score FROM pred, range(1, 11) r(k))"""

# Mid-rank form of the area under the curve.
AUC = SCORED + """,
ranked AS (SELECT class, label, rank() OVER (PARTITION BY class ORDER BY score)
  + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0::DOUBLE AS r FROM scored),
area AS (SELECT class, sum(r) FILTER (label = class) AS s, count(*) FILTER (label = class) AS p,
  count(*) FILTER (label <> class) AS n FROM ranked GROUP BY class),
auc AS (SELECT class, CASE WHEN p > 0 AND n > 0 THEN (s - p * (p + 1) / 2.0::DOUBLE) / (p * n) END AS auc FROM area)"""

# Loss of each row
NLL = S.PRED + """,
loss AS (SELECT id, list_max(scores) + ln(list_sum(list_transform(scores, lambda x: exp(x - list_max(scores)))))
  - scores[label + 1] AS nll FROM pred)"""


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("word_count", """
SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def word_count(spark, d):
    return counts.word_count(t.texts(spark, d), "text")


@query("word_count_lower", f"WITH {S.WORDS} SELECT word, count FROM counted")
def word_count_lower(spark, d):
    return counts.word_count_lower(t.texts(spark, d), "text").orderBy(F.desc("count"), "word")


@query("sort_top_k", f"WITH {S.WORDS} SELECT word, count FROM counted ORDER BY count DESC, word LIMIT 20")
def sort_top_k(spark, d):
    return splits.sort_top_k(counts.word_count_lower(t.texts(spark, d), "text"), "count", "word", 20)


@query("first_letter_partition", f"""
WITH {S.WORDS}, placed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents),
mapped AS (SELECT doc_id, (idx // ((SELECT count(*) FROM documents) // 3))::INTEGER AS mapper FROM placed
  WHERE idx < 3 * ((SELECT count(*) FROM documents) // 3))
SELECT mapper, (unicode(word) % 3)::INTEGER AS bucket, count(*) AS size FROM words JOIN mapped USING (doc_id)
GROUP BY ALL""")
def first_letter_partition(spark, d):
    chunks = splits.chunk_partitions(t.texts(spark, d), "doc_id", 3)
    return counts.block_sizes(chunks, F.col("chunk"), tx.lower_words(F.col("text")), 3)


@query("class_counts", "SELECT quality, count(*) AS count FROM labels WHERE quality IS NOT NULL GROUP BY ROLLUP (quality)")
def class_counts(spark, d):
    return counts.class_counts(t.load(spark, d, "labels"), "quality")


@query("total_sum", """
SELECT 'event values' AS name, round(sum(value), 2) AS total FROM events UNION ALL
SELECT 'line values', round(sum(l_quantity + l_discount + l_tax), 2) FROM lineitem""")
def total_sum(spark, d):
    events = t.load(spark, d, "events").agg(F.round(F.sum("value"), 2).alias("total"))
    three = F.col("l_quantity") + F.col("l_discount") + F.col("l_tax")
    lines = t.load(spark, d, "lineitem").agg(F.round(F.sum(three), 2).alias("total"))
    return (events.select(F.lit("event values").alias("name"), "total")
            .unionByName(lines.select(F.lit("line values").alias("name"), "total")))


@query("vector_norm_sum", f"""
WITH {S.ENTRIES} SELECT round(sqrt(sum(value * value)), 6) AS norm, round(sum(value), 6) AS total FROM entries""")
def vector_norm_sum(spark, d):
    vec = F.col("vec")
    return t.vectors(spark, d).agg(F.round(F.sqrt(F.sum(arrays.dot(vec, vec))), 6).alias("norm"),
                                   F.round(F.sum(arrays.total(vec)), 6).alias("total"))


@query("confusion_matrix", f"""
WITH {S.PRED}, cells AS (SELECT a::INTEGER AS label, b::INTEGER AS pred FROM range(10) x(a), range(10) y(b))
SELECT c.label, c.pred, count(p.id) AS count FROM cells c
LEFT JOIN pred p ON p.label = c.label AND p.pred = c.pred GROUP BY c.label, c.pred""")
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(t.predictions(spark, d), CLASSES)


@query("accuracy", f"""
WITH {S.PRED} SELECT sum((pred = label)::BIGINT)::BIGINT AS correct, count(*) AS total,
  round(100 * sum((pred = label)::BIGINT) / count(*), 2) AS percent,
  floor(100 * sum((pred = label)::BIGINT) / count(*))::BIGINT AS percent_int FROM pred""")
def accuracy(spark, d):
    return metrics.accuracy(t.predictions(spark, d))


@query("per_class_prf", f"""
WITH {PRF} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
FROM prf""")
def per_class_prf(spark, d):
    return _rounded(metrics.per_class_prf(t.predictions(spark, d), CLASSES), *RATES)


@query("weighted_prf", f"""
WITH {PRF} SELECT round(sum(precision * support) / sum(support), 6) AS precision,
  round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1,
  sum(support)::BIGINT AS support FROM prf""")
def weighted_prf(spark, d):
    return _rounded(metrics.weighted_prf(t.predictions(spark, d), CLASSES), *RATES)


@query("classification_report", f"""
WITH {PRF}, mean AS (SELECT sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
  sum(f1 * support) / sum(support) AS wf, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
  sum(support)::BIGINT AS s FROM prf),
report AS (SELECT 'class_' || label AS name, precision, recall, f1, support FROM prf
  UNION ALL SELECT 'accuracy', wr, wr, wr, s FROM mean
  UNION ALL SELECT 'macro avg', mp, mr, mf, s FROM mean
  UNION ALL SELECT 'weighted avg', wp, wr, wf, s FROM mean)
SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report""")
def classification_report(spark, d):
    names = [f"class_{c}" for c in range(CLASSES)]
    return _rounded(metrics.classification_report(t.predictions(spark, d), CLASSES, names), *RATES)


@query("roc_curve_ovr", f"""
WITH {SCORED}, per AS (SELECT class, score, count(*) FILTER (label = class) AS pos,
  count(*) FILTER (label <> class) AS neg FROM scored GROUP BY class, score),
curve AS (SELECT class, score AS threshold,
  sum(neg) OVER w / nullif(sum(neg) OVER (PARTITION BY class), 0) AS fpr,
  sum(pos) OVER w / nullif(sum(pos) OVER (PARTITION BY class), 0) AS tpr
  FROM per WINDOW w AS (PARTITION BY class ORDER BY score DESC))
SELECT class, threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM curve
UNION ALL SELECT c::INTEGER, NULL, 0.0, 0.0 FROM range(10) k(c)""")
def roc_curve_ovr(spark, d):
    return _rounded(metrics.roc_curve_ovr(t.predictions(spark, d), CLASSES), "fpr", "tpr")


@query("auc_ovr", f"WITH {AUC} SELECT class, round(auc, 6) AS auc FROM auc")
def auc_ovr(spark, d):
    return _rounded(metrics.auc_ovr(t.predictions(spark, d), CLASSES), "auc")


@query("macro_auc", f"WITH {AUC} SELECT round(avg(auc), 6) AS macro_auc FROM auc")
def macro_auc(spark, d):
    return _rounded(metrics.macro_auc(t.predictions(spark, d), CLASSES), "macro_auc")


@query("nll_loss", f"WITH {NLL} SELECT round(sum(nll), 6) AS loss_sum, round(avg(nll), 6) AS loss_mean FROM loss")
def nll_loss(spark, d):
    return _rounded(metrics.nll_loss(t.predictions(spark, d)), "loss_sum", "loss_mean")


@query("cross_entropy_batch_mean", f"""
WITH {NLL}, batched AS (SELECT avg(nll) AS m FROM
  (SELECT nll, (row_number() OVER (ORDER BY id) - 1) // 64 AS b FROM loss) GROUP BY b)
SELECT round(avg(m), 6) AS loss, count(*) AS batches FROM batched""")
def cross_entropy_batch_mean(spark, d):
    batched = splits.ordered_batches(t.predictions(spark, d), "id", 64)
    return _rounded(metrics.cross_entropy_batch_mean(batched), "loss")


@query("mse_loss", """
WITH price AS (SELECT sum(l_extendedprice) / sum(l_quantity) AS unit FROM lineitem)
SELECT round(avg((l_extendedprice - l_quantity * unit) * (l_extendedprice - l_quantity * unit)), 2) AS mse
FROM lineitem, price""")
def mse_loss(spark, d):
    lines = t.load(spark, d, "lineitem").select("l_extendedprice", "l_quantity")
    unit = lines.agg(F.sum("l_extendedprice") / F.sum("l_quantity")).first()[0]
    return metrics.mse_loss(lines, F.col("l_extendedprice"), F.col("l_quantity") * F.lit(unit)).select(
        F.round("mse", 2).alias("mse"))


@query("epoch_average_loss", """
SELECT day(ts)::INTEGER AS epoch, round(avg(value), 10) AS mean_loss FROM events GROUP BY 1""")
def epoch_average_loss(spark, d):
    return series.epoch_average_loss(t.load(spark, d, "events"), F.dayofmonth("ts"), "value").withColumn(
        "mean_loss", F.round("mean_loss", 10))


@query("average_states", f"""
WITH {S.ENTRIES}, states AS (SELECT vec_id AS worker, 'layer_' || label AS key, pos, value FROM entries
  UNION ALL SELECT vec_id, 'steps_' || label, 0, vec_id::DOUBLE FROM embeddings)
SELECT key, pos, CASE WHEN key LIKE 'steps%' THEN min(value) ELSE round(avg(value), 6) END AS value
FROM states GROUP BY key, pos""")
def average_states(spark, d):
    layers = t.vector_entries(spark, d).select(
        F.col("vec_id").alias("worker"), F.concat(F.lit("layer_"), "label").alias("key"), "pos", "value")
    steps = t.load(spark, d, "embeddings").select(
        F.col("vec_id").alias("worker"), F.concat(F.lit("steps_"), "label").alias("key"),
        F.lit(0).alias("pos"), F.col("vec_id").cast("double").alias("value"))
    return _rounded(matrices.average_states(
        layers.unionByName(steps), F.col("key").startswith("steps_")), "value")


@query("rebuild_states", f"""
WITH {S.ENTRIES}, mean AS (SELECT 'layer_' || label AS key, pos, avg(value) AS value FROM entries GROUP BY ALL)
SELECT key, count(*)::INTEGER AS size, {S.fixed6('list(value ORDER BY pos)')} AS state FROM mean GROUP BY key""")
def rebuild_states(spark, d):
    layers = t.vector_entries(spark, d).select(
        F.col("vec_id").alias("worker"), F.concat(F.lit("layer_"), "label").alias("key"), "pos", "value")
    rebuilt = matrices.rebuild_states(matrices.average_states(layers, F.lit(False)))
    return rebuilt.select("key", F.size("values").alias("size"), arrays.fixed6(F.col("values")).alias("state"))


@query("mean_steps", """
SELECT sum(n)::BIGINT AS steps, count(*) AS episodes, round(avg(n), 6) AS mean_steps
FROM (SELECT count(*) AS n FROM events GROUP BY user_id)""")
def mean_steps(spark, d):
    return _rounded(series.mean_steps(t.load(spark, d, "events"), "user_id"), "mean_steps")


@query("elapsed_min_sec", """
SELECT user_id, s // 60 AS minutes, s % 60 AS seconds FROM
(SELECT user_id, (max(epoch_us(ts)) - min(epoch_us(ts))) // 1000000 AS s FROM events GROUP BY user_id)""")
def elapsed_min_sec(spark, d):
    return series.elapsed_min_sec(t.load(spark, d, "events"), "user_id", t.micros())
