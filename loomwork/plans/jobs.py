"""User functions, batch inference, training jobs and streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from loomwork.operators import inference, matrices, training
from loomwork.plans import fragments as S
from loomwork.plans.registry import query
from loomwork.sources import tables as t
from loomwork.streaming import jobs

CLASSES, DIM = 10, 64

# A small English to French word table, the stand-in for a translation model.
FRENCH = {"the": "le", "and": "et", "of": "de", "to": "à", "in": "dans", "is": "est", "that": "que",
          "for": "pour", "on": "sur", "with": "avec", "from": "de", "by": "par", "are": "sont"}


def _text_shape(batch: pd.DataFrame) -> pd.DataFrame:
    words = batch["text"].str.split()
    return pd.DataFrame({"doc_id": batch["doc_id"], "words": words.str.len().astype("int64"),
                         "longest": words.map(lambda w: max(map(len, w), default=0)).astype("int64")})


def _lines(text):
    for number, line in enumerate(text.split("\n") if text is not None else ()):
        yield number, len(line)


@query("map_rows", r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS ws FROM documents)
SELECT doc_id, len(ws) AS words, coalesce(list_max(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS longest FROM w""")
def map_rows(spark, d):
    return inference.map_rows(t.texts(spark, d), _text_shape,
                              "doc_id long, words long, longest long")


@query("flat_map_rows", """
SELECT doc_id, unnest(range(len(l))) AS line, unnest(list_transform(l, lambda x: length(x)))::BIGINT AS n_chars
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)""")
def flat_map_rows(spark, d):
    return inference.lateral_rows(t.texts(spark, d), _lines, ["text"], "line long, n_chars long").drop("text")


def _centroids(spark, d):
    """Weights and bias of a linear scorer: the mean vector of each class, CLASSES * DIM numbers.

    A class without vectors is never chosen.
    """
    states = t.vector_entries(spark, d).select(
        F.col("vec_id").alias("worker"), F.col("label").alias("key"), "pos", "value")
    weights, bias = [[0.0] * DIM for _ in range(CLASSES)], [float("-inf")] * CLASSES
    for row in matrices.average_states(states, F.lit(False)).collect():
        weights[row["key"]][row["pos"]], bias[row["key"]] = row["value"], 0.0
    return weights, bias


@query("batch_score", f"""
WITH {S.ENTRIES}, mean AS (SELECT label AS c, pos, avg(value) AS w FROM entries GROUP BY ALL),
logits AS (SELECT vec_id, c, sum(value * w) AS z FROM entries JOIN mean USING (pos) GROUP BY vec_id, c),
best AS (SELECT vec_id, arg_max(c, z) AS pred, max(z) AS top FROM logits GROUP BY vec_id)
SELECT vec_id, pred, round(1 / sum(exp(z - top)), 6) AS confidence FROM logits JOIN best USING (vec_id) GROUP BY vec_id, pred""")
def batch_score(spark, d):
    load = inference.linear_model(*_centroids(spark, d))
    scored = inference.batch_score(t.vectors(spark, d), "vec_id", "vec", load)
    return scored.withColumn("confidence", F.round("confidence", 6))


_TABLE = ", ".join(f"('{a}', '{b}')" for a, b in FRENCH.items())


@query("two_stage_inference", f"""
WITH {S.WORDS}, tally AS (SELECT doc_id, word, count(*) AS n, min(pos) AS first FROM words GROUP BY doc_id, word),
kept AS (SELECT * FROM tally QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) <= 15),
french AS (SELECT * FROM (VALUES {_TABLE}) v(word, other))
SELECT doc_id, coalesce(string_agg(word, ' ' ORDER BY first), '') AS summary,
  coalesce(string_agg(coalesce(other, word), ' ' ORDER BY first), '') AS translation
FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN french USING (word) GROUP BY doc_id""")
def two_stage_inference(spark, d):
    return inference.two_stage_inference(t.texts(spark, d), "doc_id", "text", FRENCH)


@query("train_text_classifier")
def train_text_classifier(spark, d):
    labelled = t.load(spark, d, "documents").join(t.load(spark, d, "labels"), "doc_id").select(
        "doc_id", "text", F.col("quality").cast("double").alias("label"))
    return training.train_text_classifier(labelled, "doc_id", 5, epochs=3)


@query("train_vector_classifier")
def train_vector_classifier(spark, d):
    return training.train_vector_classifier(t.vectors(spark, d), "vec_id", CLASSES, 5)


@query("parameter_averaging_rounds")
def parameter_averaging_rounds(spark, d):
    return training.parameter_averaging_rounds(t.vectors(spark, d), "vec_id", CLASSES, DIM, 4, 10, every=5)


def _events(spark, d):
    return jobs.read_stream(spark, f"{d}/events.parquet")


@query("account_stream", f"""
WITH RECURSIVE {S.STEPS}
SELECT account, arg_max(balance, n)::DOUBLE AS balance, count(*) FILTER (status = 'accepted') AS accepted,
  count(*) FILTER (status = 'rejected') AS rejected FROM steps WHERE account IN (SELECT account FROM ops) GROUP BY account""")
def account_stream(spark, d):
    out, checkpoint = jobs.stream_folders(spark, "account-stream")
    jobs.account_stream(t.as_account_ops(_events(spark, d)), out, checkpoint)
    return t.as_doubles(jobs.account_states(spark, out))


@query("counter_stream", "SELECT user_id, count(*) AS calls FROM events GROUP BY user_id")
def counter_stream(spark, d):
    out, checkpoint = jobs.stream_folders(spark, "counter-stream")
    jobs.counter_stream(_events(spark, d), "user_id", out, checkpoint)
    return jobs.latest_states(spark, out, "user_id")


@query("request_stream", """
SELECT event_id AS id, 'Hello ' || json_extract_string(props, '$.k') || '!' AS reply FROM events""")
def request_stream(spark, d):
    out, checkpoint = jobs.stream_folders(spark, "request-stream")
    jobs.request_stream(_events(spark, d).select(F.col("event_id").alias("id"), F.col("props").alias("body")),
                        out, checkpoint, "k")
    return spark.read.schema("id long, reply string").parquet(out)


@query("metric_stream", "SELECT event_type AS tag, event_id AS step, value FROM events")
def metric_stream(spark, d):
    out, checkpoint = jobs.stream_folders(spark, "metric-stream")
    scalars = _events(spark, d).select(
        F.col("event_type").alias("tag"), F.col("event_id").alias("step"), "value")
    jobs.metric_stream(scalars, out, checkpoint)
    return spark.read.schema("step long, value double, tag string, batch int").parquet(out).drop("batch")
