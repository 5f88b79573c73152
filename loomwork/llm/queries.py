"""The queries of this subpackage; each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import (
    bpe, collocations, language, licences, line_chunks, minhash_docs, packing, paragraphs, pseudonyms, quality, toxicity, vector_cells,
    whitening)
from loomwork.plans.registry import Registry

PSEUDONYM_KEY = "loomwork"   # a deployment passes its own secret

REGISTRY = Registry()
query = REGISTRY.query


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: the folds of the training queries."""
    return F.crc32(F.col(key).cast("string")) % parts


OP1_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings),
fit AS (SELECT * FROM v WHERE len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
  AND len([x FOR x IN e IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS i, b.vec_id AS j FROM fit a JOIN fit b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS i, vec_id AS r FROM v UNION SELECT l.j, reach.r FROM reach JOIN links l ON l.i = reach.i),
counts AS (SELECT i, count(*) AS n FROM links GROUP BY i)
SELECT v.vec_id, CAST(coalesce(any_value(c.n), 0) AS BIGINT) AS n_links, min(r) AS component_id,
  min(r) = v.vec_id AS kept
FROM v JOIN reach ON reach.i = v.vec_id LEFT JOIN counts c ON c.i = v.vec_id GROUP BY v.vec_id
"""


@query("op1_embedding_cells", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return vector_cells.near_vectors(table(spark, folder, "embeddings"))


# Word shingles of four, linked at 80 per cent or more; the component by repeated minima over the links.
OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT i, j FROM common JOIN sizes si ON si.doc_id = i JOIN sizes sj ON sj.doc_id = j
  WHERE 100 * c >= 80 * (si.n + sj.n - c)),
reach AS (SELECT doc_id AS i, doc_id AS r FROM sets UNION SELECT l.j, reach.r FROM reach JOIN links l ON l.i = reach.i)
SELECT s.doc_id, s.n AS n_shingles, min(r) AS component_id, min(r) = s.doc_id AS kept
FROM sizes s JOIN reach ON reach.i = s.doc_id GROUP BY s.doc_id, s.n
"""


@query("op2_minhash_documents", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash_docs.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op3_language_codes")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(True))
    model = language.train(docs, ~held_out)
    found = language.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op4_paragraph_bands")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_units(table(spark, folder, "documents"))


@query("op5_toxicity_pairs")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    machine = toxicity.train(docs, table(spark, folder, "labels"), remainder("_id", 3) != 1)
    return toxicity.score(docs, machine).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(True)).alias("held_out"), "score", "predicted")


@query("op6_pii_pseudonyms")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, count="n_values")


@query("op7_pair_index_bpe")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_decode(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_line_chunks")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_chunks.dedup_runs(docs, count="lines_removed")


@query("op9_cost_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_quality_rules")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"))


# Whole phrases counted per language; the lowest-scoring cut counts; longer phrases of half the count cover shorter ones.
OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM words, (VALUES (1), (2), (3)) t(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT lang, k, phrase, a, c, array_to_string(w[1:c], ' ') AS p1, array_to_string(w[c + 1:], ' ') AS p2
  FROM cand, (VALUES (1), (2)) t(c) WHERE c < k),
scores AS (SELECT cuts.*, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p1 JOIN f y ON y.lang = cuts.lang AND y.phrase = p2),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
covered AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
  FROM cand WHERE k = 3),
outside AS (SELECT lang, phrase, max(a) AS most FROM covered GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN outside o ON o.lang = lowest.lang AND o.phrase = lowest.phrase AND k = 2
  WHERE o.most IS NULL OR 100 * o.most < 50 * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= 2000
"""


@query("op11_collocations", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_components(table(spark, folder, "embeddings"))


@query("op13_licence_scan")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))
