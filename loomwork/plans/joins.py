"""Joins, crawls and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.functions import html
from loomwork.functions import text as tx
from loomwork.operators import counts, links, matrices
from loomwork.plans import fragments as S
from loomwork.plans.registry import query
from loomwork.sources import tables as t


@query("broadcast_lookup", """
SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def broadcast_lookup(spark, d):
    items = t.load(spark, d, "customer").select("c_custkey", "c_nationkey")
    table = t.load(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return links.broadcast_lookup(items, table, "c_nationkey").select("c_custkey", "c_nationkey", "n_name")


@query("follow_up_lookup", """
SELECT a.p_partkey, a.p_name, b.p_partkey AS next_key, b.p_name AS next_value
FROM part a LEFT JOIN part b ON b.p_partkey = a.p_partkey + 1""")
def follow_up_lookup(spark, d):
    return links.follow_up_lookup(t.load(spark, d, "part"), "p_partkey", "p_name")


@query("zip_features_labels", """
SELECT doc_id, md5(text) AS text_md5, quality, toxic FROM documents JOIN labels USING (doc_id)""")
def zip_features_labels(spark, d):
    paired = links.zip_by_key(t.load(spark, d, "documents").select("doc_id", "text"),
                              t.load(spark, d, "labels"), "doc_id")
    return paired.select("doc_id", F.md5("text").alias("text_md5"), "quality", "toxic")


@query("extract_links", f"""
WITH {S.ANCHORS}, last AS (SELECT page_id, min(ordinal) AS last FROM anchors
  WHERE href IS NOT NULL AND ordinal > 4 GROUP BY page_id)
SELECT a.page_id, a.ordinal, a.href FROM anchors a LEFT JOIN last USING (page_id)
WHERE a.href IS NOT NULL AND (a.ordinal <= 4 OR a.ordinal = last)""")
def extract_links(spark, d):
    return t.page_anchors(spark, d).select(
        "page_id", F.inline(html.followed(F.col("anchors"), links.DEFAULT_LINKS)))


@query("resolve_relative", f"WITH {S.RESOLVED} SELECT src, ordinal, href, dst FROM resolved")
def resolve_relative(spark, d):
    # The table's links all begin with a slash: a second form of each leads out of a folder.
    found = links.page_links(t.spread(t.load(spark, d, "pages").select("url", "html")))
    above = F.concat(F.lit(".."), F.col("href"), F.lit("/./?n="), F.col("ordinal"))
    forms = F.array(F.struct("ordinal", "href", "dst"),
                    F.struct((-F.col("ordinal")).alias("ordinal"), above.alias("href"),
                             html.resolve(F.col("src"), above).alias("dst")))
    return found.select("src", F.inline(forms))


@query("expand_links", f"""
WITH {S.EDGES} SELECT dst AS url, 1::INTEGER AS depth, count(*) AS copies FROM edges GROUP BY dst""")
def expand_links(spark, d):
    frontier = t.load(spark, d, "pages").select(
        "url", F.lit(0).alias("depth"), F.lit(1).cast("long").alias("copies"))
    return links.expand_links(frontier, t.page_edges(spark, d))


@query("crawl_bounded", f"""
WITH {S.CAPPED}, d0 AS (SELECT url, count(*) AS copies FROM pages GROUP BY url),
d1 AS (SELECT dst AS url, sum(copies) AS copies FROM d0 JOIN followed ON src = url GROUP BY dst),
d2 AS (SELECT dst AS url, sum(copies) AS copies FROM d1 JOIN followed ON src = url GROUP BY dst),
body AS (SELECT url, md5(min(html)) AS html_md5 FROM pages GROUP BY url),
returned AS (SELECT url, 0::INTEGER AS depth, copies::BIGINT AS copies FROM d0 UNION ALL
SELECT url, 1, copies::BIGINT FROM d1 UNION ALL SELECT url, 2, copies::BIGINT FROM d2)
SELECT url, depth, copies, html_md5 FROM returned JOIN body USING (url)""")
def crawl_bounded(spark, d):
    pages = t.load(spark, d, "pages")
    found = links.crawl_bounded(pages.select("url"), t.page_edges(spark, d), pages)
    return found.withColumn("html_md5", F.md5("html")).drop("html")


@query("crawl_dedup", f"""
WITH {S.CAPPED}, seeds AS (SELECT url, 1 AS copies FROM pages),
d0 AS (SELECT url, count(*) AS copies FROM seeds GROUP BY url),
d1 AS (SELECT dst AS url, sum(copies) AS copies FROM d0 JOIN followed ON src = url GROUP BY dst),
d2 AS (SELECT dst AS url, sum(copies) AS copies FROM d1 JOIN followed ON src = url GROUP BY dst),
d3 AS (SELECT dst AS url, sum(copies) AS copies FROM d2 JOIN followed ON src = url GROUP BY dst)
SELECT url, min(depth)::INTEGER AS depth, sum(copies)::BIGINT AS copies FROM (
SELECT url, 0 AS depth, copies FROM d0 UNION ALL SELECT url, 1, copies FROM d1
UNION ALL SELECT url, 2, copies FROM d2 UNION ALL SELECT url, 3, copies FROM d3) GROUP BY url""")
def crawl_dedup(spark, d):
    pages = t.load(spark, d, "pages")
    return links.crawl_bounded(pages.select("url"), t.page_edges(spark, d), pages, max_depth=2, dedup=True).drop("html")


@query("relational_matmul", f"""
WITH {S.ENTRIES}
SELECT a.pos AS i, b.pos AS j, round(sum(a.value * b.value), 6) AS v
FROM entries a JOIN entries b ON a.vec_id = b.vec_id GROUP BY a.pos, b.pos""")
def relational_matmul(spark, d):
    # E'E over all vectors: the inner dimension is the vector number.
    entries = t.vector_entries(spark, d)
    left = entries.select(F.col("pos").alias("i"), F.col("vec_id").alias("k"), F.col("value").alias("v"))
    right = entries.select(F.col("vec_id").alias("k"), F.col("pos").alias("j"), F.col("value").alias("v"))
    return matrices.relational_matmul(left, right).withColumn("v", F.round("v", 6))


@query("union_batches", """
SELECT doc_id, lang FROM documents UNION ALL SELECT doc_id, lang FROM documents WHERE lang IN ('fr', 'de')""")
def union_batches(spark, d):
    documents = t.load(spark, d, "documents").select("doc_id", "lang")
    repeated = [documents.where(F.col("lang") == lang) for lang in ("fr", "de")]
    return counts.union_batches(documents, *repeated)


@query("merge_reducers", f"""
WITH {S.WORDS}, parts AS (SELECT word, doc_id % 3 AS part, count(*) AS count FROM words GROUP BY ALL)
SELECT word, arg_max(count, part) AS count FROM parts GROUP BY word""")
def merge_reducers(spark, d):
    # Each third of the documents is a reducer of its own, so most words are shared.
    texts = t.texts(spark, d).withColumn("part", F.col("doc_id") % 3)
    words = texts.select("part", F.explode(tx.lower_words(F.col("text"))).alias("word"))
    parts = words.groupBy("part", "word").agg(F.count("*").alias("count"))
    return counts.merge_reducers(parts, "word", "count", "part")


@query("distinct_keys", """
SELECT DISTINCT label AS key FROM embeddings UNION SELECT quality FROM labels WHERE quality IS NOT NULL
UNION SELECT n_nationkey FROM nation""")
def distinct_keys(spark, d):
    return counts.distinct_keys(
        t.load(spark, d, "embeddings").select(F.col("label").alias("key")),
        t.load(spark, d, "labels").where(F.col("quality").isNotNull()).select("quality"),
        t.load(spark, d, "nation").select("n_nationkey"))
