"""Sources, sinks, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.functions import chat, html
from loomwork.functions import text as tx
from loomwork.operators import ledger, metrics
from loomwork.plans import fragments as S
from loomwork.plans.registry import query
from loomwork.session import new_folder
from loomwork.sources import files, sinks
from loomwork.sources import tables as t

# Names of the two classes and of an unknown one.
CLASS_NAMES, UNKNOWN_CLASS = {0: "假新闻", 1: "真新闻"}, "未知标签"


def _labelled(spark, d):
    return t.load(spark, d, "documents").join(t.load(spark, d, "labels"), "doc_id", "left")


@query("read_labelled_tsv", """
SELECT doc_id, md5(nullif(text, '')) AS text_md5, length(nullif(text, ''))::INTEGER AS n, quality::DOUBLE AS label
FROM documents LEFT JOIN labels USING (doc_id)""")
def read_labelled_tsv(spark, d):
    path = new_folder(spark, "labelled-tsv")
    files.write_delimited(_labelled(spark, d).select("doc_id", "text", "quality"), path, "\t")
    back = files.read_labelled_tsv(spark, path, "doc_id long, text string, label double")
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n"), "label")


@query("read_notes_csv", """
SELECT doc_id, md5(t) AS text_md5, (length(t) - length(replace(t, chr(10), '')))::INTEGER AS line_breaks
FROM (SELECT doc_id, nullif(text, '') AS t FROM documents)""")
def read_notes_csv(spark, d):
    path = new_folder(spark, "notes-csv")
    notes = t.load(spark, d, "documents").select("doc_id", F.col("text").alias("TEXT"))
    files.write_delimited(notes, path, ",")
    back = files.read_notes_csv(spark, path, "doc_id long, TEXT string")
    breaks = F.length("TEXT") - F.length(F.replace(F.col("TEXT"), F.lit("\n"), F.lit("")))
    return back.select("doc_id", F.md5("TEXT").alias("text_md5"), breaks.alias("line_breaks"))


def _written_records(spark, d):
    path = new_folder(spark, "chat")
    sinks.write_chat_jsonl(t.chat_records(spark, d).select("id", "image", "conversations"), path)
    return files.read_chat_jsonl(spark, path)


@query("read_chat_jsonl", f"""
WITH {S.TURNS}
SELECT conv_id::VARCHAR AS id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS place,
  role, text FROM turns""")
def read_chat_jsonl(spark, d):
    return (_written_records(spark, d).select("id", F.posexplode("conversations").alias("place", "t"))
            .select("id", "place", F.col("t.from").alias("role"), F.col("t.value").alias("text")))


@query("chat_columns", f"""
WITH {S.TURNS}
SELECT conv_id::VARCHAR AS id, 'images/' || conv_id || '.jpg' AS image_path,
  string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS conversations FROM turns GROUP BY conv_id""")
def chat_columns(spark, d):
    shown = F.array_join(F.transform("conversations", lambda m: F.concat(
        m["from"], F.lit(": "), m["value"])), "\n")
    return files.chat_columns(t.chat_records(spark, d)).withColumn("conversations", shown)


@query("list_labelled_files", """
SELECT 'lang=' || lang AS class_name, (dense_rank() OVER (ORDER BY lang) - 1)::INTEGER AS class_idx, count(*) AS texts
FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def list_labelled_files(spark, d):
    # A folder per language; how many files Spark writes into each is its own choice.
    root = new_folder(spark, "labelled")
    docs = t.load(spark, d, "documents").where(F.col("lang").isNotNull()).select("lang", F.col("doc_id").cast("string"))
    docs.write.partitionBy("lang").text(root)
    listed = files.list_labelled_files(spark, root, "part-*")
    lines = spark.read.text(root).groupBy(F.concat(F.lit("lang="), "lang").alias("class_name")).agg(
        F.count("*").alias("texts"))
    return listed.select("class_name", "class_idx").distinct().join(lines, "class_name")


@query("rows_from_items", """
WITH items AS (SELECT * FROM (VALUES ('en'), ('fr'), ('de'), ('es'), ('xx')) v(lang))
SELECT i.lang, count(d.doc_id) AS docs, coalesce(sum(d.n_chars), 0)::BIGINT AS chars
FROM items i LEFT JOIN documents d ON d.lang = i.lang GROUP BY i.lang""")
def rows_from_items(spark, d):
    items = files.rows_from_items(spark, ["en", "fr", "de", "es", "xx"], "lang")
    sizes = t.load(spark, d, "documents").groupBy("lang").agg(
        F.count("doc_id").alias("docs"), F.sum("n_chars").alias("chars"))
    return items.join(sizes, "lang", "left").na.fill(0, ["docs", "chars"])


@query("page_source", f"""
WITH {S.EDGES}, asked AS (SELECT DISTINCT dst AS url FROM edges
  UNION ALL SELECT 'http://unknown.example/' || page_id FROM pages)
SELECT a.url, md5(p.html) AS html_md5, length(p.html)::INTEGER AS n FROM asked a LEFT JOIN pages p ON p.url = a.url""")
def page_source(spark, d):
    pages = t.load(spark, d, "pages")
    unknown = pages.select(F.concat(F.lit("http://unknown.example/"), "page_id").alias("url"))
    asked = t.page_edges(spark, d).select(F.col("dst").alias("url")).distinct().union(unknown)
    return files.fetch_pages(asked, pages).select(
        "url", F.md5("html").alias("html_md5"), F.length("html").alias("n"))


@query("write_chat_jsonl", f"""
WITH {S.TURNS}
SELECT conv_id::VARCHAR AS id, 'images/' || conv_id || '.jpg' AS image, count(*)::INTEGER AS turns,
  md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS digest FROM turns GROUP BY conv_id""")
def write_chat_jsonl(spark, d):
    shown = F.array_join(F.transform("conversations", lambda m: F.concat(
        m["from"], F.lit(": "), m["value"])), "\n")
    return _written_records(spark, d).select(
        "id", "image", F.size("conversations").alias("turns"), F.md5(shown).alias("digest"))


@query("write_text_corpus", f"""
WITH {S.TURNS}
SELECT string_agg('<|im_start|>' || CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END || chr(10) ||
  regexp_replace(text, '<img>.*?</img>', '[图像]', 'g') || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text
FROM turns GROUP BY conv_id""")
def write_text_corpus(spark, d):
    path = new_folder(spark, "corpus")
    rendered = chat.render_chatml(F.col("conversations"), chat.replace_image_tag)
    sinks.write_text_corpus(t.chat_records(spark, d).select(rendered.alias("text")), path)
    return spark.read.schema("text string").json(path)


@query("snapshot_save_restore", """
WITH steps AS (SELECT user_id, CASE WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END AS version, value
  FROM events WHERE event_type = 'signup'),
saved AS (SELECT user_id, version, 100 + sum(sum(value::DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY version) AS balance
  FROM steps GROUP BY user_id, version),
latest AS (SELECT * FROM saved QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY version DESC) = 1)
SELECT c_custkey AS account, balance::DOUBLE AS balance,
  (CASE WHEN version IS NOT NULL THEN 20 END)::INTEGER AS minimal, version::INTEGER AS version
FROM customer LEFT JOIN latest ON user_id = c_custkey""")
def snapshot_save_restore(spark, d):
    path = new_folder(spark, "snapshot")
    signups = t.load(spark, d, "events").where(F.col("event_type") == "signup").select(
        F.col("user_id").alias("account"), F.dayofmonth("ts").alias("day"),
        F.col("value").cast("decimal(18,2)").alias("value"))
    # Each version saves the accounts that changed in its ten days.
    for version, (first, last) in enumerate([(1, 10), (11, 20), (21, 31)], 1):
        so_far = signups.where(F.col("day") <= last).groupBy("account").agg(
            F.sum("value").alias("s"), F.max("day").alias("latest"))
        changed = so_far.where(F.col("latest") >= first).select(
            "account", (F.col("s") + t.OPENING).cast("decimal(18,2)").alias("balance"),
            F.lit(t.MINIMAL).alias("minimal"))
        sinks.save_snapshot(changed, path, version)
    keys = t.load(spark, d, "customer").select(F.col("c_custkey").alias("account"))
    return t.as_doubles(sinks.restore_snapshot(spark, path, keys, "account"))


@query("verify_digest", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN md5(html) = md5(url) END AS verdict FROM pages""")
def verify_digest(spark, d):
    expected = (F.when(F.col("page_id") % 3 == 0, F.md5("html"))
                .when(F.col("page_id") % 3 == 1, F.md5("url")))
    return t.load(spark, d, "pages").select(
        "page_id", sinks.verify_digest(F.col("html"), expected).alias("verdict"))


@query("metric_log_sink", """
SELECT event_type AS tag, (24 * (day(ts) - 1) + hour(ts))::INTEGER AS step, round(avg(value), 10) AS value
FROM events GROUP BY ALL""")
def metric_log_sink(spark, d):
    path = new_folder(spark, "metrics")
    step = sinks.global_step(F.dayofmonth("ts") - 1, F.hour("ts"), 24)
    scalars = (t.load(spark, d, "events").groupBy(F.col("event_type").alias("tag"), step.alias("step"))
               .agg(F.round(F.avg("value"), 10).alias("value")))
    sinks.append_metrics(scalars, path)
    return spark.read.schema("step int, value double, tag string").parquet(path)


@query("preview_rows", """
SELECT doc_id, lang, source, n_chars, (SELECT count(*) FROM documents) AS n_rows, 5::INTEGER AS n_columns
FROM documents ORDER BY doc_id LIMIT 5""")
def preview_rows(spark, d):
    documents = t.load(spark, d, "documents")
    head = documents.select("doc_id", "lang", "source", "n_chars").orderBy("doc_id").limit(5)
    return head.withColumns({"n_rows": F.lit(documents.count()).cast("long"),
                             "n_columns": F.lit(len(documents.columns))})


@query("select_dropna_cast", """
SELECT doc_id, text, quality::DOUBLE AS label FROM documents LEFT JOIN labels USING (doc_id)
WHERE text IS NOT NULL AND quality IS NOT NULL""")
def select_dropna_cast(spark, d):
    return (_labelled(spark, d).select("doc_id", "text", F.col("quality").alias("label"))
            .na.drop("any", subset=["text", "label"])
            .withColumn("label", F.col("label").cast("double")))


@query("drop_source_columns", """
SELECT conv_id, turn, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered
FROM conversations""")
def drop_source_columns(spark, d):
    return (t.load(spark, d, "conversations")
            .withColumn("rendered", chat.turn_block(F.col("role"), F.col("text")))
            .drop("role", "text"))


@query("remap_label", """
SELECT vec_id, CASE label WHEN 0 THEN '假新闻' WHEN 1 THEN '真新闻' ELSE '未知标签 ' || label END AS name FROM embeddings""")
def remap_label(spark, d):
    return t.load(spark, d, "embeddings").select(
        "vec_id", tx.label_name(F.col("label"), CLASS_NAMES, UNKNOWN_CLASS).alias("name"))


@query("text_preview", """
SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview,
  substr(text, 1, 100) || '...' AS always FROM documents""")
def text_preview(spark, d):
    return t.load(spark, d, "documents").select(
        "doc_id", tx.preview(F.col("text"), 200).alias("preview"),
        tx.preview(F.col("text"), 100, always=True).alias("always"))


@query("flag_correct", f"""
WITH {S.PRED} SELECT id, pred = nullif(label, 9) AS correct FROM pred""")
def flag_correct(spark, d):
    known = F.when(F.col("label") != 9, F.col("label"))
    return t.predictions(spark, d).select("id", metrics.flag_correct(F.col("pred"), known).alias("correct"))


@query("web_links_only", f"""
WITH {S.ANCHORS}, links AS (SELECT page_id, ordinal,
  CASE ordinal % 3 WHEN 0 THEN 'https://site.example' || href WHEN 1 THEN 'mailto:' || href ELSE href END AS href
  FROM anchors WHERE href IS NOT NULL)
SELECT * FROM links WHERE regexp_matches(href, '^https?://', 'i')""")
def web_links_only(spark, d):
    # The table's hrefs are all relative: some get a host, some another scheme.
    place, href = F.col("ordinal") % 3, F.col("href")
    links = (t.page_anchors(spark, d).select("page_id", F.inline("anchors")).where(href.isNotNull())
             .withColumn("href", F.when(place == 0, F.concat(F.lit("https://site.example"), href))
                         .when(place == 1, F.concat(F.lit("mailto:"), href)).otherwise(href)))
    return links.where(html.is_web_link(href))


@query("restore_or_init", """
WITH saved AS (SELECT user_id, 100 + sum(value::DECIMAL(18,2)) AS balance FROM events
  WHERE event_type = 'signup' GROUP BY user_id)
SELECT c_custkey AS account,
  (CASE WHEN balance IS NOT NULL THEN balance WHEN c_acctbal >= 20 THEN c_acctbal END)::DECIMAL(18,2)::DOUBLE AS balance,
  (CASE WHEN balance IS NOT NULL OR c_acctbal >= 20 THEN 20 END)::DOUBLE AS minimal,
  CASE WHEN balance IS NOT NULL THEN 'restored' WHEN c_acctbal >= 20 THEN 'opened' ELSE 'rejected' END AS status
FROM customer LEFT JOIN saved ON user_id = c_custkey""")
def restore_or_init(spark, d):
    path = new_folder(spark, "accounts")
    state = (t.load(spark, d, "events").where(F.col("event_type") == "signup")
             .groupBy(F.col("user_id").alias("account"))
             .agg((F.sum(F.col("value").cast("decimal(18,2)")) + t.OPENING).cast("decimal(18,2)").alias("balance"))
             .withColumn("minimal", F.lit(t.MINIMAL)))
    sinks.save_snapshot(state, path, 1)
    keys = t.load(spark, d, "customer").select(F.col("c_custkey").alias("account"), "c_acctbal")
    saved = sinks.restore_snapshot(spark, path, keys.select("account"), "account")
    return t.as_doubles(ledger.restore_or_init(keys, saved, "account", F.col("c_acctbal"), t.MINIMAL))
