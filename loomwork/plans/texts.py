"""Text, chat and token features."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.functions import chat
from loomwork.functions import text as tx
from loomwork.operators import splits, tokens
from loomwork.plans import fragments as S
from loomwork.plans.registry import query
from loomwork.sources import tables as t

SEED = 11

RENDERED = S.TURNS + """,
rendered AS (SELECT conv_id, string_agg('<|im_start|>' || CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END ||
  chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text FROM turns GROUP BY conv_id)"""


def joined(ids):
    """Token ids as one string."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), ",")


def _documents(spark, d):
    return t.texts(spark, d)


@query("clean_special_chars", r"""
SELECT doc_id, regexp_replace(text, '[^a-zA-Z0-9.,?!\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|\n', '', 'g') AS cleaned FROM documents""")
def clean_special_chars(spark, d):
    return _documents(spark, d).select("doc_id", tx.clean_special_chars(F.col("text")).alias("cleaned"))


@query("split_sentences", f"WITH {S.SENTENCES} SELECT doc_id, pos, sentence FROM sentences")
def split_sentences(spark, d):
    return tokens.sentence_rows(_documents(spark, d), "doc_id", "text")


def _rendered(spark, d):
    return t.chat_records(spark, d).select(
        "id", chat.render_chatml(F.col("conversations")).alias("text"))


@query("render_chatml", f"""
WITH {RENDERED} SELECT conv_id::VARCHAR AS id, text FROM rendered""")
def render_chatml(spark, d):
    return _rendered(spark, d)


@query("render_chatml_vision", f"""
WITH {S.TURNS} SELECT conv_id, turn, '<|im_start|>user' || chr(10) || '<|vision_start|><|image_pad|><|vision_end|>' ||
  string_split(text, '</img>')[2] || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt
FROM turns WHERE role = 'user'""")
def render_chatml_vision(spark, d):
    asked = t.chat_turns(spark, d).where(F.col("role") == "user")
    return asked.select("conv_id", "turn", chat.render_chatml_vision(
        chat.strip_image_tag(F.col("text"))).alias("prompt"))


@query("strip_image_tag", f"""
WITH {S.TURNS} SELECT conv_id, turn, CASE WHEN text LIKE '%<img>%' AND text LIKE '%</img>%'
  THEN string_split(text, '</img>')[2] ELSE text END AS question FROM turns""")
def strip_image_tag(spark, d):
    return t.chat_turns(spark, d).select(
        "conv_id", "turn", chat.strip_image_tag(F.col("text")).alias("question"))


@query("replace_image_tag", f"""
WITH {S.TURNS} SELECT conv_id, turn, regexp_replace(text, '<img>.*?</img>', '[图像]', 'g') AS noted FROM turns""")
def replace_image_tag(spark, d):
    return t.chat_turns(spark, d).select(
        "conv_id", "turn", chat.replace_image_tag(F.col("text")).alias("noted"))


@query("cut_prompt", f"""
WITH {RENDERED} SELECT conv_id::VARCHAR AS id,
  string_split(text, '<|im_start|>assistant')[1] || '<|im_start|>assistant' || chr(10) AS prompt FROM rendered""")
def cut_prompt(spark, d):
    return _rendered(spark, d).select("id", chat.cut_prompt(F.col("text")).alias("prompt"))


@query("generated_suffix", f"""
WITH {RENDERED} SELECT conv_id::VARCHAR AS id,
  substr(text, length(string_split(text, '<|im_start|>assistant')[1]) + 23) AS generated FROM rendered""")
def generated_suffix(spark, d):
    return _rendered(spark, d).select("id", chat.generated_suffix(
        F.col("text"), chat.cut_prompt(F.col("text"))).alias("generated"))


@query("multipart_messages", f"""
WITH {S.TURNS}, placed AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS place FROM turns)
SELECT conv_id::VARCHAR AS id, place, 'user' AS role, 0::INTEGER AS piece, 'image' AS type,
  'images/' || conv_id || '.jpg' AS image, NULL::VARCHAR AS text FROM placed WHERE role = 'user'
UNION ALL SELECT conv_id::VARCHAR, place, 'user', 1, 'text', NULL, string_split(text, '</img>')[2] FROM placed
  WHERE role = 'user'
UNION ALL SELECT conv_id::VARCHAR, place, 'assistant', 0, 'plain', NULL, text FROM placed WHERE role <> 'user'""")
def multipart_messages(spark, d):
    messages = chat.multipart_messages(F.col("conversations"), F.col("image"))
    return (t.chat_records(spark, d).select("id", F.posexplode(messages).alias("place", "m"))
            .select("id", "place", F.col("m.role").alias("role"), F.posexplode("m.content").alias("piece", "c"))
            .select("id", "place", "role", "piece", "c.type", "c.image", "c.text"))


@query("json_request_reply", """
SELECT event_id, 'Hello ' || json_extract_string(props, '$.k') || '!' AS reply FROM events""")
def json_request_reply(spark, d):
    return t.load(spark, d, "events").select(
        "event_id", chat.json_request_reply(F.col("props"), "k").alias("reply"))


@query("build_vocab", f"WITH {S.VOCAB} SELECT word, token_id FROM vocab")
def build_vocab(spark, d):
    return tokens.build_vocab(_documents(spark, d), "text")


def _vocab(spark, d):
    return tokens.build_vocab(_documents(spark, d), "text")


ENCODED = S.VOCAB + """,
ids AS (SELECT w.doc_id, w.pos, coalesce(v.token_id, 1) AS t FROM words w LEFT JOIN vocab v USING (word)),
whole AS (SELECT d.doc_id, count(i.t)::INTEGER AS n, coalesce(list(i.t ORDER BY i.pos) FILTER (i.t IS NOT NULL), []) AS ids
  FROM documents d LEFT JOIN ids i USING (doc_id) GROUP BY d.doc_id),
fitted AS (SELECT doc_id, n, least(n, 512) AS kept, ids[1:512] AS ids FROM whole),
padded AS (SELECT doc_id, kept, list_concat(ids, list_transform(range(512 - kept), lambda x: 0)) AS input_ids,
  list_concat(list_transform(range(kept), lambda x: 1), list_transform(range(512 - kept), lambda x: 0)) AS mask FROM fitted)"""


@query("encode_pad", f"""
WITH {ENCODED} SELECT doc_id, label.quality AS label, array_to_string(input_ids, ',') AS input_ids,
  array_to_string(mask, ',') AS mask FROM padded LEFT JOIN labels label USING (doc_id)""")
def encode_pad(spark, d):
    labelled = _documents(spark, d).join(
        t.load(spark, d, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id", "left")
    encoded = tokens.encode_pad(labelled, ["doc_id"], "text", _vocab(spark, d), 512)
    return encoded.select("doc_id", "label", joined("input_ids").alias("input_ids"), joined("mask").alias("mask"))


@query("copy_labels", f"""
WITH {ENCODED} SELECT doc_id, md5(array_to_string(input_ids, ',')) AS ids_md5,
  array_to_string(input_ids, ',') AS labels FROM padded""")
def copy_labels(spark, d):
    encoded = tokens.copy_labels(tokens.encode_pad(_documents(spark, d), ["doc_id"], "text", _vocab(spark, d), 512))
    return encoded.select("doc_id", F.md5(joined("input_ids")).alias("ids_md5"), joined("labels").alias("labels"))


@query("pad_to_longest", f"""
WITH {ENCODED}, batched AS (SELECT doc_id, n, ids, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS batch_id FROM whole),
wide AS (SELECT *, (ceil(max(n) OVER (PARTITION BY batch_id) / 8) * 8)::INTEGER AS width FROM batched)
SELECT doc_id, batch_id, n, width,
  md5(array_to_string(list_concat(ids, list_transform(range(width - n), lambda x: 0)), ',')) AS ids_md5,
  md5(array_to_string(list_concat(list_transform(range(n), lambda x: 1), list_transform(range(width - n), lambda x: 0)), ','))
    AS mask_md5 FROM wide""")
def pad_to_longest(spark, d):
    # Encoded first: the batches then shuffle ids, not texts.
    ids = tokens.encode(_documents(spark, d), ["doc_id"], tx.lower_words(F.col("text")), _vocab(spark, d))
    encoded = splits.ordered_batches(ids.select("doc_id", "ids"), "doc_id", 8,
                                     rows_per_block=tokens.TEXTS_PER_BLOCK)
    return tokens.pad_to_longest(encoded, "batch_id").select(
        "doc_id", "batch_id", F.size("ids").alias("n"), "width",
        F.md5(joined("input_ids")).alias("ids_md5"), F.md5(joined("mask")).alias("mask_md5"))


def _encoded_pairs(spark, d):
    return tokens.encoded_pairs(_documents(spark, d), "doc_id", "text", _vocab(spark, d), 512).select("idx", "ids")


# (idx, nsp_label, ids): half of the pairs with the words after the separator shuffled
EXAMPLES = S.ENCODED_PAIRS + f""",
cuts AS (SELECT idx, ids, list_position(ids, 2) AS cut, {S.coin('idx', "'nsp'", "'11'")} < 0.5 AS swap FROM encoded),
spread AS (SELECT idx, swap, cut, unnest(ids) AS t, unnest(range(len(ids))) AS i FROM cuts),
examples AS (SELECT idx, CASE WHEN any_value(swap) THEN 0 ELSE 1 END::INTEGER AS nsp_label, any_value(cut) AS cut,
  list(t ORDER BY CASE WHEN i < coalesce(cut, 0) THEN i ELSE 1000000 END,
    CASE WHEN swap AND cut IS NOT NULL THEN md5(idx || ':' || (i - cut) || ':11') END, i) AS ids
  FROM spread GROUP BY idx)"""


def _examples(spark, d):
    return tokens.nsp_examples(_encoded_pairs(spark, d), "idx", SEED)


@query("nsp_examples", f"WITH {EXAMPLES} SELECT idx, nsp_label, array_to_string(ids, ',') AS input_ids FROM examples")
def nsp_examples(spark, d):
    return _examples(spark, d).select("idx", "nsp_label", joined("input_ids").alias("input_ids"))


@query("first_segment_labels", f"""
WITH {EXAMPLES}, labelled AS (SELECT idx, list_transform(ids, lambda x, i: CASE WHEN i < cut THEN x ELSE -100 END) AS labels
  FROM examples)
SELECT idx, array_to_string(labels, ',') AS labels FROM labelled""")
def first_segment_labels(spark, d):
    # What stands before the separator is never shuffled.
    return tokens.first_segment_labels(_encoded_pairs(spark, d), "ids").select("idx", joined("labels").alias("labels"))


@query("mlm_mask", f"""
WITH {S.ENCODED_PAIRS}, each AS (SELECT idx, unnest(ids) AS t, unnest(range(len(ids))) AS i FROM encoded),
hashed AS (SELECT *, md5(idx || ':' || (i // 4) || ':11') AS h, md5(idx || ':' || i || ':kind:11') AS k FROM each),
drawn AS (SELECT idx, i, t, t <> 2 AND ('0x' || substr(h, 8 * (i % 4)::INTEGER + 1, 8))::BIGINT
    / 4294967296.0::DOUBLE < 0.15 AS picked, ('0x' || k[1:8])::BIGINT / 4294967296.0::DOUBLE AS u,
  4 + floor(('0x' || k[9:16])::BIGINT / 4294967296.0::DOUBLE * (SELECT count(*) FROM vocab))::INTEGER AS other FROM hashed)
SELECT idx, string_agg(CASE WHEN NOT picked THEN t WHEN u < 0.8 THEN 3 WHEN u < 0.9 THEN other ELSE t END::VARCHAR, ','
  ORDER BY i) AS masked_ids, string_agg(CASE WHEN picked THEN t ELSE -100 END::VARCHAR, ',' ORDER BY i) AS mlm_labels
FROM drawn GROUP BY idx""")
def mlm_mask(spark, d):
    vocab = _vocab(spark, d)
    pairs = tokens.encoded_pairs(_documents(spark, d), "doc_id", "text", vocab, 512).select("idx", "ids")
    masked = tokens.mlm_mask(pairs, "idx", "ids", SEED, vocab.count())
    return masked.select("idx", joined("masked_ids").alias("masked_ids"), joined("mlm_labels").alias("mlm_labels"))
