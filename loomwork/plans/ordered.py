"""Windows, splits, batches, ledgers, histories and value sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.functions import chat
from loomwork.operators import history, ledger, matrices, qvalues, scan, series, splits, tokens
from loomwork.plans import fragments as S
from loomwork.plans.registry import query
from loomwork.session import materialize
from loomwork.sources import tables as t

SEED = 7


def _accounts(spark, d):
    return t.load(spark, d, "events").select(F.col("user_id").alias("account")).distinct().select(
        "account", F.lit(t.OPENING).cast("decimal(18,2)").alias("balance"),
        F.lit(t.MINIMAL).cast("decimal(18,2)").alias("minimal"))


@query("running_counter", """
SELECT event_id, user_id, n AS calls, 'Hi user #' || n AS greeting FROM
(SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)""")
def running_counter(spark, d):
    events = t.load(spark, d, "events").select("event_id", "user_id", t.micros().alias("us"))
    return series.running_counter(events, "user_id", ["us", "event_id"]).drop("us")


@query("running_loss_blocks", """
WITH stepped AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
SELECT user_id, (n - 1) // 10 AS block, round(avg(value), 6) AS mean_loss FROM stepped
GROUP BY ALL HAVING count(*) = 10""")
def running_loss_blocks(spark, d):
    events = t.load(spark, d, "events").select("user_id", "event_id", "value", t.micros().alias("us"))
    steps = scan.running(events, ["user_id"], ["us", "event_id"], {"step": F.lit(1)})
    blocks = series.running_loss_blocks(steps, "user_id", "step", "value", 10)
    return blocks.withColumn("mean_loss", F.round("mean_loss", 6))


@query("best_so_far", f"""
WITH {S.DAILY}, seen AS (SELECT *, greatest(-1.0::DOUBLE, coalesce(max(metric) OVER (ORDER BY epoch
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1.0::DOUBLE)) AS best FROM daily)
SELECT epoch, metric, best, metric > best AS is_new_best FROM seen""")
def best_so_far(spark, d):
    return series.best_so_far(t.daily_metric(spark, d), "epoch", "metric", -1)


@query("early_stop", f"""
WITH {S.DAILY}, first AS (SELECT * FROM daily ORDER BY epoch LIMIT 10),
hit AS (SELECT min(epoch) AS stop FROM first WHERE metric >= 51)
SELECT epoch, metric FROM first, hit WHERE stop IS NULL OR epoch <= stop""")
def early_stop(spark, d):
    return series.early_stop(t.daily_metric(spark, d), "epoch", "metric", 51, 10)


@query("account_ledger", f"""
WITH RECURSIVE {S.STEPS}
SELECT account, arg_max(balance, n)::DOUBLE AS balance, count(*) FILTER (status = 'accepted') AS accepted,
  count(*) FILTER (status = 'rejected') AS rejected FROM steps GROUP BY account""")
def account_ledger(spark, d):
    return t.as_doubles(ledger.account_ledger(t.account_ops(spark, d), _accounts(spark, d)))


@query("account_ledger_steps", f"""
WITH RECURSIVE {S.STEPS} SELECT account, ts, id, op, amount::DOUBLE AS amount, balance::DOUBLE AS balance, status FROM steps WHERE n > 0""")
def account_ledger_steps(spark, d):
    return t.as_doubles(ledger.account_ledger_steps(t.account_ops(spark, d), _accounts(spark, d)))


@query("apply_positional_ops", """
WITH placed AS (SELECT c_custkey, c_acctbal::DECIMAL(18,2) AS b, row_number() OVER (ORDER BY c_custkey) - 1 AS i
  FROM customer),
paid AS (SELECT c_custkey, i, b + 10 * (i + 1) AS b FROM placed)
SELECT c_custkey, TRUE AS deposit_done, b - (15 + 10 * i) >= 20 AS withdraw_done,
  (CASE WHEN b - (15 + 10 * i) >= 20 THEN b - (15 + 10 * i) ELSE b END)::DOUBLE AS balance FROM paid""")
def apply_positional_ops(spark, d):
    indexed, _ = scan.dense_index(t.load(spark, d, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        F.lit(t.MINIMAL).cast("decimal(18,2)").alias("minimal")), ["c_custkey"])
    accounts = materialize(indexed, "accounts")  # the amounts are made from it too
    deposits = accounts.select("idx", (10 * (F.col("idx") + 1)).cast("decimal(18,2)").alias("amount"))
    withdrawals = accounts.select("idx", (15 + 10 * F.col("idx")).cast("decimal(18,2)").alias("amount"))
    paid = ledger.apply_positional_ops(accounts, deposits, "deposit")
    return t.as_doubles(ledger.apply_positional_ops(paid, withdrawals, "withdraw").drop("idx", "minimal"))


@query("conversation_history", """
SELECT a.conv_id, a.turn, count(b.turn)::INTEGER AS n,
  coalesce(string_agg(b.role || ': ' || b.text, chr(10) ORDER BY b.turn), '') AS prompt
FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn < a.turn
WHERE a.role = 'assistant' GROUP BY a.conv_id, a.turn""")
def conversation_history(spark, d):
    shown = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return history.conversation_history(t.load(spark, d, "conversations")).select(
        "conv_id", "turn", F.size("messages").alias("n"), F.array_join(shown, "\n").alias("prompt"))


@query("next_sentence_pairs", f"WITH {S.PAIRS} SELECT doc_id, pos, idx, pair FROM pairs")
def next_sentence_pairs(spark, d):
    return tokens.next_sentence_pairs(t.texts(spark, d), "doc_id", "text")


@query("split_three_way", """
WITH s AS (SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':7'), doc_id) - 1 AS i FROM documents),
n AS (SELECT floor(0.1::DOUBLE * count(*))::BIGINT AS cut FROM documents)
SELECT doc_id, CASE WHEN i < cut THEN 'test' WHEN i < 2 * cut THEN 'val' ELSE 'train' END AS split FROM s, n""")
def split_three_way(spark, d):
    return splits.split_three_way(t.load(spark, d, "documents").select("doc_id"), "doc_id", SEED)


@query("split_fraction", """
WITH s AS (SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':7'), doc_id) - 1 AS i FROM labels)
SELECT doc_id, CASE WHEN 10 * i < 2 * (SELECT count(*) FROM labels) THEN 'test' ELSE 'train' END AS split FROM s""")
def split_fraction(spark, d):
    return splits.split_fraction(t.load(spark, d, "labels").select("doc_id"), "doc_id", SEED)


@query("contiguous_shards", """
WITH s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM embeddings)
SELECT vec_id, least(i // ((SELECT count(*) FROM embeddings) // 7), 6)::INTEGER AS shard FROM s""")
def contiguous_shards(spark, d):
    return splits.contiguous_shards(t.load(spark, d, "embeddings").select("vec_id"), "vec_id", 7)


@query("chunk_partitions", """
WITH s AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
n AS (SELECT count(*) // 3 AS per FROM documents)
SELECT doc_id, (i // per)::INTEGER AS chunk FROM s, n WHERE i < 3 * per""")
def chunk_partitions(spark, d):
    return splits.chunk_partitions(t.load(spark, d, "documents").select("doc_id"), "doc_id", 3)


@query("shuffled_batches", """
WITH s AS (SELECT doc_id, e, row_number() OVER (PARTITION BY e ORDER BY md5(doc_id || ':' || e || ':7'), doc_id) - 1 AS i
  FROM labels, range(2) k(e))
SELECT doc_id, e::INTEGER AS epoch, i // 32 AS batch_id, (i % 32)::INTEGER AS place FROM s""")
def shuffled_batches(spark, d):
    rows = t.load(spark, d, "labels").select("doc_id")
    first, second = (splits.shuffled_batches(rows, "doc_id", epoch, SEED, 32).withColumn("epoch", F.lit(epoch))
                     for epoch in (0, 1))
    return first.unionByName(second)


@query("sample_with_replacement", """
WITH s AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
picks AS (SELECT g AS draw, ('0x' || substr(md5(g || ':7'), 1, 15))::BIGINT % (SELECT count(*) FROM documents) AS i
  FROM range(9) r(g))
SELECT draw, doc_id, lang FROM picks JOIN s USING (i)""")
def sample_with_replacement(spark, d):
    return splits.sample_with_replacement(
        t.load(spark, d, "documents").select("doc_id", "lang"), "doc_id", 9, SEED)


Q_SWEEPS = S.MOVES + """,
q0 AS (SELECT DISTINCT state, action, 0.0::DOUBLE AS q FROM moves)""" + "".join(f""",
b{k} AS (SELECT state, max(q) AS best FROM q{k} GROUP BY state),
t{k} AS (SELECT m.state, m.action, avg(reward + 0.9::DOUBLE * coalesce(best, 0)) AS target FROM moves m
  LEFT JOIN b{k} ON b{k}.state = m.next_state GROUP BY m.state, m.action),
q{k + 1} AS (SELECT state, action, 0.9::DOUBLE * q + 0.1::DOUBLE * target AS q FROM q{k} JOIN t{k} USING (state, action))"""
                                                        for k in range(5))


@query("q_value_iteration", f"WITH {Q_SWEEPS} SELECT state, action, round(q, 6) AS q FROM q5")
def q_value_iteration(spark, d):
    return qvalues.q_value_iteration(t.transitions(spark, d), 5).withColumn("q", F.round("q", 6))


@query("greedy_action", f"""
WITH {Q_SWEEPS}, r AS (SELECT state, action, round(q, 6) AS q FROM q5)
SELECT state, action, q FROM r QUALIFY row_number() OVER (PARTITION BY state ORDER BY q DESC, action) = 1""")
def greedy_action(spark, d):
    q = qvalues.q_value_iteration(t.transitions(spark, d), 5).withColumn("q", F.round("q", 6))
    return qvalues.greedy_action(q)


@query("magnitude_prune", f"""
WITH {S.ENTRIES}, ranked AS (SELECT vec_id, pos, value,
  row_number() OVER (ORDER BY abs(value), vec_id, pos) AS r FROM entries)
SELECT vec_id, pos, r <= (SELECT count(*) FROM entries) * 0.2 AS pruned,
  CASE WHEN r <= (SELECT count(*) FROM entries) * 0.2 THEN 0.0::DOUBLE ELSE value END AS value FROM ranked""")
def magnitude_prune(spark, d):
    return matrices.magnitude_prune(
        t.vector_entries(spark, d).select("vec_id", "pos", "value"), "vec_id")


@query("history_display", """
SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) || '. ' ||
  CASE WHEN role = 'user' THEN '用户' ELSE '助手' END || ': ' || text AS line FROM conversations""")
def history_display(spark, d):
    return history.history_display(t.load(spark, d, "conversations"))


_REQUEST = """requests AS (SELECT a.conv_id, a.turn, to_json({'model': 'chat', 'messages':
  list({'role': b.role, 'content': b.text} ORDER BY b.turn) FILTER (b.turn IS NOT NULL), 'temperature': 0.7::DOUBLE,
  'max_tokens': 500, 'stream': false})::VARCHAR AS body
FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn < a.turn
WHERE a.role = 'assistant' GROUP BY a.conv_id, a.turn)"""


@query("chat_request_json", f"WITH {_REQUEST} SELECT conv_id, turn, body FROM requests")
def chat_request_json(spark, d):
    return history.chat_requests(t.load(spark, d, "conversations"), "chat")


@query("chat_reply_parse", """
SELECT conv_id, turn, CASE (conv_id + turn) % 7 WHEN 0 THEN '错误: HTTP 500 - overloaded ' || turn
  WHEN 1 THEN '请求错误: timed out' ELSE text END AS reply, (conv_id + turn) % 7 > 1 AS kept_in_history
FROM conversations WHERE role = 'assistant'""")
def chat_reply_parse(spark, d):
    # Replies as a server would send them: some calls fail and some have a bad status.
    case = (F.col("conv_id") + F.col("turn")) % 7
    message = F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content"))
    good = F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("choices")))
    replies = (t.load(spark, d, "conversations").where(F.col("role") == "assistant")
               .withColumn("status", F.when(case == 0, 500).when(case > 1, 200))
               .withColumn("body", F.when(case == 0, F.concat(F.lit("overloaded "), "turn")).when(case > 1, good)))
    return replies.select(
        "conv_id", "turn",
        chat.chat_reply_parse(F.col("status"), F.col("body"), F.lit("timed out")).alias("reply"),
        F.coalesce(F.col("status") == 200, F.lit(False)).alias("kept_in_history"))
