"""SQL pieces shared by several checks (DuckDB dialect)."""

# (id, label, scores, pred)
PRED = """p AS (SELECT vec_id AS id, label, list_transform(embedding[1:10], lambda x: x::DOUBLE) AS scores
  FROM embeddings),
pred AS (SELECT id, label, scores, (list_position(scores, list_max(scores)) - 1)::INTEGER AS pred FROM p)"""

# (vec_id, label, vec)
VEC = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS vec FROM embeddings)"""

# (vec_id, label, pos, value), pos from 0
ENTRIES = """entries AS (SELECT vec_id, label, (k - 1)::INTEGER AS pos, embedding[k]::DOUBLE AS value
  FROM embeddings, range(1, 65) r(k))"""

# (conv_id, turn, role, text)
TURNS = """turns AS (SELECT conv_id, turn, role,
  CASE WHEN role = 'user' THEN '<img>images/' || conv_id || '.jpg</img>' || text ELSE text END AS text
  FROM conversations)"""

# (account, ts, id, op, amount)
OPS = """ops AS (SELECT user_id AS account, epoch_us(ts) AS ts, event_id AS id,
  CASE WHEN event_type = 'purchase' THEN 'withdraw' ELSE 'deposit' END AS op,
  (CASE WHEN event_type = 'error' THEN -value ELSE value END)::DECIMAL(18,2) AS amount
  FROM events WHERE event_type IN ('signup', 'purchase', 'error'))"""

# One row per operation with the balance after it; accounts open at 100 with minimal 20.
STEPS = OPS + """,
numbered AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY ts, id) AS n FROM ops),
steps AS (
  SELECT DISTINCT user_id AS account, 0::BIGINT AS n, NULL::BIGINT AS ts, NULL::BIGINT AS id, NULL::VARCHAR AS op,
    NULL::DECIMAL(18,2) AS amount, 100::DECIMAL(18,2) AS balance, NULL::VARCHAR AS status FROM events
  UNION ALL
  SELECT o.account, o.n, o.ts, o.id, o.op, o.amount,
    (CASE WHEN o.amount < 0 THEN s.balance
          WHEN o.op = 'deposit' THEN s.balance + o.amount
          WHEN s.balance - o.amount < 20 THEN s.balance
          ELSE s.balance - o.amount END)::DECIMAL(18,2),
    CASE WHEN o.amount < 0 OR (o.op = 'withdraw' AND s.balance - o.amount < 20)
         THEN 'rejected' ELSE 'accepted' END
  FROM steps s JOIN numbered o ON o.account = s.account AND o.n = s.n + 1)"""

# (page_id, url, ordinal, href): every anchor of every page
ANCHORS = r"""visible AS (SELECT page_id, url,
  regexp_replace(html, '<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'gsi') AS h FROM pages),
tags AS (SELECT page_id, url, regexp_extract_all(h, '<a(?:\s(?:[^>"'']|"[^"]*"|''[^'']*'')*)?>', 0, 'i') AS found
  FROM visible),
listed AS (SELECT page_id, url, k::INTEGER AS ordinal, found[k] AS tag
  FROM (SELECT page_id, url, found, unnest(range(1, len(found) + 1)) AS k FROM tags)),
anchors AS (SELECT page_id, url, ordinal,
  CASE WHEN regexp_matches(tag, '\shref\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+)', 'i') THEN
    replace(regexp_extract(tag, '\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1, 'i') ||
            regexp_extract(tag, '\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2, 'i') ||
            regexp_extract(tag, '\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3, 'i'), '&amp;', '&') END AS href
  FROM listed)"""

# (src, ordinal, href, dst): absolute addresses of the links and of a folder above each, as RFC 3986 resolves them
RESOLVED = ANCHORS + r""",
links AS (SELECT url AS src, ordinal, href FROM anchors WHERE href IS NOT NULL
  UNION ALL SELECT url, -ordinal, '..' || href || '/./?n=' || ordinal FROM anchors WHERE href IS NOT NULL),
cut AS (SELECT src, ordinal, href,
  regexp_extract(href, '^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$', ['s', 'a', 'p', 'q', 'f'], 's') AS r,
  regexp_extract(src, '^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$', ['s', 'a', 'p', 'q', 'f'], 's') AS b
  FROM links),
joined AS (SELECT *, CASE WHEN r.s <> '' OR r.a <> '' OR r.p[1] = '/' THEN r.p WHEN r.p = '' THEN b.p
  ELSE regexp_extract(CASE WHEN b.p = '' THEN '/' ELSE b.p END, '^(.*/)?', 0, 's') || r.p END AS path FROM cut),
walked AS (SELECT *, string_split(path[2:], '/') AS seg, list_reduce(
  list_transform(string_split(path[2:], '/'), lambda x: [x]),
  lambda acc, x: CASE WHEN x[1] = '.' THEN acc WHEN x[1] = '..' THEN acc[:-2] ELSE acc || x END, []::VARCHAR[]) AS kept
  FROM joined),
resolved AS (SELECT src, ordinal, href, CASE WHEN r.s <> '' THEN r.s ELSE b.s END ||
  CASE WHEN r.s <> '' OR r.a <> '' THEN r.a ELSE b.a END ||
  CASE WHEN r.p <> '' AND path LIKE '/%' AND contains(path, '/.') THEN
    '/' || array_to_string(CASE WHEN seg[-1] IN ('.', '..') THEN kept || [''] ELSE kept END, '/') ELSE path END ||
  CASE WHEN r.s || r.a || r.p || r.q = '' THEN b.q ELSE r.q END || r.f AS dst FROM walked)"""

# (src, ordinal, dst)
EDGES = ANCHORS + """,
edges AS (SELECT a.url AS src, a.ordinal, t.url AS dst FROM anchors a
  JOIN pages t ON t.page_id = (a.page_id * 7 + a.ordinal) % (SELECT count(*) FROM pages)
  WHERE a.href IS NOT NULL)"""

# Edges under the crawler's cap of 4
CAPPED = EDGES + """,
followed AS (SELECT e.src, e.dst FROM edges e
  LEFT JOIN (SELECT src, min(ordinal) AS last FROM edges WHERE ordinal > 4 GROUP BY src) b ON b.src = e.src
  WHERE e.ordinal <= 4 OR e.ordinal = b.last)"""

# (word, count)
WORDS = r"""words AS (SELECT doc_id, w AS word, i AS pos FROM (
  SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (
    SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS ws FROM documents))),
counted AS (SELECT word, count(*) AS count FROM words GROUP BY word)"""

# (word, token_id)
VOCAB = WORDS + """,
vocab AS (SELECT word, (row_number() OVER (ORDER BY count DESC, word) + 3)::INTEGER AS token_id
  FROM counted)"""

# (doc_id, pos, sentence)
SENTENCES = r"""cleaned AS (SELECT doc_id, trim(regexp_replace(text, '[^a-zA-Z0-9.,?!\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|\n', '', 'g'), ' ') AS t
  FROM documents),
cut AS (SELECT doc_id, list_filter(string_split(regexp_replace(t, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)),
  lambda x: x <> '') AS s FROM cleaned),
sentences AS (SELECT doc_id, unnest(range(len(s)))::INTEGER AS pos, unnest(s) AS sentence FROM cut)"""

# (doc_id, pos, idx, pair)
PAIRS = SENTENCES + """,
placed AS (SELECT *, row_number() OVER (ORDER BY doc_id, pos) - 1 AS idx FROM sentences),
pairs AS (SELECT a.doc_id, a.pos, a.idx, a.sentence || ' [SEP] ' || b.sentence AS pair FROM placed a
  JOIN placed b ON b.idx = (a.idx + 1) % (SELECT count(*) FROM placed))"""

# Encoded pairs: (idx, ids)
ENCODED_PAIRS = VOCAB + """,
""" + PAIRS + r""",
pair_words AS (SELECT idx, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM (
  SELECT idx, list_filter(string_split_regex(lower(pair), '\s+'), lambda x: x <> '')[1:512] AS ws FROM pairs)),
pair_ids AS (SELECT p.idx, p.pos, CASE WHEN p.word = '[sep]' THEN 2 ELSE coalesce(v.token_id, 1) END AS t
  FROM pair_words p LEFT JOIN vocab v USING (word)),
encoded AS (SELECT idx, list(t ORDER BY pos) AS ids FROM pair_ids GROUP BY idx)"""

# (state, action, reward, next_state)
MOVES = """named AS (SELECT user_id, event_id, ts, (event_id % 4)::INTEGER AS action,
  (list_position(['click','error','purchase','signup','view'], event_type) - 1)::INTEGER AS state FROM events),
moves AS (SELECT state, action, next_state, CASE WHEN next_state = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reward
  FROM (SELECT state, action, lead(state) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_state FROM named)
  WHERE next_state IS NOT NULL)"""

# (epoch, metric)
DAILY = """daily AS (SELECT (epoch_us(ts) // 86400000000 - 19723) AS epoch, round(avg(value), 10) AS metric
  FROM events GROUP BY 1)"""

# Pixels of the 8 by 8 images: (id, i, j, v)
PIXELS = """px AS (SELECT vec_id AS id, ((k - 1) // 8)::INTEGER AS i, ((k - 1) % 8)::INTEGER AS j,
  embedding[k]::DOUBLE AS v FROM embeddings, range(1, 65) r(k))"""


def coin(*parts: str) -> str:
    """SQL of the uniform draw for these parts (SQL expressions)."""
    joined = " || ':' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"(('0x' || substr(md5({joined}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def draw(limit: str, *parts: str) -> str:
    """SQL of the integer draw 0..limit."""
    joined = " || ':' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"(('0x' || substr(md5({joined}), 1, 15))::BIGINT % (({limit}) + 1))"


def fixed6(values: str) -> str:
    """SQL of a list of doubles as millionths joined by commas."""
    return f"array_to_string(list_transform({values}, lambda x: round(x * 1e6)::BIGINT), ',')"


def grid(value: str, order: str = "i, j") -> str:
    """SQL aggregate of the pixels of one image as millionths."""
    return f"string_agg((round(({value}) * 1e6)::BIGINT)::VARCHAR, ',' ORDER BY {order})"
