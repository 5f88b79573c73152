"""Array and matrix arithmetic, seeded integers, quantization."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.functions import arrays as A
from loomwork.functions.hashing import draw_int
from loomwork.plans import fragments as S
from loomwork.plans.registry import query
from loomwork.sources import tables as t

SCORES = S.PRED + """,
e AS (SELECT id, label, pred, scores, list_sum(list_transform(scores, lambda x: exp(x))) AS z FROM pred)"""

# Rows of the 8 by 8 matrix: (vec_id, i, j, value)
CELLS = S.ENTRIES + """,
cells AS (SELECT vec_id, label, pos // 8 AS i, pos % 8 AS j, value FROM entries)"""


def f6(column):
    return A.fixed6(column)


def m6(matrix):
    return A.fixed6(F.flatten(matrix))


@query("one_hot", """
SELECT vec_id, string_agg((c = label)::INTEGER::VARCHAR, ',' ORDER BY c) AS hot FROM embeddings, range(10) k(c)
GROUP BY vec_id""")
def one_hot(spark, d):
    hot = A.one_hot(F.col("label"), 10)
    return t.load(spark, d, "embeddings").select("vec_id", F.array_join(
        F.transform(hot, lambda x: x.cast("string")), ",").alias("hot"))


@query("softmax", f"""
WITH {SCORES} SELECT id, {S.fixed6('list_transform(scores, lambda y: exp(y) / z)')} AS softmax FROM e""")
def softmax(spark, d):
    return t.predictions(spark, d).select("id", f6(A.softmax(F.col("scores"))).alias("softmax"))


@query("log_softmax", f"""
WITH {SCORES} SELECT id, {S.fixed6('list_transform(scores, lambda y: y - ln(z))')} AS log_softmax FROM e""")
def log_softmax(spark, d):
    return t.predictions(spark, d).select("id", f6(A.log_softmax(F.col("scores"))).alias("log_softmax"))


@query("argmax_confidence", f"""
WITH {SCORES} SELECT id, pred, round(exp(list_max(scores)) / z, 6) AS confidence FROM e""")
def argmax_confidence(spark, d):
    return t.predictions(spark, d).select(
        "id", "pred", F.round(A.confidence(F.col("scores")), 6).alias("confidence"))


@query("elementwise_ops", f"""
WITH {S.VEC}, ab AS (SELECT a.vec_id, a.vec AS a, b.vec AS b FROM v a JOIN v b ON b.vec_id = a.vec_id + 1)
SELECT vec_id, {S.fixed6('list_transform(a, lambda y, i: y + b[i])')} AS added,
  {S.fixed6('list_transform(a, lambda y, i: y - b[i])')} AS subtracted,
  {S.fixed6('list_transform(a, lambda y, i: y * b[i])')} AS multiplied,
  {S.fixed6('list_transform(a, lambda y, i: y / (b[i] + 2))')} AS divided,
  {S.fixed6('list_transform(a, lambda y: y * 3)')} AS scaled, {S.fixed6('list_transform(a, lambda y: sin(y))')} AS sine
FROM ab""")
def elementwise_ops(spark, d):
    first = t.vectors(spark, d).select("vec_id", F.col("vec").alias("a"))
    second = t.vectors(spark, d).select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec").alias("b"))
    a, b = F.col("a"), F.col("b")
    return first.join(second, "vec_id").select(
        "vec_id", f6(A.add(a, b)).alias("added"), f6(A.subtract(a, b)).alias("subtracted"),
        f6(A.multiply(a, b)).alias("multiplied"),
        f6(A.divide(a, F.transform(b, lambda x: x + 2))).alias("divided"),
        f6(A.scale(a, F.lit(3.0))).alias("scaled"), f6(A.sine(a)).alias("sine"))


@query("broadcast_add", f"""
WITH {S.VEC} SELECT vec_id, string_agg((round((vec[c + 57] + vec[r + 1]) * 1e6)::BIGINT)::VARCHAR, ',' ORDER BY c, r) AS sums
FROM v, range(8) x(c), range(56) y(r) GROUP BY vec_id""")
def broadcast_add(spark, d):
    row, column = F.slice("vec", 1, 56), F.slice("vec", 57, 8)
    return t.vectors(spark, d).select("vec_id", m6(A.outer_add(row, column)).alias("sums"))


@query("small_matmul_transpose", f"""
WITH {CELLS}, prod AS (SELECT a.vec_id, a.i, b.j, sum(a.value * b.value) AS p FROM cells a
  JOIN cells b ON b.vec_id = a.vec_id AND b.i = a.j GROUP BY ALL),
gram AS (SELECT a.vec_id, a.i, b.i AS j, sum(a.value * b.value) AS g FROM cells a
  JOIN cells b ON b.vec_id = a.vec_id AND b.j = a.j GROUP BY ALL)
SELECT c.vec_id, {S.grid('c.value', 'c.j, c.i')} AS transposed,
  (SELECT {S.grid('p')} FROM prod WHERE prod.vec_id = c.vec_id) AS product,
  (SELECT {S.grid('g')} FROM gram WHERE gram.vec_id = c.vec_id) AS gram FROM cells c GROUP BY c.vec_id""")
def small_matmul_transpose(spark, d):
    square = F.col("m")
    return t.vectors(spark, d).withColumn("m", A.reshape(F.col("vec"), 8, 8)).select(
        "vec_id", m6(A.transpose(square)).alias("transposed"),
        m6(A.matmul(square, square)).alias("product"), m6(A.gram(square)).alias("gram"))


@query("reshape_ops", f"""
WITH {S.VEC} SELECT vec_id, {S.fixed6('vec')} AS flat, {S.fixed6('vec[49:64]')} AS last_row_of_four,
  {S.fixed6('vec[9:16]')} AS second_row_of_eight, 1::INTEGER AS leading FROM v""")
def reshape_ops(spark, d):
    vec = F.col("vec")
    return t.vectors(spark, d).select(
        "vec_id", f6(F.flatten(A.reshape(vec, 8, 8))).alias("flat"),
        f6(F.get(A.reshape(vec, 4, 16), F.lit(3))).alias("last_row_of_four"),
        f6(A.squeeze(A.unsqueeze(F.get(A.reshape(vec, 8, 8), F.lit(1))))).alias("second_row_of_eight"),
        F.size(A.unsqueeze(vec)).alias("leading"))


@query("index_slice_cat", f"""
WITH {S.VEC} SELECT vec_id, round(vec[6], 6) AS sixth, {S.fixed6('vec[11:20]')} AS middle,
  {S.fixed6('list_concat(vec[1:3], vec[62:64])')} AS ends FROM v""")
def index_slice_cat(spark, d):
    vec = F.col("vec")
    ends = F.concat(A.half_open(vec, 0, 3), A.half_open(vec, 61, 64))
    return t.vectors(spark, d).select(
        "vec_id", F.round(F.get(vec, F.lit(5)), 6).alias("sixth"),
        f6(A.half_open(vec, 10, 20)).alias("middle"), f6(ends).alias("ends"))


@query("filled_arrays", """
SELECT vec_id, array_to_string(list_transform(range(label), lambda x: 0), ',') AS zeros,
  array_to_string(list_transform(range(label), lambda x: 1), ',') AS ones,
  array_to_string(range(label, 20, 3), ',') AS steps, label::DOUBLE / 2 AS half FROM embeddings""")
def filled_arrays(spark, d):
    label = F.col("label")

    def shown(values):
        return F.array_join(F.transform(values, lambda x: x.cast("int").cast("string")), ",")
    return t.load(spark, d, "embeddings").select(
        "vec_id", shown(A.filled(0, label)).alias("zeros"), shown(A.filled(1, label)).alias("ones"),
        shown(A.arange(label, F.lit(20), 3)).alias("steps"), (label.cast("double") / 2).alias("half"))


@query("seeded_random_int", f"""
WITH drawn AS (SELECT p_partkey, p_size, {S.draw('p_size', 'p_partkey')} AS a, {S.draw('10', 'p_partkey', "'b'")} AS b,
  {S.draw('20', 'p_partkey', "'c'")} AS c FROM part)
SELECT p_partkey, a, b, c, a + b + c AS total FROM drawn""")
def seeded_random_int(spark, d):
    key = F.col("p_partkey")
    drawn = t.load(spark, d, "part").select(
        "p_partkey", draw_int(F.col("p_size"), key).alias("a"), draw_int(10, key, "b").alias("b"),
        draw_int(20, key, "c").alias("c"))
    return drawn.withColumn("total", F.col("a") + F.col("b") + F.col("c"))


@query("quantize_vector", f"""
WITH {S.VEC}, s AS (SELECT vec_id, vec, list_max(list_transform(vec, lambda x: abs(x))) / 127.0::DOUBLE AS step FROM v),
q AS (SELECT vec_id, vec, step, list_transform(vec, lambda x: round(x / step)::INTEGER) AS q FROM s)
SELECT vec_id, round(step, 9) AS step, array_to_string(q, ',') AS quantized,
  round(list_max(list_transform(vec, lambda x, i: abs(x - q[i] * step))), 6) AS worst_error FROM q""")
def quantize_vector(spark, d):
    stepped = t.vectors(spark, d).withColumn("step", A.quantization_scale(F.col("vec")))
    done = stepped.withColumn("q", A.quantize(F.col("vec"), F.col("step")))
    error = F.array_max(F.zip_with("vec", "q", lambda x, q: F.abs(x - q * F.col("step"))))
    return done.withColumn("worst_error", F.round(error, 6)).select(
        "vec_id", F.round("step", 9).alias("step"),
        F.array_join(F.transform("q", lambda x: x.cast("string")), ",").alias("quantized"), "worst_error")
