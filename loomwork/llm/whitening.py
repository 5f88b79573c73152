"""Operator 12, whitening of embeddings.

Entries become fixed-point integers, so every sum that Spark gathers is exact and no
order of the partial sums shows.  One pass gives the number of vectors and the sums per
dimension; the second centres each vector at the rounded means before multiplying and
gives the sums of products, from which the driver has the exact covariance (dimensions
squared, whatever the rows).  Its leading eigenpairs come from ``eigen``; the mean, the
components and their scales go to every task, which projects its rows.  A third pass
measures the covariance of what is returned.

Null vectors and vectors with a null or non-finite entry, or one whose fixed-point
number is no long, are left out, as are those of another length than most have (on a tie
the shorter length counts) and those without entries.  Rows that share an id, a null id
included, are vectors of their own.  Components whose eigenvalue is zero to rounding
have no whitened value and give no rows: n vectors in D dimensions have at most
min(n - 1, D, ``components``).  Equal eigenvalues leave the choice within their common
space free; the one taken is the same for all rows.  ``deviation`` is null where it is
no long.  An empty table, or one without any spread, gives an empty result.  Only the key
and the vector column are read, so further columns cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import eigen

UNIT, ORIGIN = 64, 1_000_000     # x = floor(UNIT * entry) + ORIGIN
COMPONENTS = 32
LIMBS, LIMB_BITS = 5, 32         # an exact integer travels as longs of 32 bits each, the last with its sign
ROWS = 4096                      # vectors of one matrix product
_SAFE = float(1 << 52)
_LONG = float(1 << 63)


class Model(NamedTuple):
    """Vector length, count, sums per dimension, eigenvalues, components as rows, share of the variance."""
    size: int
    n: int
    sums: list
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray


def _vectors(column: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, x as a matrix of longs) of the usable vectors of one length."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    bad = pc.is_null(flat).to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
    scaled = np.floor(values * UNIT)
    bad = bad | ~(np.abs(scaled) < _LONG - 2 * ORIGIN)      # NaN and infinities compare false
    ends = np.cumsum(lengths)
    wrong = np.concatenate([[0], np.cumsum(bad)])
    clean = (wrong[ends] == wrong[ends - lengths]) & (lengths > 0)
    if size is None:
        return lengths[clean], np.zeros((0, 0), dtype=np.int64)
    rows = np.flatnonzero(clean & (lengths == size))
    places = (ends - lengths)[rows][:, None] + np.arange(size)
    return rows, scaled[places].astype(np.int64) + ORIGIN


def _blocks(batches, size: int):
    """(keys, x) of the usable vectors, at most ``ROWS`` at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            rows, x = _vectors(part.column(1), size)
            if len(rows):
                yield part.column(0).take(pa.array(rows)), x


def _limbs(values: np.ndarray) -> np.ndarray:
    """Whole numbers, longs or Python's, as limbs along a new last axis."""
    out = np.zeros((*values.shape, LIMBS), dtype=np.int64)
    for k in range(LIMBS - 1):
        out[..., k] = values & 0xFFFFFFFF
        values = values >> LIMB_BITS
    out[..., LIMBS - 1] = values
    return out


def _whole(limbs) -> int:
    return sum(int(v) << (LIMB_BITS * k) for k, v in enumerate(limbs))


def _products(d: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns: in doubles while they hold every digit, else in Python's integers."""
    largest = float(np.abs(d).astype(float).max(initial=0.0))
    if largest * largest * len(d) < _SAFE:
        f = d.astype(float)
        return (f.T @ f).astype(np.int64)
    whole = d.astype(object)
    return whole.T @ whole


def _rows_of(keys: list, limbs: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(k, pa.int32()) for k in keys]
    columns += [pa.array(limbs[:, k], pa.int64()) for k in range(LIMBS)]
    names = [f"k{i}" for i in range(len(keys))] + [f"l{k}" for k in range(LIMBS)]
    return pa.RecordBatch.from_arrays(columns, names)


_LIMB_FIELDS = ", ".join(f"l{k} long" for k in range(LIMBS))


def _gathered(partial: DataFrame, keys: list[str]) -> list:
    """The partial sums of all tasks added up: one row per key, as many as there are dimensions or pairs of them."""
    return partial.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (f"l{k}" for k in range(LIMBS))]).collect()


def _only(embeddings: DataFrame, key: str, vector: str) -> DataFrame:
    return embeddings.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"))


def _lengths(rows: DataFrame) -> int:
    """The commonest length of the usable vectors."""
    def count(batches):
        for batch in batches:
            lengths, _ = _vectors(batch.column(1))
            found, counts = np.unique(lengths, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts, pa.int64())], ["s", "c"])

    found = (rows.mapInArrow(count, "s long, c long").groupBy("s").agg(F.sum("c").alias("c"))
             .orderBy(F.desc("c"), "s").first())
    return found["s"] if found else 0


def _sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    """(number of vectors, exact sum per dimension)."""
    def add(batches):
        total, n = np.zeros((size + 1, LIMBS), dtype=np.int64), 0
        for _, x in _blocks(batches, size):
            total[:size] += _limbs(x).sum(axis=0)
            n += len(x)
        total[size, 0] = n
        if n:
            yield _rows_of([np.arange(size + 1)], total)

    found = {r["k0"]: _whole(r[1:]) for r in _gathered(rows.mapInArrow(add, f"k0 int, {_LIMB_FIELDS}"), ["k0"])}
    return found.get(size, 0), [found.get(i, 0) for i in range(size)]


def _covariance(rows: DataFrame, size: int, n: int, sums: list[int]) -> np.ndarray:
    """The covariance, each entry the double next to the exact quotient."""
    centre = [(2 * s + n) // (2 * n) for s in sums]        # the rounded means
    at = np.array(centre, dtype=np.int64)
    first, second = np.triu_indices(size)

    def multiply(batches):
        total, some = np.zeros((len(first), LIMBS), dtype=np.int64), False
        for _, x in _blocks(batches, size):
            total += _limbs(_products(x - at)[first, second])
            some = True
        if some:
            yield _rows_of([first, second], total)

    found = _gathered(rows.mapInArrow(multiply, f"k0 int, k1 int, {_LIMB_FIELDS}"), ["k0", "k1"])
    rest = [s - n * c for s, c in zip(sums, centre)]       # what rounding the means left
    out = np.zeros((size, size))
    for r in found:
        i, j = r["k0"], r["k1"]
        out[i, j] = out[j, i] = (n * _whole(r[2:]) - rest[i] * rest[j]) / (n * n)
    return out


def fit(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding",
        components: int = COMPONENTS) -> Model:
    """Mean and leading components of all usable vectors."""
    rows = _only(embeddings, key, vector)
    size = _lengths(rows)
    n, sums = _sums(rows, size) if size else (0, [])
    if not n:
        return Model(0, 0, [], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    spread = _covariance(rows, size, n, sums)
    values, vectors = eigen.leading(spread, min(components, size))
    # A second look at the matrix itself: the quotient of a unit vector errs by the square of the vector's error.
    values = np.einsum("ki,ij,kj->k", vectors, spread, vectors)
    trace = float(np.trace(spread))
    some = values > max(float(values.max(initial=0.0)), 0.0) * size * 4 * eigen.EPS
    some &= np.arange(len(values)) < n - 1
    return Model(size, n, sums, values[some], vectors[some], values[some] / trace if trace else values[some])


def _projector(model: Model):
    """x -> whitened values; the rest of the mean behind the rounded one is taken off after the exact difference."""
    centre = np.array([(2 * s + model.n) // (2 * model.n) for s in model.sums], dtype=np.int64)
    rest = np.array([(s - model.n * int(c)) / model.n for s, c in zip(model.sums, centre)])
    scaled = (model.components / np.sqrt(model.values)[:, None]).T

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - centre).astype(float) - rest) @ scaled

    return project, centre


def identity_error(embeddings: DataFrame, model: Model, key: str = "vec_id", vector: str = "embedding") -> float:
    """Largest entry, without sign, of the whitened vectors' covariance minus the identity."""
    count, size = len(model.values), model.size
    if not count:
        return 0.0
    project, _ = _projector(model)

    def add(batches):
        products, sums = np.zeros((count, count)), np.zeros(count)
        for _, x in _blocks(batches, size):
            w = project(x)
            products += w.T @ w
            sums += w.sum(axis=0)
        i, j = np.indices((count, count + 1)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.column_stack([products, sums]).ravel())],
            ["i", "j", "s"])

    found = np.zeros((count, count + 1))
    rows = _only(embeddings, key, vector).mapInArrow(add, "i int, j int, s double")
    for r in rows.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        found[r["i"], r["j"]] = r["s"] / model.n
    mean = found[:, count]
    return float(np.abs(found[:, :count] - np.outer(mean, mean) - np.eye(count)).max())


def _deviations(x: np.ndarray, n: int, centre: np.ndarray, rest: list[int]) -> list:
    """Sum over the dimensions of (n * x - S) ** 2, exact; None where it is no long."""
    d = x - centre
    left = np.array([float(r) for r in rest])
    guess = ((float(n) * d.astype(float) - left) ** 2).sum(axis=1)
    if guess.max(initial=0.0) < _LONG / 4 and float(n) * float(np.abs(d).max(initial=0)) < _LONG / 4:
        far = n * d - np.array(rest, dtype=np.int64)
        return (far * far).sum(axis=1).tolist()
    out = []
    for row, near in zip(d.astype(object), guess):
        exact = None if near > 1.01 * _LONG else sum((n * v - r) ** 2 for v, r in zip(row, rest))
        out.append(None if exact is None or exact >= 1 << 63 else exact)
    return out


def whiten(embeddings: DataFrame, model: Model, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, deviation, whitened array), one row per usable vector of the model's length."""
    kind = dict(embeddings.dtypes)[key]
    if not len(model.values):
        return embeddings.sparkSession.createDataFrame([], f"`{key}` {kind}, deviation long, whitened array<double>")
    project, centre = _projector(model)
    size, n, count = model.size, model.n, len(model.values)
    rest = [s - n * int(c) for s, c in zip(model.sums, centre)]

    def rows(batches):
        for keys, x in _blocks(batches, size):
            values = project(x)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1) * count, pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(_deviations(x, n, centre, rest), pa.int64()), lists], [key, "deviation", "whitened"])

    return _only(embeddings, key, vector).mapInArrow(rows, f"`{key}` {kind}, deviation long, whitened array<double>")


def whitened_components(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, with the share of the variance and the measured identity error."""
    model = fit(embeddings, key, vector, components)
    error = identity_error(embeddings, model, key, vector)
    shares = F.array(*[F.lit(float(v)) for v in model.explained]) if len(model.values) \
        else F.array().cast("array<double>")
    wide = whiten(embeddings, model, key, vector)
    long = wide.select(key, "deviation", F.posexplode("whitened").alias("at", "value"))
    return long.select(
        key, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"), F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"))
