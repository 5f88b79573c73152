"""Operator 1, near-duplicate vectors in spherical k-means cells.

Centroids are fitted on a bounded sample of the distinct vectors; every distinct
vector is then assigned to its nearest centroid, its cell.  A vector also visits
each earlier cell that may hold a vector near enough to it.  Two bounds, both
exact, decide that: for vectors x in cell c and y in cell d within the chord
length r of each other, y lies no further than r beyond the plane between the two
centroids, and the angle of y to the centroid c is at most the widest angle in c
plus that of the link.  So no link is lost to the cells.  Inside a cell, cosines
are products of blocks in double precision.  Each block product gives counts and
a spanning forest of its links, never all its pairs.

Equal vectors are one class with a count.  A vector that is null, empty, zero or
holds null or non-finite components, or has another length than most, or has no
id, links with nothing it cannot be compared with: vectors of different lengths
are compared apart.  Rows that repeat an id and vector count as separate vectors
in ``n_links``.  An empty table gives an empty result; only the key and vector
columns are used, so further columns cannot clash.

On data without clusters the visits grow and the work nears all block products;
the result stays whole.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.components import components
from loomwork.session import materialize

LEAST = 0.95
SAMPLE = 16_384            # vectors that the centroids are fitted on
SAMPLE_NUMBERS = 8_000_000  # and numbers in them
CELL = 4_096               # distinct vectors aimed at per cell
MOST_CELLS = 1_024
BLOCK = 4_096              # vectors on one side of a product
ROUNDS = 10
_SLACK = 1e-9


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def spherical_kmeans(points: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids; starts from evenly spaced points and keeps a centroid that loses all its points."""
    centres = points[np.linspace(0, len(points) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        length = np.linalg.norm(sums, axis=1)
        held = length > 1e-12
        centres[held] = sums[held] / length[held, None]
    return np.unique(centres, axis=0)


def _matrix(column: pa.Array) -> np.ndarray:
    return unit(np.stack([np.asarray(v, dtype=float) for v in column.to_numpy(zero_copy_only=False)]))


def product_links(own: np.ndarray, other: np.ndarray, own_rows: pd.DataFrame, other_rows: pd.DataFrame,
                  least: float) -> pd.DataFrame:
    """Counts and a spanning forest of the links between two blocks (ids, n, home).

    A link inside the cell is met from either end and counted for the own row; one to
    a visitor is met once and counted for both.
    """
    ids = np.concatenate([own_rows["id"].to_numpy(), other_rows["id"].to_numpy()])
    names, at = np.unique(ids, return_inverse=True)
    mine, theirs = at[:len(own)], at[len(own):]
    weight, their_weight = own_rows["n"].to_numpy(), other_rows["n"].to_numpy()
    visitor = ~other_rows["home"].to_numpy(dtype=bool)
    counts = np.zeros(len(names), dtype=np.int64)
    label = np.arange(len(names))
    edges = []
    for a in range(0, len(own), 512):
        near = own[a:a + 512] @ other.T >= least
        near &= mine[a:a + 512, None] != theirs[None, :]
        np.add.at(counts, mine[a:a + 512], near @ their_weight)
        np.add.at(counts, theirs[visitor], weight[a:a + 512] @ near[:, visitor])
        for i in np.flatnonzero(near.any(axis=1)):
            hits = theirs[near[i]]
            row = mine[a + i]
            groups, first = np.unique(label[hits], return_index=True)
            new = groups != label[row]
            if new.any():
                edges += [(names[row], names[hits[f]]) for f in first[new]]
                label[np.isin(label, groups[new])] = label[row]
    linked = np.flatnonzero(counts)
    found = pd.DataFrame({"id": names[linked], "n_links": counts[linked], "other": names[linked]})
    chain = pd.DataFrame(edges, columns=["id", "other"], dtype="int64").assign(n_links=0)
    return pd.concat([found, chain])[["id", "n_links", "other"]].astype("int64")


def _classes(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(rows: id, v or null; distinct comparable vectors: id, n, v)."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = v.isNotNull() & F.col("id").isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)
    kind = dict(vectors.dtypes)[vector]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = (vectors.select(F.col(key).alias("id"), F.col(vector).cast(kind).alias("v"))
            .withColumn("v", F.when(fit, v)))
    classes = rows.where("v is not null").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    return rows, classes.select("id", "n", "v", F.size("v").alias("width"))


def _fit(classes: DataFrame, width: int, rows: int) -> np.ndarray:
    size = max(1, min(SAMPLE, SAMPLE_NUMBERS // width))
    sample = classes.where(F.col("width") == width).orderBy(F.xxhash64("id"), "id").limit(size).select("v").toPandas()
    points = unit(np.stack(sample["v"].to_numpy()).astype(float))
    cells = max(1, min(MOST_CELLS, rows // CELL, max(1, len(points) // 8)))
    return spherical_kmeans(points, cells)


def _visits(placed: DataFrame, centres: np.ndarray, widest: np.ndarray, least: float) -> DataFrame:
    """(cell, id, n, v, home): every vector in its own cell and in the earlier ones it must visit."""
    chord = math.sqrt(2 - 2 * least) + _SLACK
    angle = math.acos(least) + _SLACK
    between = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(centres))

    def work(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            own = batch.column(0).to_numpy()
            near = _matrix(batch.column(3)) @ centres.T
            at = np.arange(len(own))
            beyond = (near[at, own][:, None] - near) / between[own]
            reach = (beyond <= chord) & (np.arccos(np.clip(near, -1, 1)) <= widest[None, :] + angle)
            reach &= np.arange(len(centres))[None, :] < own[:, None]
            reach[at, own] = True
            row, cell = np.nonzero(reach)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int64()), taken.column(1), taken.column(2), taken.column(3),
                 pa.array(cell == own[row])], ["cell", "id", "n", "v", "home"])

    kind = dict(placed.dtypes)["v"]
    return placed.select("cell", "id", "n", "v").mapInArrow(
        work, f"cell bigint, id bigint, n bigint, v {kind}, home boolean")


def cell_links(classes: DataFrame, width: int, rows: int, least: float, block: int) -> DataFrame:
    """(id, n_links, other): link counts of block products (other = id) and spanning links (n_links = 0)."""
    centres = _fit(classes, width, rows)

    def assign(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            near = _matrix(batch.column(2)) @ centres.T
            own = near.argmax(axis=1)
            angle = np.arccos(np.clip(near[np.arange(len(own)), own], -1, 1))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), *batch.columns, pa.array(angle)],
                                             ["cell", "id", "n", "v", "angle"])

    kind = dict(classes.dtypes)["v"]
    placed = materialize(classes.where(F.col("width") == width).select("id", "n", "v").mapInArrow(
        assign, f"cell bigint, id bigint, n bigint, v {kind}, angle double"), "cells")
    widest = np.full(len(centres), -1.0)
    for row in placed.groupBy("cell").agg(F.max("angle").alias("a")).collect():  # a row per centroid
        widest[row["cell"]] = row["a"]
    visits = materialize(_visits(placed, centres, widest, least), "visits")
    sizes = visits.groupBy("cell").agg(F.count_if("home").alias("n_home"), F.count("*").alias("n_all"))

    def part(count, seed):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.ceil(F.col(count) / block).cast("long"))

    def upto(count):
        return F.sequence(F.lit(0).cast("long"), F.ceil(F.col(count) / block).cast("long") - 1)

    sized = visits.join(F.broadcast(sizes), "cell")     # a row per centroid
    left = sized.where("home").select(
        "cell", part("n_home", 1).alias("i"), F.explode(upto("n_all")).alias("j"), F.lit(True).alias("own"),
        "home", "id", "n", "v")
    right = sized.where("n_home > 0").select(
        "cell", F.explode(upto("n_home")).alias("i"), part("n_all", 2).alias("j"), F.lit(False).alias("own"),
        "home", "id", "n", "v")

    def multiply(rows):
        own, other = rows[rows["own"]], rows[~rows["own"]]
        if len(own) == 0 or len(other) == 0:
            return pd.DataFrame({"id": [], "n_links": [], "other": []}, dtype="int64")
        return product_links(unit(np.stack(own["v"].to_numpy()).astype(float)),
                             unit(np.stack(other["v"].to_numpy()).astype(float)), own, other, least)

    return left.union(right).groupBy("cell", "i", "j").applyInPandas(
        multiply, "id bigint, n_links bigint, other bigint")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST,
                 block: int = BLOCK) -> DataFrame:
    """(key, n_links, component_id, kept) per vector; see the module."""
    rows, classes = _classes(vectors.withColumn(key, F.col(key).cast("bigint")), key, vector)
    classes = materialize(classes, "vector-classes")
    widths = classes.groupBy("width").count().collect()   # a row per vector length
    spark = vectors.sparkSession
    links = spark.createDataFrame([], "id bigint, n_links bigint, other bigint")
    for row in widths:
        links = links.union(cell_links(classes, row["width"], row["count"], least, block))
    links = materialize(links, "vector-links")
    counts = links.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    grouped = components(links.where("id != other"), "id", "other")
    known = (classes.join(counts, "id", "left").join(grouped, "id", "left").select(
        "v", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id")))
    out = rows.join(known, "v", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
