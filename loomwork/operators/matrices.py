"""Large matrices in long form, model states, pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators import scan

TILE = 128  # rows and columns of a block
ENTRY = [("at", "<i4"), ("v", "<f8")]  # an entry in the bytes of a tile: its place, row by row, and its value
PACKED_ROWS = 1_000_000  # entries a task packs at a time
HELD_TILES = 256         # tiles of the result a task adds up at a time, some 40 MB
RADIX_BITS = 16


def _packed(entries: DataFrame, row: str, column: str, tile: int, names: tuple[str, str, str]) -> DataFrame:
    """One row per tile that has entries: its place, and a list of byte strings that hold its entries.

    Tasks sum and pack what they hold of a tile before the shuffle.
    """
    whole = entries.where(F.col(row).isNotNull() & F.col(column).isNotNull() & F.col("v").isNotNull()).select(
        F.col(row).cast("bigint").alias("r"), F.col(column).cast("bigint").alias("c"), F.col("v").cast("double").alias("v"))
    kind = np.dtype(ENTRY)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        r, c, v = (np.concatenate([b.column(n).to_numpy(zero_copy_only=False) for b in held]) for n in range(3))
        up, along = r // tile, c // tile
        at = (r - up * tile) * tile + (c - along * tile)
        order = np.lexsort((at, along, up))
        up, along, at, v = up[order], along[order], at[order], v[order]
        new_tile = np.append(True, (up[1:] != up[:-1]) | (along[1:] != along[:-1]))
        first = np.flatnonzero(new_tile | np.append(True, at[1:] != at[:-1]))
        out = np.empty(len(first), kind)
        out["at"], out["v"] = at[first], np.add.reduceat(v, first)
        begin = np.flatnonzero(new_tile[first])
        ends = np.append(begin, len(first)).astype(np.int32) * kind.itemsize
        data = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(out.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(up[first][begin]), pa.array(along[first][begin]), data], list(names))

    def pack(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PACKED_ROWS:
                yield packed(held)
                held, rows = [], 0
        if rows:
            yield packed(held)

    parts = whole.mapInArrow(pack, f"{names[0]} bigint, {names[1]} bigint, {names[2]} binary")
    return parts.groupBy(*names[:2]).agg(F.collect_list(names[2]).alias(names[2]))


def _product(x: np.ndarray, has_x: np.ndarray, y: np.ndarray, has_y: np.ndarray) -> np.ndarray:
    """x·y in which NaN and infinity meet only entries that are there."""
    fit_x, fit_y = np.isfinite(x), np.isfinite(y)
    out = np.where(fit_x, x, 0.0) @ np.where(fit_y, y, 0.0)
    for r, k in np.argwhere(~fit_x):
        there = has_y[k] > 0
        out[r, there] += x[r, k] * y[k, there]
    for k, c in np.argwhere(~fit_y):
        there = (has_x[:, k] > 0) & fit_x[:, k]
        out[there, c] += x[there, k] * y[k, c]
    return out


def relational_matmul(a: DataFrame, b: DataFrame, tile: int = TILE) -> DataFrame:
    """(i, j, v) of A·B from A(i, k, v) and B(k, j, v); an entry without a place or value is none.

    Tiles of A and B meet on their range of k and are multiplied as dense blocks, so
    an index k that fills a row and a column gives a product per pair of tiles and
    not one per pair of entries.  A tile travels as bytes; a task adds up the products
    of the same place of the result before they are shuffled.
    """
    pairs = _packed(a, "i", "k", tile, ("_i", "_k", "_a")).join(_packed(b, "k", "j", tile, ("_k", "_j", "_b")), "_k")
    kind = np.dtype(ENTRY)

    def dense(parts: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        entries = np.frombuffer(b"".join(parts.as_py()), kind)
        value, there = np.zeros(tile * tile), np.zeros(tile * tile, np.float32)
        np.add.at(value, entries["at"], entries["v"])
        there[entries["at"]] = 1
        return value.reshape(tile, tile), there.reshape(tile, tile)

    def rows(sums: dict) -> Iterator[pa.RecordBatch]:
        for (i, j), (value, there) in sums.items():
            row, column = np.nonzero(there)
            # Arrow out: pandas would turn NaN into null.
            yield pa.RecordBatch.from_arrays(
                [pa.array(i * tile + row), pa.array(j * tile + column), pa.array(value[row, column])], ["i", "j", "v"])

    def multiply(batches):
        sums: dict = {}
        for batch in batches:
            for i, j, left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         batch.column(2), batch.column(3)):
                (x, has_x), (y, has_y) = dense(left), dense(right)
                if (i, j) not in sums and len(sums) >= HELD_TILES:
                    yield from rows(sums)
                    sums = {}
                value, there = sums.setdefault((i, j), (np.zeros((tile, tile)), np.zeros((tile, tile), bool)))
                value += _product(x, has_x, y, has_y)
                there |= has_x @ has_y > 0
        yield from rows(sums)

    products = pairs.select("_i", "_j", "_a", "_b").mapInArrow(multiply, "i bigint, j bigint, v double")
    summed = products.groupBy("i", "j").agg(F.sum("v").alias("v"))
    return summed.select(F.col("i").cast(a.schema["i"].dataType), F.col("j").cast(b.schema["j"].dataType), "v")


def average_states(entries: DataFrame, integer_keys: Column) -> DataFrame:
    """(key, pos, value) from (worker, key, pos, value): the mean over workers.

    Keys marked by ``integer_keys`` copy the first worker's value.
    """
    merged = entries.groupBy("key", "pos").agg(
        F.avg("value").alias("_mean"), F.min_by("value", "worker").alias("_first"))
    return merged.select("key", "pos", F.when(integer_keys, F.col("_first"))
                         .otherwise(F.col("_mean")).alias("value"))


def rebuild_states(entries: DataFrame) -> DataFrame:
    """(key, values ARRAY<DOUBLE>): one array per key of a model."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "value")))
    return entries.groupBy("key").agg(F.transform(ordered, lambda e: e["value"]).alias("values"))


def magnitude_prune(entries: DataFrame, key: str, share: float = 0.2,
                    rows_per_block: int | None = None) -> DataFrame:
    """Zero the round(share*n) entries (key, pos, value) of smallest magnitude.

    Only the threshold is looked for: magnitudes below it go, those above stay,
    and equal ones go in (key, pos) order until the number is reached.
    """
    magnitude = F.abs(F.col("value"))
    rows = entries.count()
    wanted = round(share * rows)
    if wanted == 0:
        return entries.withColumn("pruned", F.lit(False))
    threshold, below = _kth_smallest(entries.select(magnitude.cast("double").alias("m")), wanted)
    # Compared as the type orders them: NaN is the largest magnitude, null the least.
    same = magnitude.eqNullSafe(F.lit(threshold))
    ties, _ = scan.dense_index(entries.where(same).select(key, "pos"), [key, "pos"], rows_per_block=rows_per_block)
    ties = ties.where(F.col("idx") < wanted - below).select(key, "pos", F.lit(True).alias("_tie"))
    goes = F.coalesce(_before(magnitude, threshold), F.lit(False)) | F.col("_tie").isNotNull()
    return (entries.join(ties, [key, "pos"], "left").withColumn("pruned", goes)
            .withColumn("value", F.when(goes, F.lit(0.0)).otherwise(F.col("value"))).drop("_tie"))


def _before(column: Column, bound: float | None) -> Column:
    """Whether a value sorts before the bound, null first."""
    if bound is None:
        return F.lit(False)
    return column.isNull() | (column < F.lit(bound))


def _digit_counts(values: DataFrame, prefix: int, shift: int) -> dict[int, int]:
    """How many magnitudes with the bits of ``prefix`` above have each value of the 16 bits from ``shift`` on.

    A null counts as digit -1 of the first pass.  A task gives a row per digit it has.
    """
    digits = 1 << RADIX_BITS

    def count(batches):
        found, nulls = np.zeros(digits, dtype=np.int64), 0
        for batch in batches:
            column = batch.column(0)
            nulls += column.null_count
            m = column.drop_null().to_numpy(zero_copy_only=False)
            bits = np.where(np.isnan(m), np.nan, np.abs(m)).view(np.int64)   # ordered as the magnitudes are, NaN last
            inside = bits[(bits >> (shift + RADIX_BITS)) == prefix] if shift < 64 - RADIX_BITS else bits
            found += np.bincount((inside >> shift) & (digits - 1), minlength=digits)
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1), pa.int64()), pa.array(np.append(found[held], nulls), pa.int64())], ["d", "n"])

    rows = values.mapInArrow(count, "d long, n long").groupBy("d").agg(F.sum("n").alias("n")).collect()
    return {r["d"]: r["n"] for r in rows}


def _kth_smallest(values: DataFrame, k: int) -> tuple[float | None, int]:
    """The k-th smallest magnitude of column m (k from 1, nulls first), and how many values are below it.

    Radix selection: histograms of the double's bits, 16 at a time from the top, say in
    four passes which digits the value has.  Nothing is sorted or shuffled but the
    histograms, so it does not matter how many magnitudes are equal.
    """
    prefix, below = 0, 0
    for shift in range(64 - RADIX_BITS, -1, -RADIX_BITS):
        counts = _digit_counts(values, prefix, shift)
        nulls = counts.pop(-1, 0)
        if shift == 64 - RADIX_BITS:
            if k <= nulls:
                return None, 0
            below = nulls
        for digit in sorted(counts):
            if below + counts[digit] >= k:
                prefix = prefix << RADIX_BITS | digit
                break
            below += counts[digit]
    return float(np.int64(prefix).view(np.float64)), below
