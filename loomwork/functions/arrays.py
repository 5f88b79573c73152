"""Vectors ARRAY<DOUBLE> and small matrices ARRAY<ARRAY<DOUBLE>> as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, not once per reference."""
    return F.transform(F.array(value), use).getItem(0)


def zero() -> Column:
    return F.lit(0.0).cast("double")


def total(vec: Column) -> Column:
    return F.aggregate(vec, zero(), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def argmax(vec: Column) -> Column:
    """0-based position of the largest entry, the first one on ties."""
    return (F.array_position(vec, F.array_max(vec)) - 1).cast("int")


def softmax(vec: Column) -> Column:
    return let(F.array_max(vec), lambda top: let(
        F.transform(vec, lambda x: F.exp(x - top)), lambda e: let(
            total(e), lambda s: F.transform(e, lambda x: x / s))))


def log_total(vec: Column) -> Column:
    """log(sum(exp(x))) with the maximum taken out."""
    return let(F.array_max(vec), lambda top: top + F.log(
        total(F.transform(vec, lambda x: F.exp(x - top)))))


def log_softmax(vec: Column) -> Column:
    return let(log_total(vec), lambda t: F.transform(vec, lambda x: x - t))


def confidence(vec: Column) -> Column:
    """Largest softmax probability."""
    return let(F.array_max(vec), lambda top: F.lit(1.0) / total(
        F.transform(vec, lambda x: F.exp(x - top))))


def one_hot(label: Column, classes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)),
                       lambda i: F.when(i == label, 1).otherwise(0))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def divide(a: Column, b: Column) -> Column:
    """Elementwise quotient; null where the divisor is zero."""
    return F.zip_with(a, b, lambda x, y: F.try_divide(x, y))


def scale(vec: Column, factor) -> Column:
    return F.transform(vec, lambda x: x * factor)


def sine(vec: Column) -> Column:
    return F.transform(vec, F.sin)


def outer_add(row: Column, column: Column) -> Column:
    """(n,) + (m, 1): entry (i, j) is column[i] + row[j]."""
    return F.transform(column, lambda c: F.transform(row, lambda r: r + c))


def reshape(vec: Column, rows: int, columns: int) -> Column:
    """Row-major view of a vector as a matrix."""
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)),
                       lambda i: F.slice(vec, i * columns + 1, columns))


def squeeze(nested: Column) -> Column:
    """Drop a leading dimension of length one."""
    return nested.getItem(0)


def unsqueeze(vec: Column) -> Column:
    """Add a leading dimension of length one."""
    return F.array(vec)


def transpose(matrix: Column) -> Column:
    width = F.size(matrix.getItem(0))
    return F.transform(F.sequence(F.lit(0), width - 1),
                       lambda j: F.transform(matrix, lambda row: F.get(row, j)))


def matmul(a: Column, b: Column) -> Column:
    """Product of two matrices held in one row."""
    return let(transpose(b), lambda columns: F.transform(
        a, lambda row: F.transform(columns, lambda col: dot(row, col))))


def gram(matrix: Column) -> Column:
    """matrix times its transpose."""
    return F.transform(matrix, lambda r: F.transform(matrix, lambda s: dot(r, s)))


def half_open(vec: Column, start: int, stop: int) -> Column:
    """Entries start..stop-1, counted from 0."""
    return F.slice(vec, start + 1, stop - start)


def arange(start: Column, stop: Column, step: int) -> Column:
    """start, start+step, ... below stop (stop excluded); empty when start >= stop."""
    values = F.sequence(start, F.greatest(start, stop - 1), F.lit(step))
    return F.when(start >= stop, F.array().cast("array<int>")).otherwise(values)


def filled(value: float, length: Column) -> Column:
    return F.array_repeat(F.lit(float(value)), length)


def quantization_scale(vec: Column) -> Column:
    """Step of an 8-bit grid over the vector: largest magnitude / 127."""
    return F.array_max(F.transform(vec, F.abs)) / F.lit(127.0)


def quantize(vec: Column, step: Column) -> Column:
    """Grid positions -127..127; all zero when the step is zero."""
    return F.transform(vec, lambda x: F.coalesce(
        F.round(F.try_divide(x, step)).cast("int"), F.lit(0)))


def fixed6(vec: Column) -> Column:
    """Entries as millionths, joined by commas: a form any engine prints alike."""
    return F.array_join(F.transform(
        vec, lambda x: F.round(x * F.lit(1e6)).cast("long").cast("string")), ",", "null")
