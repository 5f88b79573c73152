"""Counting, totals and bag operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions import text as tx


def count_tokens(df: DataFrame, tokens: Column, name: str = "word") -> DataFrame:
    """(word, count) of an array column; counted before the shuffle."""
    return df.select(F.explode(tokens).alias(name)).groupBy(name).agg(F.count("*").alias("count"))


def word_count(df: DataFrame, column: str) -> DataFrame:
    """Tokens between single spaces."""
    return count_tokens(df, tx.words(F.col(column)))


def word_count_lower(df: DataFrame, column: str) -> DataFrame:
    """Lower-case tokens between white space.  Sort with ``top``."""
    return count_tokens(df, tx.lower_words(F.col(column)))


def top(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    """The k largest values, ties by key: kept per partition, then merged."""
    return df.orderBy(F.desc(value), F.asc(key)).limit(k)


def block_sizes(df: DataFrame, mapper: Column, tokens: Column, buckets: int) -> DataFrame:
    """Size of each (mapper, bucket) block when words go to buckets by first letter."""
    words = df.select(mapper.alias("mapper"), F.explode(tokens).alias("word"))
    return (words.groupBy("mapper", tx.first_letter_bucket(F.col("word"), buckets).alias("bucket"))
            .agg(F.count("*").alias("size")))


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per class; the total has a null class."""
    return df.where(F.col(column).isNotNull()).rollup(column).agg(F.count("*").alias("count"))


def union_batches(*frames: DataFrame) -> DataFrame:
    """All rows of all batches, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def merge_reducers(parts: DataFrame, key: str, value: str, part: str) -> DataFrame:
    """One value per key; on a shared key the later part wins."""
    return parts.groupBy(key).agg(F.max_by(value, part).alias(value))


def distinct_keys(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, frames).distinct()
