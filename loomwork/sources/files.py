"""Files in: labelled TSV, notes CSV, chat JSON lines, class-per-folder listings, literals."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHAT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("image", T.StringType()),
    T.StructField("conversations", T.ArrayType(T.StructType([
        T.StructField("from", T.StringType()),
        T.StructField("value", T.StringType())]))),
])

def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, place, line): ``start`` is where the file split of the line begins, ``place`` ascends in a task."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))


def _split_starts(lines: DataFrame) -> DataFrame:
    """(file, start, inside): whether a split begins within quotes, by the parity of all quotes before it in the file."""
    quotes = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "start",
                          (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).alias("inside"))


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a task, in order, as records (file, start, part, first, record).

    A record that stands whole within its split has a null ``part``.  What a split
    holds of a record begun earlier is part 0, of one that ends later part 1.
    ``first`` marks a record or part that begins its file.
    """
    names = ["file", "start", "part", "first", "record"]
    now, last, parity, held, begun, first = None, -1, 0, [], True, False
    rows: list[tuple] = []

    def rest():
        if held:
            rows.append((*now, 1 if begun else 0, first, "\n".join(held)))

    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts, places, inside, lines = (batch.column(i) for i in range(5))
        order = places.to_numpy()
        if inside.null_count:
            raise ValueError("the file was split differently while it was read; read it again")
        if order[0] <= last or (np.diff(order) <= 0).any():
            raise ValueError("the lines of a split came out of order")
        last = order[-1]
        turn = np.diff(starts.to_numpy()) != 0
        turn |= pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
        borders = [0, *(np.flatnonzero(turn) + 1).tolist(), batch.num_rows]
        quotes, texts = pc.count_substring(lines, '"').to_numpy(), lines.to_pylist()
        for low, high in pairwise(borders):
            split = (files[low].as_py(), starts[low].as_py())
            if split != now:
                rest()
                now, held, parity = split, [], inside[low].as_py()
                begun, first = not parity, split[1] == 0
            open_after = (parity + np.cumsum(quotes[low:high])) % 2
            at = low
            for end in (np.flatnonzero(open_after == 0) + low + 1).tolist():
                text = texts[at] if end - at == 1 and not held else "\n".join(held + texts[at:end])
                rows.append((None, None, None, first, text) if begun else (*now, 0, first, text))
                held, begun, first, at = [], True, False, end
            held += texts[at:high]
            parity = int(open_after[-1])
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PARTS)], names)
            rows = []
    rest()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PARTS)], names)


_PARTS = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(record) of delimited files whose quoted fields may hold line breaks, without each file's first record.

    Files are cut into splits as any text is.  A line break ends a record where an
    even number of quotes precedes it, so the quotes of every split are counted, and
    their running parity says how the next split begins.  Only records that cross a
    split are shuffled.  The table of splits is broadcast: a row for each, which the
    driver lists for the scan anyway.  A quote may stand only in quoted fields,
    doubled there.
    """
    lines = _lines(spark, path)
    placed = lines.join(F.broadcast(_split_starts(lines)), ["file", "start"], "left")
    parts = placed.select("file", "start", "place", "inside", "line").mapInArrow(
        _join_lines, "file string, start long, part int, first boolean, record string")
    order = Window.partitionBy("file").orderBy("start", "part")
    crossing = parts.where("part IS NOT NULL").withColumn(
        "origin", F.max(F.when(F.col("part") == 1, F.col("start"))).over(order))
    joined = crossing.groupBy("file", "origin").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "part", "record"))).alias("parts")
    ).select("first", F.array_join("parts.record", "\n").alias("record"))
    records = parts.where("part IS NULL").select("first", "record").unionByName(joined)
    return records.where(~F.col("first")).select(
        F.regexp_replace("record", r"\r\z", "").alias("record")).where("record <> ''")


def read_delimited(spark: SparkSession, path: str, schema: str | T.StructType, sep: str) -> DataFrame:
    """Delimited text with a header and quoted fields, each file read by as many tasks as it has splits."""
    kind = schema.simpleString() if isinstance(schema, T.StructType) else schema
    options = {"sep": sep, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": "",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return quoted_records(spark, path).select(F.from_csv("record", kind, options).alias("row")).select("row.*")


def read_labelled_tsv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Tab-separated text with a header; an empty field is null."""
    return read_delimited(spark, path, schema, "\t")


def read_notes_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Comma-separated notes whose text holds line breaks; an empty field is null."""
    return read_delimited(spark, path, schema, ",")


def write_delimited(df: DataFrame, path: str, sep: str) -> None:
    (df.write.options(header="true", sep=sep, quote='"', escape='"', quoteAll="true",
                      ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
     .csv(path))


def read_chat_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One nested chat record per line."""
    return spark.read.schema(CHAT).json(path)


def chat_columns(records: DataFrame) -> DataFrame:
    return records.select("id", F.col("image").alias("image_path"), "conversations")


def label_by_class(df: DataFrame, class_name: Column) -> DataFrame:
    """Add class_name and class_idx, the rank of the class among the sorted class names.

    Classes are pre-aggregated; a classifier's classes are few, and Spark picks
    the join by the size it measures.
    """
    named = df.withColumn("class_name", class_name)
    ranked = (named.select("class_name").distinct()
              .withColumn("class_idx", F.row_number().over(Window.orderBy("class_name")) - 1))
    return named.join(ranked, "class_name")


def list_labelled_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, class_name, class_idx) of files under ``root/<class>/``; no file is opened."""
    paths = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(root).select("path"))
    return label_by_class(paths, F.element_at(F.split("path", "/"), -2)).select(
        "path", "class_name", "class_idx")


def rows_from_items(spark: SparkSession, items: list, column: str, kind: str = "string") -> DataFrame:
    """A table with one row per literal item."""
    return spark.createDataFrame([(item,) for item in items], f"{column} {kind}")


def fetch_pages(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """Body of each url asked for, from a page table; null where the page is unknown."""
    return urls.join(pages.select("url", "html"), "url", "left")
