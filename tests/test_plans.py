"""What the physical plans must and must not hold."""

import re

import pytest

import __spark_entry__ as entry
from loomwork.sources import tables

JOBS = ("train_text_classifier", "train_vector_classifier", "parameter_averaging_rounds",
        "account_stream", "counter_stream", "request_stream", "metric_stream")


def plan(spark, key, sf):
    df = entry.queries()[key](spark, sf)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("key", [k for k in entry.queries() if k not in JOBS and not k.startswith("op") and k != "pipeline"])
def test_no_pairing_of_all_rows(spark, sf, key):
    text = plan(spark, key, sf)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("key,columns", [
    ("word_count", "text:string"), ("class_counts", "quality:int"),
    ("mse_loss", "l_quantity:double,l_extendedprice:double"), ("epoch_average_loss", "ts:timestamp_ntz,value:double")])
def test_scans_read_only_what_is_used(spark, sf, key, columns):
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, key, sf))) == {columns}


def test_filters_reach_the_scan(spark, sf):
    ops = tables.account_ops(spark, sf)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert re.search(r"PushedFilters: \[.*event_type", ops._jdf.queryExecution().explainString(mode))


@pytest.mark.parametrize("key", ["split_three_way", "split_fraction", "contiguous_shards", "chunk_partitions"])
def test_splits_do_not_shuffle(spark, sf, key):
    assert "Exchange" not in plan(spark, key, sf)


@pytest.mark.parametrize("key", ["encode_pad", "copy_labels"])
def test_encoding_adds_no_aggregate(spark, sf, key):
    assert "Aggregate" not in plan(spark, key, sf)


def test_counts_are_combined_before_the_shuffle(spark, sf):
    text = plan(spark, "word_count", sf)
    assert text.count("HashAggregate") == 2 and "partial_count" in text
