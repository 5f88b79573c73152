"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import check_oracle
from conftest import SF
from loomwork.functions import chat
from loomwork.operators import scan, tokens

# Queries with their own checks in tests/llm.
OTHERS = [k for k in entry.queries() if k == "pipeline" or k.startswith("op")]
# Queries whose work is cut into blocks or pieces.
CUT = ["running_counter", "running_loss_blocks", "best_so_far", "account_ledger", "apply_positional_ops",
       "conversation_history", "render_chatml", "next_sentence_pairs", "contiguous_shards", "chunk_partitions",
       "split_three_way", "shuffled_batches", "sample_with_replacement", "magnitude_prune", "history_display",
       "roc_curve_ovr", "auc_ovr", "q_value_iteration", "cross_entropy_batch_mean"]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in check_oracle.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return con


@pytest.mark.parametrize("key", [k for k in entry.queries() if k not in OTHERS])
def test_query(spark, con, key):
    verdict = check_oracle.compare(spark, con, SF, key)
    assert verdict.startswith("ok" if key in entry.oracle_sql() else "rows only"), verdict


@pytest.mark.parametrize("key", CUT)
def test_query_in_small_blocks(spark, con, key, monkeypatch):
    """Small limits give many blocks and hot keys: the results stay the same."""
    monkeypatch.setattr(scan, "ROWS_PER_BLOCK", 40)
    monkeypatch.setattr(scan, "HOT_ROWS", 25)
    monkeypatch.setattr(tokens, "TEXTS_PER_BLOCK", 30)
    monkeypatch.setattr(chat, "PIECE_TURNS", 2)
    verdict = check_oracle.compare(spark, con, SF, key)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["word", "count"]
    assert result.count() == 100
