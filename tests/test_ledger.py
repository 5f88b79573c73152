"""Account rules, and hot accounts folded in many segments."""

import random
from decimal import Decimal as D

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.operators import ledger, scan

OPS = "account string, ts long, id long, op string, amount decimal(18,2)"
ACCOUNTS = "account string, balance decimal(18,2), minimal decimal(18,2)"


def plain(ops, accounts):
    """The rules, one account after the other."""
    state, steps = {a: [b, 0, 0] for a, b, m in accounts if b >= m}, {}
    least = {a: m for a, b, m in accounts}
    for account, ts, number, op, amount in sorted(ops, key=lambda o: (o[0], o[1], o[2])):
        if account not in state:
            continue
        s = state[account]
        refused = amount < 0 or (op == "withdraw" and s[0] - amount < least[account])
        if not refused:
            s[0] += amount if op == "deposit" else -amount
        s[2 if refused else 1] += 1
        steps[number] = (s[0], "rejected" if refused else "accepted")
    return {a: tuple(s) for a, s in state.items()}, steps


def run(spark, ops, accounts, per_segment):
    o, a = spark.createDataFrame(ops, OPS), spark.createDataFrame(accounts, ACCOUNTS)
    end = {r["account"]: (r["balance"], r["accepted"], r["rejected"])
           for r in ledger.account_ledger(o, a, per_segment).collect()}
    steps = {r["id"]: (r["balance"], r["status"])
             for r in ledger.account_ledger_steps(o, a, per_segment).collect()}
    return end, steps


def test_sample_walk(spark):
    ops = [("x1", 1, 1, "withdraw", D(40)), ("x1", 2, 2, "deposit", D(30))]
    end, steps = run(spark, ops, [("x1", D(100), D(20))], 100)
    assert steps == {1: (D("60.00"), "accepted"), 2: (D("90.00"), "accepted")}
    assert end == {"x1": (D("90.00"), 2, 0)}


def test_edges(spark):
    ops = [("a", 1, 1, "withdraw", D(80)),            # exactly to the minimal balance
           ("a", 2, 2, "withdraw", D("0.01")),        # one cent too much
           ("a", 3, 3, "deposit", D(0)),              # zero is allowed
           ("a", 4, 4, "deposit", D(-5)), ("a", 5, 5, "withdraw", D(-5)),
           ("low", 1, 6, "deposit", D(50)), ("nobody", 1, 7, "deposit", D(1))]
    end, steps = run(spark, ops, [("a", D(100), D(20)), ("low", D(10), D(20)), ("idle", D(20), D(20))], 100)
    assert end == {"a": (D("20.00"), 2, 3), "idle": (D("20.00"), 0, 0)}
    assert [steps[i][1] for i in range(1, 6)] == ["accepted", "rejected", "accepted", "rejected", "rejected"]


@pytest.mark.parametrize("seed,drift,per_segment", [(1, 0, 7), (2, 0, 40), (3, 30, 7), (4, -30, 16)])
def test_hot_account_in_segments(spark, seed, drift, per_segment):
    draw = random.Random(seed)
    ops = []
    for number in range(300):
        account = "hot" if number % 3 else f"a{number % 10}"
        cents = draw.randint(0, 9000)
        op = draw.choice(["deposit", "withdraw"])
        cents += drift * 100 if op == "deposit" else 0
        ops.append((account, draw.randint(0, 500), number, op, D(cents) / 100))
    accounts = [("hot", D(100), D(20))] + [(f"a{i}", D(100), D(20)) for i in range(10)]
    end, steps = plain(ops, accounts)
    assert run(spark, ops, accounts, per_segment) == (end, steps)


def test_pool_walk(spark):
    accounts, _ = scan.dense_index(spark.createDataFrame(
        [(f"account_{i}", D(100 + 50 * i), D(20)) for i in range(3)], ACCOUNTS)
        .withColumn("n", F.substring("account", 9, 1).cast("int")), ["n"])
    deposits = spark.createDataFrame([(i, D(a)) for i, a in enumerate([10, 20, 30])], "idx long, amount decimal(18,2)")
    takes = spark.createDataFrame([(i, D(a)) for i, a in enumerate([15, 25, 35])], "idx long, amount decimal(18,2)")
    paid = ledger.apply_positional_ops(accounts, deposits, "deposit")
    assert [r["balance"] for r in paid.orderBy("idx").collect()] == [110, 170, 230]
    left = ledger.apply_positional_ops(paid, takes, "withdraw")
    assert [r["balance"] for r in left.orderBy("idx").collect()] == [95, 145, 195]


def test_restore_or_init(spark):
    keys = spark.createDataFrame([("old",), ("new",), ("poor",)], "k string").withColumn(
        "opening", F.when(F.col("k") == "poor", 5).otherwise(100))
    saved = spark.createDataFrame([("old", D(60), D(20))], "k string, balance decimal(18,2), minimal decimal(18,2)")
    got = {r["k"]: (r["balance"], r["status"]) for r in
           ledger.restore_or_init(keys, saved, "k", F.col("opening"), 20).collect()}
    assert got == {"old": (60, "restored"), "new": (100, "opened"), "poor": (None, "rejected")}


def headroom(ops, h):
    for takes, cents in ops:
        if cents >= 0 and (not takes or h >= cents):
            h += -cents if takes else cents
    return h


@pytest.mark.parametrize("seed", range(6))
def test_segment_map(seed):
    """The map of a segment gives what folding from every entry gives, within its bounds."""
    draw = random.Random(seed)
    ops = [(draw.random() < 0.6, draw.randint(-5, 90)) for _ in range(400)]
    takes, cents = np.array([t for t, _ in ops]), np.array([c for _, c in ops])
    for run, (lo, hi) in ((256, (0, 500)), (3, (17, 300)), (64, (5, 5)), (1000, (0, 10 ** 12))):
        starts, values = ledger.segment_map(takes, cents, lo, hi, run)
        assert starts[0] == lo and (np.diff(starts) > 0).all()
        for h in {lo, hi, *range(lo, min(hi, 600) + 1), *(int(s) - 1 for s in starts[1:]), *map(int, starts)}:
            piece = np.searchsorted(starts, h, side="right") - 1
            assert values[piece] + h - starts[piece] == headroom(ops, h)


def job_count(spark, work):
    spark.sparkContext.setJobGroup("ledger-jobs", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("ledger-jobs"))
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("ledger-jobs")) - before


def test_jobs_do_not_follow_the_data(spark):
    """An account that always scrapes its minimum takes as many jobs as a rich one, whatever its segments."""
    draw = random.Random(8)
    poor = [("hot", i, i, draw.choice(["deposit", "withdraw", "withdraw"]), D(draw.randint(1, 3000)) / 100)
            for i in range(600)]
    rich = [("hot", i, i, "deposit", D(1)) for i in range(600)]
    accounts = [("hot", D(100), D(20))]
    counts = []
    for ops, per_segment in ((rich, 200), (poor, 200), (poor, 5)):
        o, a = spark.createDataFrame(ops, OPS).repartition(3), spark.createDataFrame(accounts, ACCOUNTS)
        counts.append(job_count(spark, lambda: ledger.account_ledger(o, a, per_segment).collect()))
        assert run(spark, ops, accounts, per_segment) == plain(ops, accounts)
    assert max(counts) - min(counts) <= 4 and max(counts) < 60


def test_known_entries_need_no_map(spark, monkeypatch):
    """With money enough both bounds meet, so no segment is mapped."""
    monkeypatch.setattr(ledger, "segment_map", None)
    ops = [("hot", i, i, "withdraw" if i % 3 else "deposit", D(1)) for i in range(300)]
    accounts = [("hot", D(9999), D(20))]
    assert run(spark, ops, accounts, 10) == plain(ops, accounts)
