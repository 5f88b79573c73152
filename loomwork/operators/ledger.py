"""Accounts that refuse operations: an ordered fold per account.

A deposit or withdrawal below zero is refused, and so is a withdrawal that would
leave less than the minimal balance.  A refused operation changes nothing, so a
balance is not a running sum.

Accounts with many operations are cut into segments that follow time, and a segment
becomes a function of the headroom (balance less minimal) with which it is entered.

*Bounds.*  Accepting everything leaves the least headroom, and a withdrawal c leaves
``max(h - c, c - 1)`` at most; both have the form ``max(h - a, t)``, which two numbers
per segment describe and a running sum and maximum compose.  Where the bounds meet, as
on every stretch with money enough, the entry is known.

*Maps.*  Elsewhere the segment's function is built over the headrooms between the
bounds: sorted breakpoints with a shift each.  Operations are composed in runs, over
the values that are still reachable, which grow few as different entries end alike.
A map is then cut down to what its predecessor can give, and the maps of an account,
by then short, are applied one after the other.

Every segment is folded once more from its entry, in the JVM.  The number of jobs is
the same for all data, an account that stays at its minimum included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.operators import scan
from loomwork.session import materialize

MONEY = "decimal(18,2)"
OPS_PER_SEGMENT = 100_000
NEVER = -(1 << 61)  # below any headroom

RUN = 256  # operations composed before their map joins that of the segment
CHUNK = 64  # operations of one step list

# Summary of a folded segment; all money inside the fold is in whole cents.
SUMMARY_NAMES = ["entry", "change", "accepted", "rejected"]


def apply_op(balance, minimal, takes: bool, amount):
    """Balance after a withdrawal (``takes``) or deposit, and whether it was accepted."""
    if amount < 0:
        return balance, False
    if not takes:
        return balance + amount, True
    if balance - amount < minimal:
        return balance, False
    return balance - amount, True


def _money(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(MONEY)


def _cents(value: Column) -> Column:
    return (value.cast("decimal(20,2)") * 100).cast("long")


def _from_cents(value: Column) -> Column:
    return (value.cast("decimal(20,0)") / 100).cast(MONEY)


def _listed(ops: DataFrame, seg: Column) -> DataFrame:
    """(account, seg, ops ARRAY in time order)."""
    item = F.struct("ts", "id", (F.col("op") == "withdraw").alias("takes"), _cents(F.col("amount")).alias("cents"))
    return ops.groupBy("account", seg.alias("seg")).agg(F.array_sort(F.collect_list(item)).alias("ops"))


def _segments(ops: DataFrame, per_segment: int) -> tuple[DataFrame, DataFrame | None]:
    """Ordinary accounts in one segment each (seg 0), and long ones in segments of at
    most ``per_segment`` operations (None if there are none)."""
    blocked, split = scan.split_hot_keys(ops, ["account"], ["ts", "id"], per_segment)
    if not split:
        return _listed(ops, F.lit(0).cast("long")), None
    place = F.row_number().over(Window.partitionBy("account", "_blk").orderBy("ts", "id")) - 1
    cut = blocked.where(F.col("_blk") > 0).withColumn(
        "_seg", F.col("_blk").cast("long") * F.lit(1 << 32) + F.floor(place / per_segment))
    return (_listed(blocked.where(F.col("_blk") == 0), F.lit(0).cast("long")),
            _listed(cut, F.col("_seg")))


def _whole(n: int) -> Column:
    return F.lit(n).cast("long")


def _after(balance: Column, minimal: Column, op: Column) -> tuple[Column, Column]:
    """(balance after an operation, whether it was accepted)."""
    fits = ~op["takes"] | (balance - op["cents"] >= minimal)
    done = (op["cents"] >= 0) & fits
    moved = F.when(op["takes"], -op["cents"]).otherwise(op["cents"])
    return F.when(done, balance + moved).otherwise(balance), done


def _fold(ops: Column, entry: Column, minimal: Column) -> Column:
    """Summary of a segment folded from ``entry``: change, accepted, rejected."""
    start = F.struct(entry.alias("balance"), _whole(0).alias("accepted"), _whole(0).alias("rejected"))

    def step(acc, op):
        balance, done = _after(acc["balance"], minimal, op)
        return F.struct(balance.alias("balance"), (acc["accepted"] + done.cast("long")).alias("accepted"),
                        (acc["rejected"] + (~done).cast("long")).alias("rejected"))
    return F.aggregate(ops, start, step, lambda acc: F.struct(
        (acc["balance"] - entry).alias("change"), acc["accepted"].alias("accepted"), acc["rejected"].alias("rejected")))


def _summaries(segments: DataFrame) -> DataFrame:
    """Fold rows (account, seg, entry, minimal, ops)."""
    folded = segments.withColumn("_f", _fold(F.col("ops"), F.col("entry"), F.col("minimal")))
    return folded.select("account", "seg", "entry", "_f.*")


def _bounds(ops: Column) -> Column:
    """(all, least, most) of a segment: headroom h becomes at least max(h - all, least), at most max(h - all, most)."""
    start = F.struct(_whole(0).alias("all"), _whole(0).alias("least"), _whole(NEVER).alias("most"))

    def step(acc, op):
        cents, takes = op["cents"], op["takes"]
        moved = F.when(takes, -cents).otherwise(cents)
        least, most = acc["least"] + moved, acc["most"] + moved
        return F.when(cents < 0, acc).otherwise(F.struct(
            (acc["all"] - moved).alias("all"),
            F.when(takes, F.greatest(least, _whole(0))).otherwise(least).alias("least"),
            F.when(takes, F.greatest(most, cents - 1)).otherwise(most).alias("most")))
    return F.aggregate(ops, start, step)


def _entered(bounded: DataFrame) -> DataFrame:
    """Add ``lo`` and ``hi``, the bounds of the headroom at the start of each segment of (account, seg, first, b)."""
    before = Window.partitionBy("account").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("account").orderBy("seg").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spent = F.coalesce(F.sum("b.all").over(before), _whole(0))
    summed = bounded.withColumn("_spent", spent).withColumn("_all", F.sum("b.all").over(upto))
    for name, least in (("lo", "b.least"), ("hi", "b.most")):
        reached = F.max(F.col(least) + F.col("_all")).over(before) - F.col("_spent")
        summed = summed.withColumn(name, F.greatest(F.col("first") - F.col("_spent"), reached, _whole(0)))
    return summed.drop("_spent", "_all")


def _split(starts: np.ndarray, values: np.ndarray, sizes: np.ndarray, least: int, cents: int):
    """Pieces after a withdrawal: those from ``least`` on pay ``cents``, one that lies across is cut there."""
    across = np.flatnonzero((values < least) & (values + sizes > least))
    if len(across):
        low = least - values[across]
        starts = np.concatenate([starts, starts[across] + low])
        values = np.concatenate([values, np.full(len(across), least)])
        sizes = np.concatenate([sizes, sizes[across] - low])
        sizes[across] = low
    values[values >= least] -= cents
    return starts, values, sizes


def _reachable(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of the disjoint stretches that hold all values of the pieces."""
    order = np.argsort(values, kind="stable")
    start, stop = values[order], np.maximum.accumulate((values + sizes)[order])
    first = np.concatenate([[True], start[1:] > stop[:-1]])
    begin = np.flatnonzero(first)
    return start[begin], stop[np.append(begin[1:], len(start)) - 1] - start[begin]


def _composed(starts, values, sizes, at, to, wide):
    """The pieces followed by the map with pieces (at, to, wide), sorted and without gaps where a value lies."""
    left = np.searchsorted(at, values, side="right") - 1
    right = np.searchsorted(at, values + sizes - 1, side="right") - 1
    count = right - left + 1
    piece = np.repeat(np.arange(len(starts)), count)
    other = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count) + left[piece]
    begin = np.maximum(values[piece], at[other])
    end = np.minimum(values[piece] + sizes[piece], at[other] + wide[other])
    new_starts = starts[piece] + begin - values[piece]
    new_values = to[other] + begin - at[other]
    # neighbours of one shift are one piece
    first = np.ones(len(piece), dtype=bool)
    first[1:] = (new_values[1:] - new_starts[1:]) != (new_values[:-1] - new_starts[:-1])
    begin_at = np.flatnonzero(first)
    sizes = np.add.reduceat(end - begin, begin_at)
    return new_starts[begin_at], new_values[begin_at], sizes


def segment_map(takes: np.ndarray, cents: np.ndarray, lo: int, hi: int, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(starts, values): a headroom h from ``lo`` to ``hi`` becomes values[i] + h - starts[i] for the last starts[i] <= h.

    Pieces grow by about one per withdrawal and never beyond one per cent between the
    bounds; a run of operations is composed over the values still reachable only.
    """
    starts, values = np.array([lo], dtype=np.int64), np.array([lo], dtype=np.int64)
    sizes = np.array([hi - lo + 1], dtype=np.int64)
    valid = cents >= 0
    takes, cents = takes[valid].tolist(), cents[valid].tolist()
    for begin in range(0, len(cents), run):
        at, wide = _reachable(values, sizes)
        to, gained = at.copy(), 0        # deposits move all values alike
        for take, amount in zip(takes[begin:begin + run], cents[begin:begin + run]):
            if take:
                at, to, wide = _split(at, to, wide, amount - gained, amount)
            else:
                gained += amount
        order = np.argsort(at)
        starts, values, sizes = _composed(starts, values, sizes, at[order], to[order] + gained, wide[order])
    return starts, values


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(account, seg, starts, values) of each segment between its bounds."""
    for batch in batches:
        found = [segment_map(takes.values.to_numpy(zero_copy_only=False), cents.values.to_numpy(), lo.as_py(), hi.as_py())
                 for takes, cents, lo, hi in zip(*(batch.column(i) for i in range(2, 6)))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.list_(pa.int64())),
             pa.array([f[1] for f in found], pa.list_(pa.int64()))], ["account", "seg", "starts", "values"])


def _restricted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maps cut down to the headrooms that the segment before them can leave."""
    for batch in batches:
        out = []
        for starts, values, hi, b_starts, b_values, b_hi in zip(*(c.to_pylist() for c in batch.columns[2:])):
            starts, values = np.array(starts), np.array(values)
            if b_starts is not None:
                b_starts, b_values = np.array(b_starts), np.array(b_values)
                ends = np.append(b_starts[1:], b_hi + 1)
                at, wide = _reachable(b_values, ends - b_starts)
                sizes = np.append(starts[1:], hi + 1) - starts
                starts, values, _ = _composed(at, at.copy(), wide, starts, values, sizes)
            out.append((starts, values))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([o[0] for o in out], pa.list_(pa.int64())),
             pa.array([o[1] for o in out], pa.list_(pa.int64()))], ["account", "seg", "starts", "values"])


def _chained(pdf: pd.DataFrame) -> pd.DataFrame:
    """The entry headroom of every segment of one account, from the first on."""
    pdf = pdf.sort_values("seg", ignore_index=True)
    entries, at = [], None
    for lo, hi, starts, values in zip(pdf["lo"], pdf["hi"], pdf["starts"], pdf["values"]):
        at = int(lo) if lo == hi else at
        entries.append(at)
        if starts is not None:
            piece = int(np.searchsorted(starts, at, side="right")) - 1
            at = int(values[piece]) + at - int(starts[piece])
    return pd.DataFrame({"account": pdf["account"], "seg": pdf["seg"], "known": entries})


def _entries(segments: DataFrame) -> DataFrame:
    """(account, seg, entry, minimal, ops) of the segments of long accounts, with their true entry balances."""
    kind = dict(segments.dtypes)["account"]
    bounded = segments.select("account", "seg", (F.col("balance") - F.col("minimal")).alias("first"),
                              _bounds(F.col("ops")).alias("b"))
    along = Window.partitionBy("account").orderBy("seg")
    is_open = F.col("lo") < F.col("hi")
    # a map is needed where the entry is open, and one step before, where it is known
    entered = materialize(_entered(materialize(bounded, "bounds")).withColumn(
        "mapped", is_open | F.coalesce(F.lead(is_open).over(along), F.lit(False)))
        .withColumn("_before", F.lag("seg").over(along)).drop("first", "b"), "entered")
    wanted = segments.join(entered.where("mapped").select("account", "seg", "lo", "hi"), ["account", "seg"])
    maps = materialize(wanted.select("account", "seg", "ops.takes", "ops.cents", "lo", "hi").mapInArrow(
        _maps, f"account {kind}, seg long, starts array<long>, values array<long>"), "maps")
    placed = entered.where("mapped").join(maps, ["account", "seg"])
    earlier = placed.select("account", F.col("seg").alias("_before"), F.col("starts").alias("_s"),
                            F.col("values").alias("_v"), F.col("hi").alias("_h"))
    cut = (placed.select("account", "seg", "starts", "values", "hi", "_before")
           .join(earlier, ["account", "_before"], "left")
           .select("account", "seg", "starts", "values", "hi", "_s", "_v", "_h")
           .mapInArrow(_restricted, f"account {kind}, seg long, starts array<long>, values array<long>"))
    # One row per mapped segment, by now a few pieces each; known entries need no chain.
    chained = (entered.where("mapped").select("account", "seg", "lo", "hi").join(cut, ["account", "seg"])
               .groupBy("account").applyInPandas(_chained, f"account {kind}, seg long, known long"))
    found = entered.select("account", "seg", "lo").join(materialize(chained, "entries"), ["account", "seg"], "left")
    room = F.coalesce("known", "lo")
    return segments.join(found, ["account", "seg"]).select(
        "account", "seg", (F.col("minimal") + room).alias("entry"), "minimal", "ops")


def _settled_segments(ops: DataFrame, accounts: DataFrame, per_segment: int) -> DataFrame:
    """(account, seg, entry, minimal, ops) with the entry balance of every segment."""
    opened = accounts.where(F.col("balance") >= F.col("minimal")).select(
        "account", _cents(F.col("balance")).alias("balance"), _cents(F.col("minimal")).alias("minimal"))
    ordinary, long = _segments(ops, per_segment)
    segments = ordinary.join(opened, "account").select(
        "account", "seg", F.col("balance").alias("entry"), "minimal", "ops")
    if long is None:
        return segments
    return segments.unionByName(_entries(materialize(long.join(opened, "account"), "segments")))


def account_ledger(ops: DataFrame, accounts: DataFrame,
                   per_segment: int = OPS_PER_SEGMENT) -> DataFrame:
    """(account, balance, accepted, rejected) after all operations.

    ``ops`` is (account, ts, id, op, amount), op deposit or withdraw;
    ``accounts`` is (account, balance, minimal).  Accounts opened below their
    minimal balance are refused and not in the result.
    """
    opened = accounts.where(F.col("balance") >= F.col("minimal"))
    totals = _summaries(_settled_segments(ops, accounts, per_segment)).groupBy("account").agg(
        F.sum("change").alias("change"), F.sum("accepted").alias("accepted"),
        F.sum("rejected").alias("rejected"))
    return opened.join(totals, "account", "left").select(
        "account",
        _money(F.col("balance") + _from_cents(F.coalesce("change", F.lit(0)))).alias("balance"),
        F.coalesce("accepted", F.lit(0)).alias("accepted"),
        F.coalesce("rejected", F.lit(0)).alias("rejected"))


def _chunks(ops: Column, entry: Column, minimal: Column) -> Column:
    """The operations in lists of ``CHUNK``, each with the balance at its start."""
    count = F.ceil(F.size(ops) / F.lit(CHUNK)).cast("int")
    lists = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(ops, i * CHUNK + 1, F.lit(CHUNK)))

    def walked(acc, chunk):
        end = F.aggregate(chunk, acc["at"], lambda at, op: _after(at, minimal, op)[0])
        return F.struct(end.alias("at"), F.array_append(acc["starts"], acc["at"]).alias("starts"))
    start = F.struct(entry.alias("at"), F.array().cast("array<long>").alias("starts"))
    starts = F.aggregate(lists, start, walked, lambda acc: acc["starts"])
    return F.arrays_zip(lists.alias("ops"), starts.alias("at"))


def _step_list(chunk: Column, minimal: Column) -> Column:
    """(op, after, done) of each operation of one chunk, in order."""
    step = "array<struct<after:bigint,done:boolean>>"
    start = F.struct(chunk["at"].alias("at"), F.array().cast(step).alias("steps"))

    def walked(acc, op):
        balance, done = _after(acc["at"], minimal, op)
        return F.struct(balance.alias("at"), F.array_append(
            acc["steps"], F.struct(balance.alias("after"), done.alias("done"))).alias("steps"))
    steps = F.aggregate(chunk["ops"], start, walked, lambda acc: acc["steps"])
    return F.arrays_zip(chunk["ops"].alias("op"), steps.alias("step"))


def account_ledger_steps(ops: DataFrame, accounts: DataFrame,
                         per_segment: int = OPS_PER_SEGMENT) -> DataFrame:
    """One row per operation with the balance after it and its status."""
    entered = _settled_segments(ops, accounts, per_segment)
    chunked = entered.select("account", "minimal", F.explode(
        _chunks(F.col("ops"), F.col("entry"), F.col("minimal"))).alias("chunk"))
    walked = chunked.select("account", F.explode(_step_list(F.col("chunk"), F.col("minimal"))).alias("s")).select(
        "account", "s.op.*", "s.step.*")
    return walked.select(
        "account", "ts", "id", F.when(F.col("takes"), "withdraw").otherwise("deposit").alias("op"),
        _from_cents(F.col("cents")).alias("amount"), _from_cents(F.col("after")).alias("balance"),
        F.when(F.col("done"), "accepted").otherwise("rejected").alias("status"))


def restore_or_init(keys: DataFrame, saved: DataFrame, key: str, balance, minimal) -> DataFrame:
    """(key, balance, minimal, status): the saved state if there is one, else the
    arguments, refused where the balance is below the minimal one."""
    kept = saved.select(key, F.col("balance").alias("_b"), F.col("minimal").alias("_m"))
    found = F.col("_b").isNotNull()
    first = F.when(_money(balance) < _money(minimal), "rejected").otherwise("opened")
    status = F.when(found, "restored").otherwise(first)
    return keys.join(kept, key, "left").select(
        key, F.when(found, F.col("_b")).when(status != "rejected", _money(balance))
        .cast("decimal(18,2)").alias("balance"),
        F.when(found, F.col("_m")).when(status != "rejected", _money(minimal))
        .cast("decimal(18,2)").alias("minimal"), status.alias("status"))


def apply_positional_ops(accounts: DataFrame, amounts: DataFrame, op: str) -> DataFrame:
    """The i-th amount applied to the i-th account: (idx, balance, minimal) with (idx, amount)."""
    amount = F.col("amount")
    after = F.col("balance") + (amount if op == "deposit" else -amount)
    allowed = (amount >= 0) if op == "deposit" else (amount >= 0) & (after >= F.col("minimal"))
    done = F.coalesce(allowed, F.lit(False))
    return (accounts.join(amounts.select("idx", "amount"), "idx", "left")
            .withColumn(f"{op}_done", done)
            .withColumn("balance", F.when(F.col(f"{op}_done"), after).otherwise(F.col("balance"))
                        .cast("decimal(18,2)")).drop("amount"))
