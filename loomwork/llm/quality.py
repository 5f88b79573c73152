"""Operator 10, quality rules by weak supervision.

Each rule looks at one text and votes good (+1), bad (-1) or abstains (0).  No
rule decides alone: expectation-maximisation estimates from the votes of all
documents how often each rule votes in either class, and a document's posterior
probability of being good follows from its votes.  The votes of the corpus enter
the estimate as counts of vote patterns, which one aggregation gathers; their
number is bounded by 3 ** rules, whatever the corpus.

Nulls and empty texts have no words: every count is 0, ``base_failed`` is true.
Repeated rows are scored alike and each counts as a document.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import vectorwords as vw
from loomwork.session import materialize

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
FEW_WORDS = 50
REPEATED_SHARE = 50      # per cent of the words
WINDOW = 3

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_GOES_ON = np.zeros(256, dtype=bool)      # UTF-8 bytes that do not begin a code point
_GOES_ON[0x80:0xC0] = True


class Rule(NamedTuple):
    """Good when ``value <= good``, bad when ``value >= bad``, no vote between; the scale may run down."""
    name: str
    value: str
    good: float
    bad: float


# Each value is a share or mean that does not depend on the length of the text.
RULES = (
    Rule("symbols", "n_symbols / nullif(word_chars, 0)", 0.02, 0.10),
    Rule("symbols_per_word", "n_symbols / nullif(n_words, 0)", 0.2, 0.8),
    Rule("repeats", "n_repeat_words / nullif(n_words, 0)", 0.10, 0.35),
    Rule("line_copies", "n_dup_lines / nullif(n_lines, 0)", 0.10, 0.30),
    Rule("word_length", "abs(word_chars / nullif(n_words, 0) - 6.0)", 3.0, 5.0),
    Rule("length", "-n_words", -100.0, -FEW_WORDS),
)


def _text_counts(column: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = vw.column_bytes(column)
    words = vw.find_words(data, offsets)
    first, rows = words.first, len(offsets) - 1
    n_words = np.diff(first)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    symbols = per_text(_IS_SYMBOL[data])
    chars = per_text(~vw.IS_SPACE[data] & ~_GOES_ON[data])
    hashes = vw.hash_spans(data, words.start, words.end)

    # Lines that hold a word; a line's hash covers all its bytes.
    newline = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], newline + 1]))
    starts = starts[starts < len(data)]
    # a line that a text's last \n opens is empty and ends where the next text begins
    stops = np.minimum(np.append(starts[1:], len(data)), len(data))
    ended = (stops > starts) & (data[stops - 1] == 0x0A) if len(starts) else np.zeros(0, bool)
    stops = stops - ended
    held = np.searchsorted(words.start, stops) > np.searchsorted(words.start, starts)
    starts, stops = starts[held], stops[held]
    line_hash = vw.hash_spans(data, starts, stops)
    line_first = np.searchsorted(starts, offsets)
    n_lines = np.diff(line_first)

    factors = vw.mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)
    wide = max(0, len(hashes) - WINDOW + 1)
    windows = np.zeros(wide, dtype=np.uint64)
    for k in range(WINDOW):
        windows += hashes[k:k + wide] * factors[k]

    dup_lines = np.zeros(rows, dtype=np.int64)
    repeats = np.zeros(rows, dtype=np.int64)
    for d in range(rows):
        a, b = line_first[d], line_first[d + 1]
        if b - a > 1:
            dup_lines[d] = (b - a) - len(np.unique(line_hash[a:b]))
        a, b = first[d], first[d + 1]
        if b - a > WINDOW:
            _, place, counts = np.unique(windows[a:b - WINDOW + 1], return_inverse=True, return_counts=True)
            again = counts[place] > 1
            covered = np.zeros(b - a, dtype=bool)
            for k in range(WINDOW):
                covered[k:k + len(again)] |= again
            repeats[d] = covered.sum()
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
            "n_repeat_words": repeats, "n_lines": n_lines}


def text_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of whole texts."""
    def work(batches):
        for batch in vw.slices(batches, "text"):
            counts = _text_counts(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, pa.int64()) for v in counts.values()]], [key, *counts])

    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, " + ", ".join(f"{c} bigint" for c in [*COUNTS, "n_lines"])
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(work, schema)


def votes(counted: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``votes``, one of -1, 0, 1 for each rule; a rule whose value is undefined abstains."""
    def vote(rule: Rule):
        value = F.expr(rule.value)
        return F.when(value <= rule.good, 1).when(value >= rule.bad, -1).otherwise(0)
    return counted.withColumn("votes", F.concat_ws(",", *[vote(r).cast("string") for r in rules]))


class LabelModel(NamedTuple):
    """Share of good documents, and per rule the probabilities of the votes -1, 0, 1 in a bad and a good one."""
    prior: float
    bad: np.ndarray
    good: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        if len(patterns) == 0:
            return np.zeros(0)
        at = np.arange(patterns.shape[1])
        logs = [np.log(table[at, patterns + 1]).sum(axis=1) for table in (self.bad, self.good)]
        odds = logs[1] - logs[0] + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200,
                    smooth: float = 1.0) -> LabelModel:
    """Expectation-maximisation over vote patterns with their document counts.

    Starts from the votes themselves, a bad one weighing as eight good ones: rules are
    written to fire on what is wrong, and most text passes most of them.  Add-``smooth``
    counts, which lean towards rules that vote for the class, keep every probability
    above 0.
    """
    rules = patterns.shape[1] if patterns.size else 0
    total = max(float(counts.sum()), 1.0)
    start = 1 + 0.25 * (patterns > 0).sum(axis=1) - 2.0 * (patterns < 0).sum(axis=1) if rules else np.zeros(0)
    belief = 1 / (1 + np.exp(-start))
    model = LabelModel(0.5, np.full((rules, 3), 1 / 3), np.full((rules, 3), 1 / 3))
    for _ in range(rounds):
        tables = []
        # a good document rather gets good votes, a bad one bad votes: a weak Dirichlet prior
        for weight, lean in ((counts * (1 - belief), (2.0, 1.0, 0.5)), (counts * belief, (0.5, 1.0, 2.0))):
            table = np.array([[weight[patterns[:, r] == v].sum() + smooth * lean[v + 1] for v in (-1, 0, 1)]
                              for r in range(rules)]).reshape(rules, 3)
            tables.append(table / table.sum(axis=1, keepdims=True) if rules else table)
        prior = (float((counts * belief).sum()) + smooth) / (total + 2 * smooth)
        model = LabelModel(prior, *tables)
        new = model.posterior(patterns)
        done = len(new) == 0 or np.abs(new - belief).max() < 1e-9
        belief = new
        if done:
            break
    return model


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES,
            least: float = 0.5) -> DataFrame:
    """Counts, ``base_failed``, ``quality`` (posterior probability of good) and ``kept`` of every document.

    ``kept`` is false where the base rule fails, else whether the posterior is at
    least ``least``.  The counts are written once, so the texts are read once.
    An empty table gives an empty result.
    """
    voted = votes(materialize(text_counts(docs, key, text), "quality"), rules)
    found = voted.groupBy("votes").count().orderBy("votes").collect()   # at most 3 ** rules rows
    patterns = np.array([[int(v) for v in row["votes"].split(",")] for row in found],
                        dtype=np.int64).reshape(len(found), len(rules))
    counts = np.array([row["count"] for row in found], dtype=float)
    model = fit_label_model(patterns, counts)
    beliefs = [(row["votes"], float(p)) for row, p in zip(found, model.posterior(patterns))]
    spark = docs.sparkSession
    table = spark.createDataFrame(beliefs, "votes string, quality double")
    failed = (F.col("n_words") < FEW_WORDS) | \
        (100 * F.col("n_repeat_words") > REPEATED_SHARE * F.col("n_words"))
    return (voted.join(F.broadcast(table), "votes", "left")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce("quality", F.lit(0.0)) >= least))
            .select(key, *COUNTS, "base_failed", "kept", "quality"))
