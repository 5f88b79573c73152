"""The corpus pipeline: toxicity, line dedup, near-duplicates, personal data, packing.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; all
but the last return the columns of ``docs``.  Stages run one after the other over
what the one before wrote.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import line_chunks, minhash_docs, packing, pseudonyms, toxicity
from loomwork.llm.columns import unused
from loomwork.llm.queries import PSEUDONYM_KEY, remainder, table
from loomwork.session import materialize

SHINGLE = 5


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, follows the changed text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not reject; it learns from the labels of two thirds."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder("_id", 3) != 1)
    return toxicity.acceptable(docs, machine)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated runs of lines; a document of which nothing is left goes."""
    lost = unused(docs, "_lines")
    short = line_chunks.dedup_runs(docs, count=lost)
    emptied = (F.col(lost) > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _recounted(short.where(~F.coalesce(emptied, F.lit(False))).drop(lost))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    found = minhash_docs.near_duplicates(docs, shingle=SHINGLE)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses as pseudonyms."""
    return _recounted(pseudonyms.pseudonymise(docs, PSEUDONYM_KEY))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash", drop_near_copies),
    ("pii", hide_personal_data),
    ("packing", pack),
]
ORACLE_SQL = None      # a trained model decides in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
