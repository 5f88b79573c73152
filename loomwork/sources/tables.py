"""The driver's tables and the frames derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import arrays, chat, html
from loomwork.operators import scan

# Opening state of every account in the ledger queries.
OPENING, MINIMAL = 100, 20
FEW_SPLITS = 4


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles: the form in which queries report money."""
    return df.withColumns({name: F.col(name).cast("double") for name, kind in df.dtypes
                           if kind.startswith("decimal")})


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table stored in fewer pieces than there are cores.

    For work that is heavy per row (regular expressions over texts and pages).  Only
    a table of ``FEW_SPLITS`` splits at most is dealt out, a few hundred megabytes;
    a larger one is read where it lies, whatever the number of cores.
    """
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(cores) if splits <= FEW_SPLITS and splits < cores else df


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) for work that is heavy per text."""
    return spread(load(spark, folder, "documents").select("doc_id", "text"))


def micros(ts: str = "ts") -> Column:
    """Microseconds since 1970 of a timestamp column, free of any time zone."""
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', "
                  f"cast({ts} AS TIMESTAMP_NTZ))")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, vec ARRAY<DOUBLE>, label)."""
    return load(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label")


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """(id, label, pred, scores): the first ten entries are the class scores."""
    scored = vectors(spark, folder).select(
        F.col("vec_id").alias("id"), "label", F.slice("vec", 1, 10).alias("scores"))
    return scored.withColumn("pred", arrays.argmax(F.col("scores")))


def vector_entries(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, label, pos, value), one row per entry."""
    return vectors(spark, folder).select("vec_id", "label", F.posexplode("vec").alias("pos", "value"))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(id, img): each vector as an 8 by 8 one-channel image."""
    return spread(vectors(spark, folder)).select(
        F.col("vec_id").alias("id"), arrays.reshape(F.col("vec"), 8, 8).alias("img"))


def chat_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns with an image tag at the head of each user text, as in chat training files."""
    tagged = F.concat(F.lit("<img>images/"), F.col("conv_id"), F.lit(".jpg</img>"), F.col("text"))
    return load(spark, folder, "conversations").select(
        "conv_id", "turn", "role",
        F.when(F.col("role") == "user", tagged).otherwise(F.col("text")).alias("text"))


def chat_records(spark: SparkSession, folder: str) -> DataFrame:
    """Nested chat records (id, image, conversations)."""
    return chat.nest_turns(chat_turns(spark, folder))


def as_account_ops(events: DataFrame) -> DataFrame:
    """Events as account operations: (account, ts, id, op, amount)."""
    kind = F.col("event_type")
    amount = F.col("value").cast("decimal(18,2)")
    return (events.where(kind.isin("signup", "purchase", "error"))
            .select(F.col("user_id").alias("account"), micros().alias("ts"),
                    F.col("event_id").alias("id"),
                    F.when(kind == "purchase", "withdraw").otherwise("deposit").alias("op"),
                    F.when(kind == "error", -amount).otherwise(amount).alias("amount")))


def account_ops(spark: SparkSession, folder: str) -> DataFrame:
    return as_account_ops(load(spark, folder, "events"))


def page_anchors(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, anchors) with every anchor of the page in document order."""
    return spread(load(spark, folder, "pages")).select(
        "page_id", "url", html.anchors(F.col("html")).alias("anchors"))


def page_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Absolute links (src, ordinal, dst): the table's own hrefs are all relative,
    so an anchor leads to the page number (page_id * 7 + ordinal) mod n."""
    pages = load(spark, folder, "pages")
    anchors = page_anchors(spark, folder).select(
        "page_id", F.col("url").alias("src"), F.inline("anchors"))
    linked = anchors.where(F.col("href").isNotNull()).select(
        "src", "ordinal",
        ((F.col("page_id") * 7 + F.col("ordinal")) % F.lit(pages.count())).alias("to_id"))
    target = pages.select(F.col("page_id").alias("to_id"), F.col("url").alias("dst"))
    return linked.join(target, "to_id").select("src", "ordinal", "dst")


def transitions(spark: SparkSession, folder: str) -> DataFrame:
    """Experience rows (state, action, reward, next_state) from each user's events."""
    # Event types in sorted order; a state is the position.
    types = ["click", "error", "purchase", "signup", "view"]
    state = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("event_type")) - 1
    rows = load(spark, folder, "events").select(
        "user_id", "event_id", micros().alias("us"), state.cast("int").alias("state"),
        (F.col("event_id") % 4).cast("int").alias("action"))
    chained = scan.following(rows, ["user_id"], ["us", "event_id"], "state", "next_state")
    return chained.where(F.col("next_state").isNotNull()).select(
        "state", "action",
        (F.col("next_state") == types.index("purchase")).cast("double").alias("reward"),
        "next_state")


def daily_metric(spark: SparkSession, folder: str) -> DataFrame:
    """(epoch, metric): day number and mean event value."""
    day = F.floor(micros() / F.lit(86_400_000_000)).cast("long")
    return (load(spark, folder, "events").groupBy(day.alias("day"))
            .agg(F.round(F.avg("value"), 10).alias("metric"))
            .select((F.col("day") - F.lit(19723)).alias("epoch"), "metric"))
