"""Classifier evaluation over (label, pred, scores) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions import arrays
from loomwork.operators import scan
from loomwork.session import materialize


def flag_correct(pred: Column, label: Column) -> Column:
    """Whether the prediction is right; null without a label."""
    return pred == label


def _classes(df: DataFrame, classes: int, name: str) -> DataFrame:
    return df.sparkSession.range(classes).select(F.col("id").cast("int").alias(name))


def _cells(df: DataFrame, classes: int) -> DataFrame:
    """All (label, pred): classes * classes rows."""
    return df.sparkSession.range(classes * classes).select(
        F.floor(F.col("id") / classes).cast("int").alias("label"),
        (F.col("id") % classes).cast("int").alias("pred"))


def confusion_matrix(df: DataFrame, classes: int) -> DataFrame:
    """(label, pred, count) with every cell of the classes, also the empty ones; rows with
    a label or prediction outside the classes have cells of their own."""
    counted = df.groupBy("label", "pred").agg(F.count("*").alias("count"))
    return _cells(df, classes).join(counted, ["label", "pred"], "full").na.fill(0, ["count"])


def accuracy(df: DataFrame) -> DataFrame:
    """(correct, total, percent, percent_int): share of right predictions."""
    right = F.sum((F.col("pred") == F.col("label")).cast("long"))
    return df.agg(right.alias("correct"), F.count("*").alias("total")).select(
        "correct", "total",
        F.round(100 * F.col("correct") / F.col("total"), 2).alias("percent"),
        F.floor(100 * F.col("correct") / F.col("total")).cast("long").alias("percent_int"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def per_class_prf(df: DataFrame, classes: int) -> DataFrame:
    """(label, precision, recall, f1, support) of every class; 0 where undefined.

    A label outside the classes that occurs is a class too, so no row is left out.

    One pass: the (label, pred) counts hold all that is needed.
    """
    cells = df.groupBy("label", "pred").agg(F.count("*").alias("n"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hit")))))
    summed = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
    full = (_classes(df, classes, "label").join(summed, "label", "full")
            .na.fill(0, ["support", "predicted", "hit"]))
    rates = full.select("label", "support",
                        _ratio(F.col("hit"), F.col("predicted")).alias("precision"),
                        _ratio(F.col("hit"), F.col("support")).alias("recall"))
    return rates.select("label", "precision", "recall", _ratio(
        2 * F.col("precision") * F.col("recall"),
        F.col("precision") + F.col("recall")).alias("f1"), "support")


def _means(weighted: bool) -> Column:
    """Precision, recall, F1 and support over all classes, as one struct."""
    def mean(c):
        if weighted:
            return _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
        return F.avg(c)
    return F.struct(*[mean(c).alias(c) for c in ("precision", "recall", "f1")],
                    F.sum("support").alias("support"))


def weighted_prf(df: DataFrame, classes: int) -> DataFrame:
    """Precision, recall and F1 weighted by support (one row)."""
    return per_class_prf(df, classes).agg(_means(weighted=True).alias("m")).select("m.*")


def classification_report(df: DataFrame, classes: int, names: list[str]) -> DataFrame:
    """Rows per class, accuracy, macro average and weighted average, from one pass."""
    titles = F.array(*[F.lit(n) for n in names])
    fields = ("precision", "recall", "f1", "support")
    name = F.when(F.col("label") >= 0, F.get(titles, F.col("label")))
    row = F.struct(F.coalesce(name, F.concat(F.lit("label "), F.coalesce(F.col("label").cast("string"), F.lit("null"))))
                   .alias("name"), *fields)
    # One row per class, so the list is as long as the report.
    gathered = per_class_prf(df, classes).agg(
        F.collect_list(row).alias("rows"), _means(False).alias("macro"), _means(True).alias("weighted"))

    def line(name, means, **changed):
        return F.struct(F.lit(name).alias("name"), *[F.col(f"{means}.{changed.get(c, c)}").alias(c) for c in fields])
    # Accuracy is the weighted recall.
    return gathered.select(F.inline(F.concat("rows", F.array(
        line("accuracy", "weighted", precision="recall", f1="recall"),
        line("macro avg", "macro"), line("weighted avg", "weighted")))))


def _score_steps(df: DataFrame, classes: int, limit: int | None) -> DataFrame:
    """Per class and distinct score: rows of the class (pos) and others (neg), the
    running counts down to that score, and the class totals."""
    # Read several times below: written once.
    per_score = materialize(
        df.select("label", F.posexplode("scores").alias("class", "score"))
        .where(F.col("class") < classes).groupBy("class", "score")
        .agg(F.sum((F.col("label") == F.col("class")).cast("long")).alias("pos"),
             F.sum((F.col("label") != F.col("class")).cast("long")).alias("neg")), "scores")
    # Ascends as the score descends: NaN counts as the largest score, null as the least.
    down = [F.col("score").isNull(), ~F.isnan("score"), -F.col("score")]
    summed = scan.running(per_score, ["class"], down, {"cum_pos": F.col("pos"), "cum_neg": F.col("neg")}, limit)
    totals = per_score.groupBy("class").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return summed.join(F.broadcast(totals), "class")  # one row per class


def roc_curve_ovr(df: DataFrame, classes: int, limit: int | None = None) -> DataFrame:
    """(class, threshold, fpr, tpr) at each distinct score, and (0, 0) with a null threshold."""
    steps = _score_steps(df, classes, limit).select(
        F.col("class").cast("int"), F.col("score").alias("threshold"),
        F.try_divide("cum_neg", "N").alias("fpr"), F.try_divide("cum_pos", "P").alias("tpr"))
    starts = _classes(df, classes, "class").select(
        "class", F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return starts.unionByName(steps)


def auc_ovr(df: DataFrame, classes: int, limit: int | None = None) -> DataFrame:
    """(class, auc): area under each curve, ties counted half; null for a one-sided class."""
    steps = _score_steps(df, classes, limit)
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0)))
    summed = steps.groupBy("class").agg(area.alias("a"), F.first("P").alias("P"), F.first("N").alias("N"))
    return summed.select(F.col("class").cast("int"), F.try_divide(
        F.col("a"), F.col("P").cast("double") * F.col("N").cast("double")).alias("auc"))


def macro_auc(df: DataFrame, classes: int, limit: int | None = None) -> DataFrame:
    """Unweighted mean over the classes."""
    return auc_ovr(df, classes, limit).agg(F.avg("auc").alias("macro_auc"))


def row_nll(scores: Column, label: Column) -> Column:
    """-log softmax(scores)[label]."""
    return arrays.log_total(scores) - F.get(scores, label)


def nll_loss(df: DataFrame) -> DataFrame:
    """(loss_sum, loss_mean) over rows."""
    loss = row_nll(F.col("scores"), F.col("label"))
    return df.agg(F.sum(loss).alias("loss_sum"), F.avg(loss).alias("loss_mean"))


def cross_entropy_batch_mean(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Mean of batch means: a short batch weighs as much as a full one."""
    loss = row_nll(F.col("scores"), F.col("label"))
    means = df.groupBy(batch).agg(F.avg(loss).alias("m"))
    return means.agg(F.avg("m").alias("loss"), F.count("*").alias("batches"))


def mse_loss(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    gap = actual - predicted
    return df.agg(F.avg(gap * gap).alias("mse"))
