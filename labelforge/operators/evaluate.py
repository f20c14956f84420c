"""Confusion counts and classification metrics as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """``(truth, pred, n)``: the one pass over the predictions that all metrics need."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, truth: str, pred: str, labels: Sequence[str]) -> DataFrame:
    """One row per label and one count column per label, zero-filled."""
    names = df.sparkSession.createDataFrame([(x,) for x in labels], "truth string")
    wide = confusion(df, truth, pred).groupBy("truth").pivot("pred", list(labels)).agg(F.sum("n"))
    return names.join(wide, "truth", "left").na.fill(0)


def accuracy(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Share of rows whose prediction is right; a missing prediction is wrong."""
    hit = F.coalesce(F.col(truth) == F.col(pred), F.lit(False))
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"))


def report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """``(label, precision, recall, f1, support)`` for every label seen on either side.

    Works on the confusion counts: each cell adds to its true and to its predicted label.
    """
    hit = F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0)
    sides = confusion(df, truth, pred).select(
        F.inline(
            F.array(
                F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("hits")),
                F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
            )
        )
    )
    sums = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )

    def share(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return sums.select(
        "label",
        share(F.col("hits"), F.col("predicted")).alias("precision"),
        share(F.col("hits"), F.col("support")).alias("recall"),
        share(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
    )


def averages(rep: DataFrame) -> DataFrame:
    """Macro and support-weighted averages of a report, one row."""
    def weighted(c: str):
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), F.lit(0.0))

    cols = ("precision", "recall", "f1")
    return rep.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in cols],
        *[weighted(c).alias(f"weighted_{c}") for c in cols],
    )


def bottom_k(rep: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` labels with the least F1, ranked; ties in label order."""
    worst = rep.orderBy("f1", "label").limit(k)
    return worst.select(
        F.row_number().over(Window.orderBy("f1", "label")).alias("rank"), "label", "f1", "support"
    )


def category_f1(rep: DataFrame, categories: Sequence[str]) -> DataFrame:
    """F1 of the given categories, 0 where the report has none."""
    names = rep.sparkSession.createDataFrame([(c,) for c in categories], "label string")
    return names.join(rep.select("label", "f1"), "label", "left").select(
        "label", F.coalesce("f1", F.lit(0.0)).alias("f1")
    )


def with_delta(df: DataFrame, order: str, metric: str, out: str = "delta") -> DataFrame:
    """Add the difference of ``metric`` to the first row; for a table of variants."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.col(metric) - F.first(metric).over(w))
