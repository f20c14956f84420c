"""Stratified split with exact quotas, and class weights."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join

# Hex digits of the digest that form a bucket: 65,536 buckets per class.
BUCKET_DIGITS = 4


def class_quotas(df: DataFrame, label: str, test_frac: float) -> DataFrame:
    """``(label, n_c, n_test)``: test rows per class, ``ceil(test_frac * n)`` in total.

    The training rows are shared out in proportion, the remainder by largest fraction
    and then by label.  The arithmetic is in whole numbers; the table has a row per class.
    """
    per_class = df.groupBy(label).agg(F.count("*").cast("decimal(18,0)").alias("n_c"))
    everything = Window.partitionBy(F.lit(0))
    n = F.sum("n_c").over(everything).cast("decimal(18,0)")
    n_train = (F.col("n") - F.ceil(F.col("n").cast("double") * test_frac)).cast("decimal(18,0)")
    by_remainder = everything.orderBy(F.desc("rest"), label)
    return (
        per_class.withColumn("n", n)
        .withColumn("n_train", n_train)
        .withColumn("whole", F.expr("(n_c * n_train) div n"))
        .withColumn("rest", F.expr("(n_c * n_train) % n"))
        .withColumn("left_over", F.col("n_train") - F.sum("whole").over(everything))
        .withColumn("extra", (F.row_number().over(by_remainder) <= F.col("left_over")).cast("int"))
        .select(
            label,
            F.col("n_c").cast("bigint").alias("n_c"),
            (F.col("n_c") - F.col("whole") - F.col("extra")).cast("bigint").alias("n_test"),
        )
    )


def stratified_split(
    df: DataFrame, label: str, id_col: str, test_frac: float = 0.2, seed: int = 42, out: str = "part"
) -> DataFrame:
    """Add ``out``: ``test`` for the rows of each class with the least digests, else ``train``.

    The digest of id and seed orders a class; the quota's last row is its cut.  Ranking a
    whole class in one task would not scale, so a histogram of digest prefixes finds the
    bucket that holds the cut, and only that bucket's rows are ranked.  The rows
    themselves are compared with one cut per class and never shuffled.
    """
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))
    # A missing label is a class of its own, told apart by a flag so that joins find it.
    columns, named = df.columns, F.coalesce(F.col(label).cast("string"), F.lit(""))
    df = df.withColumn("_class", F.concat(F.col(label).isNull().cast("string"), named))
    label = "_class"
    keyed = df.select(label, F.struct(digest.alias("d"), F.col(id_col)).alias("k"))
    keyed = keyed.withColumn("bucket", F.substring("k.d", 1, BUCKET_DIGITS))

    histogram = keyed.groupBy(label, "bucket").agg(F.count("*").alias("n"))
    running = Window.partitionBy(label).orderBy("bucket")
    quotas = class_quotas(df, label, test_frac)
    boundary = (
        histogram.withColumn("upto", F.sum("n").over(running))
        .join(quotas, label)
        .where((F.col("upto") >= F.col("n_test")) & (F.col("upto") - F.col("n") < F.col("n_test")))
        .select(label, "bucket", (F.col("n_test") - F.col("upto") + F.col("n")).alias("need"))
    )
    in_boundary = lookup_join(keyed, boundary, [label, "bucket"])
    ranked = in_boundary.withColumn(
        "rn", F.row_number().over(Window.partitionBy(label, "bucket").orderBy("k"))
    )
    cuts = ranked.where(F.col("rn") == F.col("need")).select(label, F.col("k").alias("_cut"))

    mine = F.struct(digest.alias("d"), F.col(id_col))
    is_test = F.coalesce(mine <= F.col("_cut"), F.lit(False))
    return lookup_join(df, cuts, label, "left").withColumn(
        out, F.when(is_test, "test").otherwise("train")
    ).select(*columns, out)


def class_weights(df: DataFrame, label: str, overrides: Mapping[str, float] | None = None) -> DataFrame:
    """``(label, n_c, class_weight)``: ``n / (k * n_c)``, times a factor for some labels."""
    everything = Window.partitionBy(F.lit(0))
    factor: Column = F.lit(1.0)
    for name, value in (overrides or {}).items():
        factor = F.when(F.col(label) == name, F.lit(float(value))).otherwise(factor)
    per_class = df.groupBy(label).agg(F.count("*").alias("n_c"))
    balanced = F.sum("n_c").over(everything) / (F.count("*").over(everything) * F.col("n_c"))
    return per_class.select(label, "n_c", (balanced * factor).alias("class_weight"))


def with_class_weight(df: DataFrame, label: str, weights: DataFrame, out: str = "class_weight") -> DataFrame:
    """Rows with the weight of their class; a missing label is a class like any other."""
    weights = weights.select(F.col(label).alias("_class"), F.col("class_weight").alias(out))
    return lookup_join(df, weights, df[label].eqNullSafe(F.col("_class"))).drop("_class")
