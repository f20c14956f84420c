"""Counts, distributions, funnels and ordered picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, stored


def cap_per_group(df: DataFrame, group: str, order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group, for every ``k``.

    Ranges of (group, order) are dealt to tasks, so a large group spreads over several.  A row's
    rank is its rank in its range plus the group's rows in the ranges before.  Only groups
    and orders travel; the rows are taken back by them.
    """
    keys = [group, *order]
    ranged = df.select(*keys).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    sizes = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_range")) - F.col("_n")
    open_ranges = sizes.withColumn("_before", before).where(F.col("_before") < k).drop("_n")
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_range", group).orderBy(*order)))
    at = open_ranges.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), "_before")
    first = local.join(at, local[group].eqNullSafe(at["_g"]) & (F.col("_range") == F.col("_r")))
    first = first.where(F.col("_rn") + F.col("_before") <= k).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    same = [df[c].eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)]
    return df.join(first, same, "left_semi")


def distribution(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Rows per value without NULL, most frequent first."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias(out))
    return counts.orderBy(F.desc(out), col)


def nunique(df: DataFrame, col: str, out: str = "n_labels") -> DataFrame:
    return df.agg(F.countDistinct(col).alias(out))


def sorted_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def counts_zero_filled(df: DataFrame, col: str, known: Sequence[str], out: str = "n") -> DataFrame:
    """Rows of each known category, 0 where there is none."""
    names = df.sparkSession.createDataFrame([(k,) for k in known], f"{col} string")
    counts = df.groupBy(col).agg(F.count("*").alias(out))
    return names.join(counts, col, "left").select(col, F.coalesce(out, F.lit(0)).alias(out))


def funnel(df: DataFrame, source: str, outcome: Column, until_kept: int | None = None,
           order: Sequence[str] = ()) -> DataFrame:
    """Rows per source and outcome.

    With ``until_kept`` a source stops at its N-th ``kept`` row in ``order``: later rows
    are not counted.  That place is the last of the first N, joined back as one row.
    """
    tagged = df.withColumn("outcome", outcome)
    if until_kept is not None:
        rank = F.struct(*[F.col(c) for c in order])
        kept = tagged.where(F.col("outcome") == "kept").select(source, *order)
        last = (
            cap_per_group(kept, source, order, until_kept)
            .groupBy(source)
            .agg(F.max(rank).alias("_stop"), F.count("*").alias("_n"))
            .where(F.col("_n") == until_kept)
        )
        tagged = lookup_join(tagged, last.select(source, "_stop"), source, "left").where(
            F.col("_stop").isNull() | (rank <= F.col("_stop"))
        )
    return tagged.groupBy(source, "outcome").agg(F.count("*").alias("n"))


def take_first(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in order: a distributed top-n."""
    return df.orderBy(*order).limit(n)


def longest(candidates: Column | str) -> Column:
    """The longest string of an array, the first one on a tie; ``""`` if there is none."""
    c = F.col(candidates) if isinstance(candidates, str) else candidates
    return F.aggregate(
        c, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best)
    )


def failover(primary: DataFrame, fallback: DataFrame, min_rows: int) -> DataFrame:
    """The primary rows, or all of the fallback rows if the primary has too few.

    Reading at most ``min_rows`` rows answers the question, so the primary is not counted.
    """
    enough = primary.limit(min_rows).count() >= min_rows
    return primary if enough else fallback.select(*primary.columns)
