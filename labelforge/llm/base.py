"""Arrow batches, dealing and connected components for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import stored, tidy

__all__ = ["arrow_map", "components", "deal", "signed", "stored", "table", "tidied", "tidy"]
Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, np.uint64).view(np.int64))


def tidied(fn: Callable) -> Callable:
    """``fn`` of a group, with freed memory given back after each."""
    def run(group: pa.Table) -> pa.Table:
        out = fn(group)
        tidy()
        return out
    return run


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with one call per batch."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield from fn(batch)
        tidy()
    return df.mapInArrow(run, schema)


def deal(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    return df.repartition(max(1, int(partitions)), *keys)


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` with the least node of each connected component, from edges ``(u, v)``.

    Each round takes the least label among neighbours and then jumps to the label's own label.
    Rounds are written to the shared folder, and end when no label changes.
    """
    both = stored(edges.select("u", "v").union(edges.select("v", "u")).where("u <> v").distinct(), "edges")
    state = stored(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                   .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = (both.join(state.select(F.col("node").alias("v"), "label"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("m")))
        lower = state.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = state.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stored(lower.join(jump, "label", "left")
                     .select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        state = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return state
