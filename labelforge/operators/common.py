"""Folders for written stages, memory of workers, and joins with tables that are expected to be small."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path on storage that every executor sees.

    It lies below ``spark.checkpoint.dir``, else below the context's checkpoint folder, else
    below the warehouse.
    """
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages"
    )
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def forget_at_exit(spark: SparkSession, path: str) -> None:
    """Have a written folder deleted when the driver ends; results may read it until then."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back.

    Lineage ends there, so a lost executor costs a re-read and not a re-run, and the
    planner knows the table's size in bytes.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    forget_at_exit(spark, path)
    table = spark.read.schema(df.schema).parquet(path)
    table._folder = path
    return table


def discard(table: DataFrame) -> None:
    """Delete the folder of a :func:`stored` table that nothing reads any more."""
    spark = table.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(table._folder)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def tidy() -> None:
    """Give freed memory back to the system, where it can be told to: workers live on between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a table that is expected to be small.

    It is written, so that its bytes are known when the join is planned: within the session's
    threshold it is broadcast and ``big`` does not move, beyond it the join shuffles and
    adaptive execution splits skewed partitions.
    """
    return big.join(stored(small, "lookup"), on, how)
