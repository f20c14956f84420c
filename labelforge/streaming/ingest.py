"""Append-only ingest of landed files with durable progress.

A query's checkpoint holds the files it has read; the output tables hold what it has
written.  Each run takes what has landed since and stops.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.common import stored
from ..operators.dedup import keep_first
from .seen import BUCKETS, Seen


def landed(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", glob: str | None = None,
    max_files: int | None = None, base: str | None = None,
) -> DataFrame:
    """A stream over the files of a folder; columns named by subfolders need ``base``, a folder around them, if ``folder`` is a pattern."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if base:
        reader = reader.option("basePath", base)
    return reader.load(folder)


def _run(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Transform new rows and append them to a Parquet table."""
    _run(transform(stream).writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def append_distinct(stream: DataFrame, keys: Sequence[str], out: str, checkpoint: str) -> None:
    """Append rows whose key was not seen in any run; the keys live in a state store on disk.

    Which of a batch's equal keys stays is not fixed; see :func:`append_first`.
    """
    with _on_disk(stream.sparkSession):
        _run(stream.dropDuplicates(list(keys)).writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def append_distinct_within(stream: DataFrame, keys: Sequence[str], time: str, bound: str, out: str, checkpoint: str) -> None:
    """Append rows whose key was not accepted within ``bound`` before, by the column ``time``.

    A key's state expires once the watermark, ``bound`` behind the latest ``time`` of the batches so far, has passed
    ``bound`` after its accepted row, so the state holds the keys of a limited span and not of all history.  Keys that
    recur within ``bound`` are always dropped; later ones are accepted again as soon as their state is gone.  Rows
    older than the watermark are dropped as late.  Which of a batch's equal keys stays is not fixed.
    """
    with _on_disk(stream.sparkSession):
        fresh = stream.withWatermark(time, bound).dropDuplicatesWithinWatermark(list(keys))
        _run(fresh.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def append_changes(changes: DataFrame, out: str, checkpoint: str) -> None:
    """Append what a stateful stream puts out, a folder per batch, which repeating the batch replaces."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with _on_disk(changes.sparkSession):
        _run(changes.writeStream.outputMode("update").foreachBatch(write), checkpoint)


@contextmanager
def _on_disk(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own choice is put back."""
    option, rocks = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(option, None)
    spark.conf.set(option, rocks)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(option)
        else:
            spark.conf.set(option, before)


def append_first(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, checkpoint: str, buckets: int = BUCKETS,
) -> None:
    """Append the first new row of each key, where every one of ``keys`` must be new.

    Key by key, a batch drops the rows whose key an earlier batch has seen and keeps its own
    first row.  A key is seen once a row has come as far as it, whether or not a later key
    then rejects that row, so any split into batches gives the rows of a single batch.
    Seen keys are kept as bucketed tables of digests beside the checkpoint, see :mod:`.seen`.  A batch
    writes folders of its own, so repeating it after a failure replaces its rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        for i, key in enumerate(keys):
            seen = Seen(batch.sparkSession, f"{checkpoint}-seen/key={i}", buckets)
            seen.merged(batch_id)
            # What a key lets through is read twice.
            batch = stored(keep_first(seen.unseen(batch, key, batch_id), key, order), "unseen")
            seen.add(batch, key, batch_id)
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(stream.writeStream.foreachBatch(write), checkpoint)


def running_counts(stream: DataFrame, col: str, out: str, checkpoint: str) -> None:
    """Keep a table of row counts per value over everything seen so far."""
    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    counts = stream.groupBy(col).agg(F.count("*").alias("n"))
    _run(counts.writeStream.outputMode("complete").foreachBatch(replace), checkpoint)
