"""Keys that earlier batches have seen, as a bucketed table of digests.

The table is partitioned by batch and bucketed by digest, so a batch is dealt to the buckets once and meets the
history where that lies: the history is neither shuffled nor moved, however long it is.  A batch's digests are a
partition of their own, which repeating the batch replaces.  Many small partitions are merged from time to
time; until the old ones are dropped a digest may stand twice, which changes nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a table, fixed when it is created, and batches after which partitions are merged.
BUCKETS, MERGE = 64, 32


def digest(key: str) -> Column:
    return F.coalesce(F.unhex(F.sha2(F.col(key).cast("string"), 256)), F.lit(b""))


class Seen:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, merge: int = MERGE):
        self.spark, self.path, self.buckets, self.merge = spark, path, buckets, merge
        self._files(path, lambda fs, folder: fs.mkdirs(folder))
        self.name = "seen_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (_d BINARY, batch BIGINT) USING parquet PARTITIONED BY (batch) "
            f"CLUSTERED BY (_d) INTO {buckets} BUCKETS LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def batches(self) -> list[int]:
        return sorted(int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect())

    def unseen(self, batch: DataFrame, key: str, batch_id: int) -> DataFrame:
        """Rows whose key no batch but ``batch_id`` has; its own digests are of an attempt that failed."""
        before = self.spark.table(self.name).where(F.col("batch") != batch_id).select("_d").hint("merge")
        return batch.withColumn("_d", digest(key)).join(before, "_d", "left_anti").drop("_d")

    def add(self, batch: DataFrame, key: str, batch_id: int) -> None:
        self._write(batch.select(digest(key).alias("_d")), batch_id)

    def _write(self, digests: DataFrame, batch_id: int) -> None:
        rows = digests.distinct().repartition(self.buckets, "_d")
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch={int(batch_id)}) SELECT _d FROM {{rows}}", rows=rows)

    def merged(self, batch_id: int) -> None:
        """Merge the partitions of batches before ``batch_id``, which are all complete, if they are many."""
        old = [b for b in self.batches() if b < batch_id]
        if len(old) < self.merge:
            return
        # Merged partitions have negative numbers, each new one below those it replaces.
        self._write(self.spark.read.schema("_d binary").parquet(*[f"{self.path}/batch={b}" for b in old]), min([0, *old]) - 1)
        for b in old:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (batch={b})")
            # An external table keeps the files of a dropped partition.
            self._files(f"{self.path}/batch={b}", lambda fs, folder: fs.delete(folder, True))

    def _files(self, path: str, fn) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fn(folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder)
