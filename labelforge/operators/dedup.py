"""Unions in source order and de-duplication with well-defined winners.

A table has no row order, so "first" means the least ``order`` tuple, such as
``(source_rank, row_id)``; it must be unique per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, stored

ORDER = ("source_rank", "row_id")
#: Open rows of the two-key pass that one task takes; about 100 bytes each.
BATCH = 1_000_000


def union_sources(named: Mapping[str, DataFrame], rank: str = "source_rank") -> DataFrame:
    """Union by column name, missing columns NULL, each source with its rank."""
    ranked = [df.withColumn(rank, F.lit(i)) for i, df in enumerate(named.values())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def keep_first(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column] = ORDER, drop_blank: bool = False
) -> DataFrame:
    """The first row of each key; NULL is a key like any other.

    Winners are found on digests of the keys and the order, one per key and task before
    the shuffle, and the rows are then taken back by their order.  Neither a sort nor the
    shuffle of that search carries a text.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if drop_blank:
        for k in keys:
            df = df.where(F.col(k) != "")
    return _winners(df, keys, order, F.struct(*[F.col(c) if isinstance(c, str) else c for c in order]))


def keep_first_batch(
    df: DataFrame, key: str, batch: str, order: Sequence[str | Column] = ORDER, drop_blank: bool = False
) -> DataFrame:
    """All rows of each key's first batch: repeats inside a batch stay, those of later batches go.

    For a crawl that compares a page's titles only with those of earlier pages.  NULL is a key like
    any other, and a NULL batch comes before all others.  The rows to drop are found on digests, batches
    and the order, which must be unique per row; texts move only if those rows are too many to broadcast.
    """
    if drop_blank:
        df = df.where(F.col(key) != "")
    own = [F.col(c) if isinstance(c, str) else c for c in order]
    narrow = df.select(_digest(key).alias("_d"), F.struct(batch).alias("_b"), *[c.alias(f"_o{i}") for i, c in enumerate(own)])
    first = narrow.groupBy("_d").agg(F.min("_b").alias("_w"))
    late = narrow.join(first, "_d").where("_b > _w").select(*[f"_o{i}" for i in range(len(own))])
    return lookup_join(df, late, [c.eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(own)], "left_anti")


def _digest(key: str) -> Column:
    return F.coalesce(F.unhex(F.sha2(F.col(key).cast("string"), 256)), F.lit(b""))


def _winners(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], rank: Column) -> DataFrame:
    """Rows with the least ``rank`` of their key; ``order`` tells rows apart."""
    own = [F.col(c) if isinstance(c, str) else c for c in order]
    least = (
        df.select(*[_digest(k).alias(f"_d{i}") for i, k in enumerate(keys)], rank.alias("_r"), F.struct(*own).alias("_o"))
        .groupBy(*[f"_d{i}" for i in range(len(keys))])
        .agg(F.min(F.struct("_r", "_o")).alias("_w"))
        .select(*[F.col("_w._o")[f].alias(f"_o{i}") for i, f in enumerate(_fields(df, own))])
    )
    return df.join(least, [c.eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(own)], "left_semi")


def _fields(df: DataFrame, columns: Sequence[Column]) -> list[str]:
    return df.select(F.struct(*columns).alias("s")).schema["s"].dataType.names


def keep_longest(
    df: DataFrame, key: str, text: str, order: Sequence[str] = ORDER, first_seen: str = "first_seen"
) -> DataFrame:
    """The row with the longest text of each key, the earlier one on a tie.

    ``first_seen`` is the order tuple of the key's first row, for output in that order.
    Both come from one aggregate over digests, lengths and orders, with a partial step
    before the shuffle; the rows are then taken back by their order.
    """
    rank = F.struct(*[F.col(c) for c in order])
    # Least negative length first, then least order: one ascending tuple.
    best = F.struct((-F.length(text)).alias("_l"), *[F.col(c) for c in order])
    picked = df.groupBy(_digest(key).alias("_d")).agg(F.min(best).alias("_b"), F.min(rank).alias(first_seen))
    picked = picked.select(first_seen, *[F.col("_b")[c].alias(f"_o{i}") for i, c in enumerate(order)])
    same = [df[c].eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(order)]
    return df.join(picked, same).select(*df.columns, first_seen)


def keep_first_two_keys(
    df: DataFrame, a: str, b: str, order: Sequence[str] = ORDER, blank_keys: str = "collide", batch: int = BATCH,
) -> DataFrame:
    """Greedy pass in order: a row stays if no earlier kept row used either of its keys.

    Rounds on a narrow table replace the pass; it holds digests of the keys, so texts never travel, and rows with the
    same pair of keys collapse first.  In a round a row waits for the open rows before it that share a key.  One that
    waits for none stays, one that waits for a single other stays if that goes; such chains are followed to their
    beginning by doubling, so that their length costs its logarithm in rounds.  Rows that share a key with a kept
    one go.  As soon as ``batch`` rows or fewer are open they are passed over in order by one task, whose memory
    that bounds.  Open rows and decisions are written after each round; rounds go on until none is open.
    With ``blank_keys='ignore'`` a blank key collides with nothing.
    """
    if blank_keys not in ("collide", "ignore"):
        raise ValueError(f"unknown blank_keys {blank_keys!r}")

    def key(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        digest = F.unhex(F.substring(F.sha2(text, 256), 1, 32))
        return digest if blank_keys == "collide" else F.when(text != "", digest)

    rank = F.struct(*[F.col(c) for c in order])
    rows = df.select(rank.alias("o"), key(a).alias("a"), key(b).alias("b"))
    keyless = F.col("a").isNull() & F.col("b").isNull()
    kept = [rows.where(keyless).select("o")] if blank_keys == "ignore" else []
    # Digests of a row are put in order, as both columns share one set of keys.
    pair = F.array_sort(F.array_distinct(F.array_compact(F.array("a", "b"))))
    pairs = rows.where(~keyless).groupBy(pair.alias("ks")).agg(F.min("o").alias("o"))
    open_rows = stored(pairs.select("o", F.get("ks", F.lit(0)).alias("a"), F.get("ks", F.lit(1)).alias("b")), "open")
    while True:
        n = open_rows.count()
        if n <= batch:
            kept.append(_pass_over(open_rows))
            break
        stays = stored(_chains(open_rows), "kept")
        kept.append(stays.select("o"))
        open_rows = stored(without_used_keys(open_rows, stays).select("o", "a", "b"), "open")
    return df.join(stored(reduce(DataFrame.unionByName, kept), "kept").select("o.*"), list(order), "left_semi")


def _pass_over(open_rows: DataFrame) -> DataFrame:
    """The greedy pass itself over a bounded number of rows, sorted by order in one partition."""
    schema = open_rows.select("o").schema

    def run(batches):
        used: set = set()
        for batch in batches:
            stay = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                free = a not in used and b not in used
                if free:
                    used.update((a, a if b is None else b))
                stay.append(free)
            yield pa.RecordBatch.from_arrays([batch.column("o")], names=["o"]).filter(pa.array(stay, pa.bool_()))

    return open_rows.coalesce(1).sortWithinPartitions("o").mapInArrow(run, schema)


def _chains(open_rows: DataFrame) -> DataFrame:
    """Open rows that are known to stay: those at the beginning of a chain and every other one along it.

    Only the first two rows of a key are looked at, so a key's rows never meet in a group.
    """
    open_rows = open_rows.select("o", F.array_compact(F.array("a", "b")).alias("ks"))
    by_key = stored(open_rows.select("o", F.explode("ks").alias("k")), "keys")
    first = by_key.groupBy("k").agg(F.min("o").alias("first"))
    later = by_key.join(first, "k").where(F.col("o") > F.col("first"))
    ends = stored(first.join(later.groupBy("k").agg(F.min("o").alias("second")), "k", "left"), "ends")
    led = (
        ends.select(F.col("first").alias("o"), F.lit(None).cast(open_rows.schema["o"].dataType).alias("p"), F.lit(1).alias("n"))
        .unionByName(ends.where("second IS NOT NULL").select(F.col("second").alias("o"), F.col("first").alias("p"), F.lit(1).alias("n")))
        .groupBy("o").agg(F.sum("n").alias("n"), F.collect_set("p").alias("ps"))
    )
    # First or second on all of its keys, behind one row at most.
    step = stored(open_rows.join(led, "o").where((F.col("n") == F.size("ks")) & (F.size("ps") <= 1))
                  .select("o", F.get("ps", F.lit(0)).alias("p"), (F.size("ps") == 1).alias("odd"), (F.size("ps") == 0).alias("done")), "chains")
    while True:
        ahead = step.select(F.col("o").alias("p"), F.col("p").alias("p2"), F.col("odd").alias("odd2"), F.col("done").alias("done2"))
        both = step.where("NOT done").join(ahead, "p", "left")
        # Behind a row that itself waits for several, nothing is known yet.
        known = both.where("done2 IS NOT NULL").select(
            "o", F.coalesce("p2", "p").alias("p"), F.when(F.col("p2").isNull(), F.col("odd")).otherwise(F.col("odd") != F.col("odd2")).alias("odd"),
            F.col("done2").alias("done"), F.lit(True).alias("new"))
        step = stored(step.where("done").select("o", "p", "odd", "done", F.lit(False).alias("new")).unionByName(known), "chains")
        if step.where("new AND NOT done").isEmpty():
            break
        step = step.drop("new")
    return step.where("done AND NOT odd").select("o").join(open_rows, "o")


def without_used_keys(open_rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Open rows that share no key with a kept row; hot keys are split by adaptive execution."""
    used = kept.select(F.explode("ks").alias("k"))
    for c in ("a", "b"):
        open_rows = open_rows.join(used.withColumnRenamed("k", c), c, "left_anti")
    return open_rows


def dedup_metrics(df: DataFrame, key: str, before: DataFrame | None = None) -> DataFrame:
    """One row ``rows_before, rows_after, rows_dropped`` for de-duplication on ``key``.

    ``before`` counts an earlier stage instead, where rows were filtered in between.
    Counting goes through one row per key and task, never through whole groups.
    """
    per_key = df.groupBy(F.xxhash64(key), key).agg(F.count("*").alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")
    )
    if before is not None:
        first = before.agg(F.count("*").alias("n")).first()["n"]
        totals = totals.withColumn("rows_before", F.lit(first).cast("bigint"))
    return totals.withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))
