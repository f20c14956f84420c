"""Corpus counts of terms, and the most frequent ones without moving the rest.

Each task counts the terms of its rows in Arrow batches and writes one list of partial counts.  The most frequent
terms follow in three steps: the heads of all lists give a lower bound for the count that the last of them
has; a term that reaches it must have at least its share of it in some list; only such terms are summed.
Rare terms, which are most of a vocabulary, are never shuffled.

The most frequent terms of texts need no list of all terms: the occurrences in buckets of terms, which are as
few for every corpus, bound each term's from above, and only terms of full buckets become texts and are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, stored, tidy
from .counting import all_terms, lowered, run_buckets, word_lists

#: Different terms that a task holds before it closes a list.
HELD = 1_000_000
#: Buckets of terms, and the ranges of them that are added up apart.
BUCKETS, RANGES = 1 << 22, 64
_LISTS = "list long, term string, cf long, df long, head boolean"


def _merged(tables: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(tables).group_by("term", use_threads=False).aggregate([("cf", "sum"), ("df", "sum")])
    return table.select(["term", "cf_sum", "df_sum"]).rename_columns(["term", "cf", "df"])


def _lists(parts, size: int, held: int):
    def close(tables: list[pa.Table], name: int):
        table = _merged(tables)
        cf = table.column("cf").to_numpy()
        # All terms as frequent as the last of the head belong to it, so ties do not matter here.
        least = np.partition(cf, len(cf) - size)[len(cf) - size] if 0 < size < len(cf) else 0
        table = table.append_column("head", pa.array(cf >= least)).add_column(0, "list", pa.array(np.full(len(cf), name)))
        return table.combine_chunks().to_batches()

    def run(batches):
        name, tables, rows = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            for table in parts(batch):
                tables.append(table)
                rows += table.num_rows
                if rows > held:
                    tables = [_merged(tables)]
                    rows = tables[0].num_rows
                    pa.default_memory_pool().release_unused()
                    if rows > held // 2:
                        yield from close(tables, name)
                        name, tables, rows = name + 1, [], 0
        if rows:
            yield from close(tables, name)
        tables.clear()
        tidy()
    return run


def _of_texts(mode: str, stop_words: Sequence[str], lo: int, hi: int, wanted: Broadcast | None):
    """Counts of a batch of lowered texts, a few rows at a time."""
    def parts(batch: pa.RecordBatch):
        stop = pa.array(stop_words, pa.string()) if stop_words else None
        marks = np.unpackbits(wanted.value).view(bool) if wanted else None
        for _, words in word_lists(batch.column("text"), mode):
            for term, cf, df in all_terms(words, lo, hi, stop, marks):
                yield pa.table({"term": term, "cf": pa.array(cf), "df": pa.array(df)})
    return parts


def _of_counts(batch: pa.RecordBatch):
    yield pa.table({"term": batch.column("term"), "cf": batch.column("n").cast(pa.int64()), "df": pa.array(np.ones(batch.num_rows, np.int64))})


def term_lists(
    df: DataFrame, text: str, mode: str = "train", stop_words: Sequence[str] = (), ngram_range: tuple[int, int] = (1, 1),
    size: int = 0, held: int = HELD, wanted: np.ndarray | None = None,
) -> DataFrame:
    """``(list, term, cf, df, head)``: occurrences and rows of each term by list of partial counts.

    ``head`` marks the ``size`` most frequent terms of a list, with their ties.  Null texts have no terms.
    ``wanted`` marks the buckets whose terms are counted.
    """
    marks = None if wanted is None else df.sparkSession.sparkContext.broadcast(np.packbits(wanted))
    return df.select(lowered(text).alias("text")).mapInArrow(_lists(_of_texts(mode, list(stop_words), *ngram_range, marks), size, held), _LISTS)


def bucket_counts(
    df: DataFrame, text: str, mode: str = "train", stop_words: Sequence[str] = (), ngram_range: tuple[int, int] = (1, 1),
    buckets: int = BUCKETS,
) -> np.ndarray:
    """Occurrences of terms by bucket; a task sends one array for each range of buckets, and the driver holds their sums."""
    stop, (lo, hi), ranges = list(stop_words), ngram_range, min(RANGES, buckets)
    own = buckets // ranges

    def counted(batches):
        sums, stops = np.zeros(buckets, np.int64), pa.array(stop, pa.string()) if stop else None
        for batch in batches:
            for _, words in word_lists(batch.column("text"), mode):
                for places in run_buckets(words, lo, hi, stops, buckets):
                    np.add.at(sums, places, 1)
        for i, part in enumerate(sums.reshape(ranges, own)):
            most = part.max()
            if most:
                data = part.astype(np.int32 if most < 2**31 else np.int64).tobytes()
                yield pa.record_batch({"range": pa.array([i], pa.int32()), "counts": pa.array([data], pa.binary())})
        tidy()

    def added(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column("range").to_pylist(), batch.column("counts"), strict=True):
                part = held.setdefault(i, np.zeros(own, np.int64))
                part += np.frombuffer(data.as_buffer(), np.int32 if len(data.as_buffer()) == 4 * own else np.int64)
        for i, part in held.items():
            yield pa.record_batch({"range": pa.array([i], pa.int32()), "counts": pa.array([part.tobytes()], pa.binary())})

    schema = "range int, counts binary"
    parts = df.select(lowered(text).alias("text")).mapInArrow(counted, schema)
    out = np.zeros((ranges, own), np.int64)
    for row in parts.repartition(ranges, "range").mapInArrow(added, schema).collect():
        out[row.range] = np.frombuffer(row.counts, np.int64)
    return out.reshape(-1)


def corpus_stats(df: DataFrame, text: str, **options) -> DataFrame:
    """``(term, cf, df)``: occurrences and documents of every term."""
    return _summed(term_lists(df, text, **options))


def _summed(lists: DataFrame) -> DataFrame:
    return lists.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def top_terms(df: DataFrame, text: str, size: int, held: int = HELD, buckets: int = BUCKETS, **options) -> DataFrame:
    """``(term, cf, df)`` of the ``size`` terms with most occurrences; ties go by term.

    Exact at every size and for every distribution.  No term has more occurrences than its bucket, so terms of the
    fullest buckets are counted first.  If ``size`` of them have as many as the last of these buckets, all others have
    fewer; else the count of their last is a bound that no other bucket below it can reach.  Where all counts are
    alike, all terms are summed.  The texts are read two or three times.
    """
    counts = bucket_counts(df, text, buckets=buckets, **options)
    floor = int(np.partition(counts, buckets - 2 * size)[buckets - 2 * size]) if 0 < 2 * size <= buckets else 0
    if floor > 1:
        found = stored(_summed(term_lists(df, text, held=held, wanted=counts >= floor, **options)), "found")
        top = found.orderBy(F.desc("cf"), "term").limit(size)
        least = top.agg(F.min("cf")).first()[0]
        if least >= floor:
            return top
        floor = least
    wanted = counts >= floor if floor > 1 else None
    return _top(term_lists(df, text, size=size, held=held, wanted=wanted, **options), size)


def top_counts(counts: DataFrame, size: int, held: int = HELD) -> DataFrame:
    """:func:`top_terms` from rows ``(term, n)``, one for each term of each document; NULL terms are left out."""
    rows = counts.where(F.col("term").isNotNull()).select("term", "n")
    return _top(rows.mapInArrow(_lists(_of_counts, size, held), _LISTS), size)


def _top(lists: DataFrame, size: int) -> DataFrame:
    lists = stored(lists, "lists")
    return _summed(survivors(lists, size)).orderBy(F.desc("cf"), "term").limit(size)


def survivors(lists: DataFrame, size: int) -> DataFrame:
    """The entries of ``lists`` whose terms can be among the ``size`` most frequent."""
    n = lists.select("list").distinct().count()
    heads = lists.where("head").groupBy("term").agg(F.sum("cf").alias("cf")).orderBy(F.desc("cf")).limit(size)
    found, least = heads.agg(F.count("*"), F.min("cf")).first()
    if found < size:  # every term stands in a head
        return lists
    enough = lists.where(F.col("cf") * n >= least).select("term").distinct()
    return lookup_join(lists, enough, "term", "left_semi")
