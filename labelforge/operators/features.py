"""Term counts, vocabulary and TF-IDF as long tables, and rows of sparse vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import topk
from .common import stored, tidy
from .counting import TermTable, lowered, row_terms, word_lists


def english_stop_words() -> list[str]:
    """Spark's own list; pass another list where results must follow another library."""
    return StopWordsRemover.loadDefaultStopWords("english")


def term_counts(
    df: DataFrame, doc: str, text: str, mode: str = "train", stop_words: Sequence[str] = (),
    ngram_range: tuple[int, int] = (1, 1), keep: Sequence[str] = (), keep_empty: bool = False,
) -> DataFrame:
    """``(doc, *keep, term, n)``: how often each term occurs in each document.

    Documents are rows, so the count needs no shuffle; words are counted in Arrow batches, a few
    rows at a time.  ``keep_empty`` leaves a document without terms in as one row with a NULL term.
    """
    kept = df.select(doc, *keep)
    stop, (lo, hi) = list(stop_words), ngram_range

    def run(batches):
        stops = pa.array(stop, pa.string()) if stop else None
        for batch in batches:
            others = batch.drop_columns(["__text"])
            for first, words in word_lists(batch.column("__text"), mode):
                part, seen = others.slice(first, len(words)), np.zeros(len(words), bool)
                for row, term, n in row_terms(words, lo, hi, stops):
                    seen[row] = True
                    yield _rows(part, pa.array(row), term, pa.array(n.astype(np.int32)))
                if keep_empty and not seen.all():
                    none = np.flatnonzero(~seen)
                    yield _rows(part, pa.array(none), pa.nulls(len(none), pa.string()), pa.nulls(len(none), pa.int32()))

    schema = T.StructType([*kept.schema.fields, T.StructField("term", T.StringType()), T.StructField("n", T.IntegerType())])
    counts = df.select(doc, *keep, lowered(text).alias("__text")).mapInArrow(run, schema)
    counts._texts = (df, text, dict(mode=mode, stop_words=stop, ngram_range=(lo, hi)))
    return counts


def known_counts(
    df: DataFrame, doc: str, text: str, terms: Sequence[str], mode: str = "train", stop_words: Sequence[str] = (),
    ngram_range: tuple[int, int] = (1, 1),
) -> DataFrame:
    """``(doc, place, n)``: how often each of ``terms`` occurs in each document, by its place among them.

    The terms are broadcast; others do not become texts.  A document without any is one row with NULLs.
    """
    stop, (lo, hi) = list(stop_words), ngram_range
    shared = df.sparkSession.sparkContext.broadcast(TermTable(terms))

    def run(batches):
        stops = pa.array(stop, pa.string()) if stop else None
        for batch in batches:
            for first, words in word_lists(batch.column("__text"), mode):
                docs, seen = batch.select([0]).slice(first, len(words)), np.zeros(len(words), bool)
                for row, place, n in shared.value.row_terms(words, lo, hi, stops):
                    seen[row] = True
                    yield _rows(docs, pa.array(row), pa.array(place.astype(np.int32)), pa.array(n.astype(np.int32)), "place")
                none = np.flatnonzero(~seen)
                yield _rows(docs, pa.array(none), pa.nulls(len(none), pa.int32()), pa.nulls(len(none), pa.int32()), "place")
        tidy()

    docs = df.select(doc, lowered(text).alias("__text"))
    return docs.mapInArrow(run, T.StructType([docs.schema[0], T.StructField("place", T.IntegerType()), T.StructField("n", T.IntegerType())]))


def term_rows(
    df: DataFrame, doc: str, text: str, vocab: DataFrame, mode: str = "train", stop_words: Sequence[str] = (),
    ngram_range: tuple[int, int] = (1, 1), keep: Sequence[str] = (), sublinear: bool = True,
) -> DataFrame:
    """``(doc, *keep, indices, values, norm)``: one row for each row of ``df``, with the weights of its terms by feature index.

    The values are L2-normalised; ``norm`` is what they were divided by.  A row is made where its text is read: terms outside
    ``vocab`` do not become texts, and nothing is shuffled.  The vocabulary is broadcast.
    """
    known = vocab.select("term", "feature_idx", "idf").orderBy("feature_idx").collect()
    index, idf = np.array([r[1] for r in known], np.int32), np.array([r[2] for r in known], float)
    shared = df.sparkSession.sparkContext.broadcast((TermTable([r[0] for r in known]), index, idf))
    kept, stop, (lo, hi) = df.select(doc, *keep), list(stop_words), ngram_range

    def run(batches):
        stops, (table, index, idf) = pa.array(stop, pa.string()) if stop else None, shared.value
        for batch in batches:
            others = batch.drop_columns(["__text"])
            for first, words in word_lists(batch.column("__text"), mode):
                found = [*zip(*table.row_terms(words, lo, hi, stops))] or [[np.zeros(0, np.int64)]] * 3
                row, place, n = map(np.concatenate, found)
                order = np.lexsort((place, row))
                row, place, n = row[order], place[order], n[order].astype(float)
                value = (1 + np.log(n) if sublinear else n) * idf[place]
                norm = np.sqrt(np.bincount(row, value * value, len(words)))
                ends = pa.array(np.searchsorted(row, np.arange(len(words) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (index[place], value / norm[row])]
                yield pa.record_batch([*others.slice(first, len(words)).columns, *lists, pa.array(norm)], names=[*others.schema.names, *_ROW])
        tidy()

    fields = zip(_ROW, (T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType()), T.DoubleType()))
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in fields]])
    return df.select(doc, *keep, lowered(text).alias("__text")).mapInArrow(run, schema)


_ROW = ("indices", "values", "norm")


def _several(rows: DataFrame, doc: str) -> DataFrame:
    """``(_doc, _whole)`` of documents that stand in several rows, or have no id; ``_whole`` is the norm of all rows together."""
    groups = rows.groupBy(F.col(doc).alias("_doc")).agg(F.sqrt(F.sum(F.col("norm") * F.col("norm"))).alias("_whole"), F.count("*").alias("_n"))
    return stored(groups.where("_n > 1 OR _doc IS NULL").drop("_n"), "several")


def row_entries(rows: DataFrame, doc: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(doc, *keep, feature_idx, weight)`` of stored ``rows`` of :func:`term_rows`, as :func:`tfidf` has them.

    Rows of one ``doc``, or without one, share a norm.  No row moves, but for the norms of such documents.
    """
    share = F.coalesce(F.col("norm") / F.col("_whole"), F.lit(1.0))
    shared = rows.join(_several(rows, doc), F.col(doc).eqNullSafe(F.col("_doc")), "left")
    long = shared.select(doc, *keep, share.alias("_share"), F.inline(F.arrays_zip("indices", "values")))
    return long.select(doc, *keep, F.col("indices").alias("feature_idx"), (F.col("values") * F.col("_share")).alias("weight"))


def joined_rows(rows: DataFrame, doc: str, keep: Sequence[str] = ()) -> DataFrame:
    """:func:`to_sparse` of stored ``rows`` of :func:`term_rows`: each has the terms of all rows of its ``doc``, and none without one.

    Only rows of documents that stand in several rows move.
    """
    several = _several(rows, doc)
    same = F.col(doc).eqNullSafe(F.col("_doc"))
    moved = rows.join(several, same, "left_semi")
    pairs = row_entries(moved.where(F.col(doc).isNotNull()), doc).withColumnRenamed(doc, "_doc")
    return rows.join(several, same, "left_anti").select(doc, *keep, "indices", "values").unionByName(
        to_sparse(pairs, moved.withColumn("_doc", F.col(doc)), "_doc", [doc, *keep]).drop("_doc"))


def _rows(batch: pa.RecordBatch, row: pa.Array, term: pa.Array, n: pa.Array, name: str = "term") -> pa.RecordBatch:
    """``(*columns of batch, term, n)`` with the given rows of ``batch``."""
    return pa.record_batch([*batch.take(row).columns, term, n], names=[*batch.schema.names, name, "n"])


def term_stats(counts: DataFrame) -> DataFrame:
    """``(term, cf, df)``: occurrences and documents per term, from distinct counts rows."""
    return counts.groupBy("term").agg(F.sum("n").alias("cf"), F.count("*").alias("df"))


def top_terms(stats: DataFrame, size: int) -> DataFrame:
    """The ``size`` terms with most occurrences; ties go by term."""
    return stats.orderBy(F.desc("cf"), "term").limit(size)


def vocabulary(stats: DataFrame, n_docs: int | Column, size: int) -> DataFrame:
    """``(term, feature_idx, df, idf)`` of the top terms, indexed in term order.

    The window runs over at most ``size`` rows.
    """
    n = F.lit(n_docs).cast("double") if isinstance(n_docs, int) else n_docs
    return (
        top_terms(stats, size)
        .withColumn("feature_idx", F.row_number().over(Window.orderBy("term")) - 1)
        .withColumn("idf", F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0)
        .select("term", "feature_idx", "df", "idf")
    )


def term_frequency(n: Column | str, sublinear: bool = True) -> Column:
    n = F.col(n) if isinstance(n, str) else n
    return 1.0 + F.log(n.cast("double")) if sublinear else n.cast("double")


def fit_vocabulary(df: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """Vocabulary of ``counts`` with document frequencies over all rows of ``df``.

    Where ``counts`` are what :func:`term_counts` returned, its texts are counted in one pass, and no row for
    a term of a document leaves a worker; any other rows are counted as they are.
    """
    n = df.count()
    texts = getattr(counts, "_texts", None)
    top = topk.top_terms(texts[0], texts[1], size, **texts[2]) if texts else topk.top_counts(counts, size)
    return vocabulary(top, n, size)


def tfidf(
    counts: DataFrame, vocab: DataFrame, doc: str, size: int, sublinear: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(doc, *keep, feature_idx, term, weight)``: L2-normalised weights.

    The vocabulary is written, so that the planner knows its bytes and broadcasts it within
    the session's threshold; beyond it the join shuffles.  The norm is one window over
    a document's own terms, which shuffles on the document id only.
    """
    vocab = stored(vocab.select("term", "feature_idx", "idf"), "vocab")
    raw = counts.join(vocab, "term").withColumn("raw", term_frequency("n", sublinear) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(doc)))
    return raw.select(doc, *keep, "feature_idx", "term", (F.col("raw") / norm).alias("weight"))


def to_sparse(weights: DataFrame, docs: DataFrame, doc: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(doc, *keep, indices, values)``: the weights of each row of ``docs`` by feature index, empty if it has no term."""
    rows = weights.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("feature_idx", "weight"))).alias("fw"))
    return docs.select(doc, *keep).join(rows, doc, "left").select(
        doc, *keep, F.coalesce("fw.feature_idx", F.array().cast("array<int>")).alias("indices"),
        F.coalesce("fw.weight", F.array().cast("array<double>")).alias("values"))


def to_vectors(weights: DataFrame, docs: DataFrame, doc: str, size: int, keep: Sequence[str] = ()) -> DataFrame:
    """``(doc, *keep, features)``: one sparse vector per row of ``docs``, zero if it has no term.

    A document has at most ``size`` features.  The vector is built inside the JVM from
    the four fields that a vector column is stored as.
    """
    return as_vectors(to_sparse(weights, docs, doc, keep), doc, size, keep)


def as_vectors(sparse: DataFrame, doc: str, size: int, keep: Sequence[str] = ()) -> DataFrame:
    """``(doc, *keep, features)`` from the rows of :func:`to_sparse`."""
    fields = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), "indices", "values")
    schema = T.StructType([T.StructField("v", VectorUDT())])
    vector = F.from_json(F.to_json(F.struct(fields.alias("v"))), schema)["v"]
    return sparse.select(doc, *keep, vector.alias("features"))
