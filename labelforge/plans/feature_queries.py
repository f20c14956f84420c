"""Tokens, term counts, vocabulary and TF-IDF over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tokens as K
from ..operators import features, topk
from . import sqltext as S
from .registry import query
from .text_queries import texts

# A short stop list for the checked queries.
STOP = ("the", "of", "and", "to", "in", "is", "der", "die", "und", "le", "la", "de", "el", "los", "que")
VOCAB = 10_000


def _listed(mode: str, stop: bool = False) -> str:
    w = S.words("text", mode)
    if stop:
        w = f"list_filter({w}, lambda x: x NOT IN {S.in_list(STOP)})"
    return f"SELECT doc_id, len(w) AS n, array_to_string(w, ' ') AS words FROM (SELECT doc_id, {w} AS w FROM documents)"


def _words(spark, sf, *args):
    w = texts(spark, sf).select("doc_id", K.tokens("text", *args).alias("w"))
    return w.select("doc_id", F.size("w").cast("bigint").alias("n"), F.array_join("w", " ").alias("words"))


@query(_listed("train"))
def tokenize_train(spark, sf):
    return _words(spark, sf)


@query(_listed("export"))
def tokenize_export(spark, sf):
    return _words(spark, sf, "export")


@query(_listed("train", stop=True))
def remove_stopwords(spark, sf):
    return _words(spark, sf, "train", STOP)


def grams_sql(source: str = "documents", mode: str = "train", keep: str = "", hi: int = 2) -> str:
    """``(doc_id, term)`` per occurrence: words, and for ``hi`` 2 word pairs."""
    w = f"list_filter({S.words('text', mode)}, lambda x: x NOT IN {S.in_list(STOP)})" if mode == "train" else S.words("text", mode)
    words = f"(SELECT doc_id, {keep} {w} AS w FROM {source})"
    ones = f"SELECT doc_id, {keep} unnest(w) AS term FROM {words}"
    if hi == 1:
        return ones
    return f"""{ones} UNION ALL SELECT doc_id, {keep} unnest(list_transform(list_zip(w[1:len(w) - 1], w[2:len(w)]),
        lambda z: z[1] || ' ' || z[2])) FROM {words}"""


@query(f"SELECT doc_id, term, count(*) AS n FROM ({grams_sql()}) GROUP BY ALL")
def word_ngrams(spark, sf):
    return _counts(spark, sf).withColumn("n", F.col("n").cast("bigint"))


def _counts(spark, sf, ngram_range=(1, 2), stop=STOP):
    return features.term_counts(texts(spark, sf), "doc_id", "text", "train", stop, ngram_range)


ONES = f"SELECT doc_id, unnest({S.words('text')}) AS term FROM documents"


@query(f"SELECT doc_id, term, count(*) AS n FROM ({ONES}) GROUP BY ALL")
def term_counts(spark, sf):
    return _counts(spark, sf, (1, 1), ()).withColumn("n", F.col("n").cast("bigint"))


@query(f"SELECT term, count(*) AS cf, count(DISTINCT doc_id) AS df FROM ({ONES}) GROUP BY term")
def term_df(spark, sf):
    return topk.corpus_stats(texts(spark, sf), "text")


def vocab_sql(grams: str, size: int, docs: str = "documents") -> str:
    """CTEs ``tc`` (counts), ``top`` and ``vocab`` (term, feature_idx, df, idf)."""
    return f"""tc AS (SELECT doc_id, term, count(*) AS n FROM ({grams}) GROUP BY ALL),
top AS (SELECT term, sum(n)::BIGINT AS cf, count(*) AS df FROM tc GROUP BY term ORDER BY cf DESC, term LIMIT {size}),
vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS feature_idx, df,
    ln((1.0::DOUBLE + (SELECT count(*) FROM {docs})) / (1.0::DOUBLE + df)) + 1 AS idf FROM top)"""


@query(f"WITH {vocab_sql(grams_sql(), VOCAB)} SELECT term, cf, df FROM top")
def top_vocabulary(spark, sf):
    return topk.top_terms(texts(spark, sf), "text", VOCAB, stop_words=STOP, ngram_range=(1, 2))


@query(f"WITH {vocab_sql(grams_sql(), VOCAB)} SELECT term, feature_idx, df, round(idf, 6) AS idf FROM vocab")
def vocabulary_index(spark, sf):
    d = texts(spark, sf)
    v = features.fit_vocabulary(d, _counts(spark, sf), VOCAB)
    return v.select("term", F.col("feature_idx").cast("bigint").alias("feature_idx"), "df", F.round("idf", 6).alias("idf"))


@query(f"SELECT doc_id, term, round(1.0::DOUBLE + ln(count(*)::DOUBLE), 6) AS tf FROM ({ONES}) GROUP BY doc_id, term")
def tfidf_sublinear(spark, sf):
    return _counts(spark, sf, (1, 1), ()).select("doc_id", "term", F.round(features.term_frequency("n"), 6).alias("tf"))


WEIGHTS_SQL = """raw AS (SELECT doc_id, feature_idx, term, (1.0::DOUBLE + ln(n::DOUBLE)) * idf AS raw FROM tc JOIN vocab USING (term)),
weights AS (SELECT doc_id, feature_idx, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


@query(f"WITH {vocab_sql(grams_sql(), VOCAB)}, {WEIGHTS_SQL} SELECT doc_id, feature_idx, round(weight, 6) AS weight FROM weights")
def tfidf_l2(spark, sf):
    counts = _counts(spark, sf)
    vocab = features.fit_vocabulary(texts(spark, sf), counts, VOCAB)
    w = features.tfidf(counts, vocab, "doc_id", VOCAB)
    return w.select("doc_id", F.col("feature_idx").cast("bigint").alias("feature_idx"), F.round("weight", 6).alias("weight"))
