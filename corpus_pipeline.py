"""From raw documents to packed training sequences: each stage is written and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelforge.llm import lines, ngram_join, packing, quality, substring
from labelforge.llm.base import stored, table

THRESHOLD = 0.3


def _with_text(df: DataFrame, columns: list[str], text, changed) -> DataFrame:
    """``columns``, with the text replaced and its length counted anew where it changed."""
    out = {c: F.col(c) for c in columns} | {"text": text}
    if "n_chars" in columns:
        out["n_chars"] = F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars"))
    return df.select(*[out[c].alias(c) for c in columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; a null or empty text is scored like any other."""
    return docs.where(quality.quality_scores(docs, table(spark, sf_dir, "labels")) >= THRESHOLD)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; none is dropped.  Copies count as one page, as they are still there."""
    out = lines.line_dedup(docs, distinct=True)
    return _with_text(out, docs.columns, F.col("text"), F.col("n_removed") > 0)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of linked documents; rows without an id stay."""
    joined = ngram_join.ngram_join(docs)
    gone = joined.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("gone"))
    gone = stored(gone.where("gone").select("doc_id"), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the word runs that occur elsewhere; a text that loses nothing stays as it is."""
    out = substring.substring_dedup(docs).select("payload.*", F.col("n_removed").alias("__removed"), F.col("kept").alias("__kept"))
    cut = F.col("__removed") > 0
    return _with_text(out, docs.columns, F.when(cut, F.col("__kept")).otherwise(F.col("text")), cut)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality), ("lines", drop_lines), ("near_duplicates", drop_near_duplicates),
    ("substrings", drop_substrings), ("packing", pack),
]

#: SQL has neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
