"""Exported parameters of a linear text model: JSON document, tables, Spark ML pipeline."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.common import stored
from ..operators.features import english_stop_words
from ..operators.models import Fitted
from ..operators.score import LinearParams

_DOUBLES = T.ArrayType(T.DoubleType())
MODEL_SCHEMA = (
    T.StructType()
    .add("classes", T.ArrayType(T.StringType()))
    .add("vocabulary", T.MapType(T.StringType(), T.IntegerType()))
    .add("idf", _DOUBLES)
    .add("coef", T.ArrayType(_DOUBLES))
    .add("intercept", _DOUBLES)
    .add("ngram_range", T.ArrayType(T.IntegerType()))
    .add("sublinear_tf", "boolean")
    .add("stop_words", T.ArrayType(T.StringType()))
)


def _in_index_order(params: LinearParams) -> DataFrame:
    # At most n_terms structs, the size a vocabulary is cut to.
    return params.terms.agg(
        F.array_sort(F.collect_list(F.struct("feature_idx", "term", "idf", "coef"))).alias("t")
    )


def model_document(params: LinearParams) -> DataFrame:
    """The one-row model document: vocabulary, idf, coefficients by class, intercepts."""
    def row(c: int) -> Column:
        return F.transform("t.coef", lambda per_class: per_class[c])

    return _in_index_order(params).select(
        F.array(*map(F.lit, params.classes)).alias("classes"),
        F.map_from_arrays(F.col("t.term"), F.col("t.feature_idx")).alias("vocabulary"),
        F.col("t.idf").alias("idf"),
        F.array(*[row(c) for c in range(len(params.classes))]).alias("coef"),
        F.array(*[F.lit(float(b)) for b in params.intercept]).alias("intercept"),
        F.array(*[F.lit(n) for n in params.ngram_range]).alias("ngram_range"),
        F.lit(params.sublinear_tf).alias("sublinear_tf"),
        F.array(*map(F.lit, params.stop_words)).cast("array<string>").alias("stop_words"),
    )


def vocabulary_document(params: LinearParams, max_features: int | None) -> DataFrame:
    """The one-row description of the vocabulary, without coefficients.

    ``stop_words`` is ``english`` if that list was used, else the list itself.
    """
    own = sorted(params.stop_words)
    stop_words = "english" if own and own == sorted(english_stop_words()) else json.dumps(list(params.stop_words))
    return model_document(params).select(
        "classes", "vocabulary", "idf", F.lit(max_features).cast("int").alias("max_features"),
        "ngram_range", F.lit(stop_words).alias("stop_words"),
    )


def export_params(params: LinearParams, path: str, max_features: int | None = None) -> None:
    """Write ``path/model`` and ``path/vocabulary``, one JSON document each."""
    model_document(params).coalesce(1).write.mode("overwrite").json(f"{path}/model")
    vocabulary_document(params, max_features).coalesce(1).write.mode("overwrite").json(f"{path}/vocabulary")


def load_params(spark: SparkSession, path: str) -> LinearParams:
    """Read a model document back into a table of terms and short class lists."""
    doc = spark.read.schema(MODEL_SCHEMA).json(path)
    head = doc.select(
        "classes", "intercept", "ngram_range", F.coalesce("sublinear_tf", F.lit(True)).alias("sublinear_tf"),
        "stop_words", F.size("idf").alias("n"),
    ).first()
    per_feature = doc.select(
        F.inline(
            F.transform(
                "idf",
                lambda w, i: F.struct(
                    i.alias("feature_idx"), w.alias("idf"), F.transform("coef", lambda row: row[i]).alias("coef")
                ),
            )
        )
    )
    names = doc.select(F.explode("vocabulary").alias("term", "feature_idx"))
    terms = stored(names.join(per_feature, "feature_idx").select("term", "feature_idx", "idf", "coef"), "terms")
    lo, hi = head["ngram_range"] or (1, 2)
    return LinearParams(
        head["classes"], head["intercept"], terms, head["n"], (lo, hi), head["sublinear_tf"],
        head["stop_words"] or [],
    )


def save_fitted(fitted: Fitted, path: str) -> None:
    """Write the parameters, which score text on their own, and the Spark ML pipeline if there is one."""
    if fitted.pipeline is not None:
        fitted.pipeline.write().overwrite().save(f"{path}/pipeline")
    export_params(fitted.params, path)


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/pipeline")
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return Fitted(load_params(spark, f"{path}/model"), PipelineModel.load(f"{path}/pipeline") if there else None)
