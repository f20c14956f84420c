"""Softmax scores of a linear classifier from exported parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binding import let
from .common import stored
from .features import known_counts, term_counts, term_frequency

#: Terms of a model that every task may hold.
HELD = 1_000_000


@dataclass
class LinearParams:
    """A linear text model: ``terms`` is ``(term, feature_idx, idf, coef array<double>)``.

    ``coef`` holds a weight for each class.  The classes and intercepts are short lists;
    the terms stay a table, ``n_terms`` long at most.
    """

    classes: list[str]
    intercept: list[float]
    terms: DataFrame
    n_terms: int
    ngram_range: tuple[int, int] = (1, 2)
    sublinear_tf: bool = True
    stop_words: list[str] = field(default_factory=list)


def softmax(scores: Column) -> Column:
    """Probabilities of an array of scores, shifted by the largest."""
    return let(
        scores,
        lambda s: let(
            F.transform(s, lambda x: F.exp(x - F.array_max(s))),
            lambda e: let(
                F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x),
                lambda total: F.transform(e, lambda x: x / total),
            ),
        ),
    )


def model_counts(df: DataFrame, params: LinearParams, doc: str, text: str, tokenizer: str = "export") -> DataFrame:
    """``(doc, place, n)``: how often each term of a model of up to ``HELD`` terms occurs in each row, by its place among the sorted terms."""
    names = [r.term for r in params.terms.where("term IS NOT NULL").select("term").distinct().orderBy("term").collect()]
    return known_counts(df, doc, text, names, tokenizer, params.stop_words if tokenizer == "train" else (), params.ngram_range)


def score(df: DataFrame, params: LinearParams, doc: str, text: str, tokenizer: str = "export", counts: DataFrame | None = None) -> DataFrame:
    """``(doc, predicted_label, confidence, probs array<double>)`` for every row.

    A document's terms stay in its task: they are counted in the row, meet the
    broadcast terms, and are added up before the shuffle, which carries one row of sums
    per document.  The norm divides the sums afterwards, so no second pass is needed.
    Where a task can hold the model's terms, only these leave its worker, as numbers.
    ``tokenizer='train'`` also removes the stop words the model was trained without.  ``counts`` may hold the stored
    :func:`model_counts` of a model with the same terms.
    """
    stop_words = params.stop_words if tokenizer == "train" else ()
    if params.n_terms <= HELD:
        place = F.dense_rank().over(Window.orderBy("term")) - 1
        terms = stored(params.terms.where("term IS NOT NULL").select(place.alias("place"), "term", "idf", "coef"), "terms")
        counts = model_counts(df, params, doc, text, tokenizer) if counts is None else counts
        return _scored(counts, terms.drop("term"), "place", params, doc)
    counts = term_counts(
        df, doc, text, tokenizer, stop_words, params.ngram_range, keep_empty=True
    )
    return score_counts(counts, params, doc)


def score_counts(counts: DataFrame, params: LinearParams, doc: str) -> DataFrame:
    """:func:`score` from term counts, which have a NULL term for documents without any."""
    return _scored(counts, stored(params.terms.select("term", "idf", "coef"), "terms"), "term", params, doc)


def _scored(counts: DataFrame, terms: DataFrame, on: str, params: LinearParams, doc: str) -> DataFrame:
    weight = term_frequency("n", params.sublinear_tf) * F.col("idf")
    weighted = counts.join(terms, on, "left").select(
        doc, weight.alias("w"), *[F.col("coef")[i].alias(f"c{i}") for i in range(len(params.classes))]
    )
    sums = weighted.groupBy(doc).agg(
        F.sum(F.col("w") * F.col("w")).alias("ss"),
        *[F.sum(F.col("w") * F.col(f"c{i}")).alias(f"s{i}") for i in range(len(params.classes))],
    )
    scores = F.array(*[
        F.coalesce(F.try_divide(F.col(f"s{i}"), F.sqrt("ss")), F.lit(0.0)) + F.lit(float(b))
        for i, b in enumerate(params.intercept)
    ])
    names = F.array(*[F.lit(c) for c in params.classes])
    probs = sums.select(doc, softmax(scores).alias("probs"))
    best = F.array_max("probs")
    # array_position gives the first place, so a tie goes to the lower class index.
    return probs.select(
        doc,
        F.element_at(names, F.array_position("probs", best).cast("int")).alias("predicted_label"),
        best.alias("confidence"),
        "probs",
    )


def probability_map(scored: DataFrame, params: LinearParams) -> DataFrame:
    """Replace the probability array by a map from class to probability."""
    names = F.array(*[F.lit(c) for c in params.classes])
    return scored.withColumn("probabilities", F.map_from_arrays(names, "probs")).drop("probs")


def parity(scored: DataFrame, reference: DataFrame, doc: str) -> DataFrame:
    """One row ``max_abs_diff`` between two probability arrays per document."""
    diff = F.array_max(F.zip_with("probs", "ref_probs", lambda a, b: F.abs(a - b)))
    other = reference.select(doc, F.col("probs").alias("ref_probs"))
    return scored.join(other, doc).agg(F.max(diff).alias("max_abs_diff"))
