"""Linear classifiers on TF-IDF rows: logistic regression, linear SVM with the squared hinge, naive Bayes.

Every fit gives the same :class:`~labelforge.operators.score.LinearParams`, so one scorer
predicts for all of them, and the parameters export in one format.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_text
from . import linear, topk
from .common import stored
from .evaluate import accuracy, averages, category_f1, report
from .features import as_vectors, joined_rows, row_entries, term_counts, term_rows, tfidf, to_sparse, vocabulary
from .score import HELD, LinearParams, model_counts, score, score_counts
from .split import class_weights, with_class_weight


@dataclass
class Features:
    """What a fit needs of the training rows: weights, labels and the vocabulary."""

    docs: DataFrame
    doc: str
    label: str
    vocab: DataFrame
    size: int
    n_rows: int
    ngram_range: tuple[int, int]
    stop_words: list[str]
    #: What the weights are made from: rows of :func:`~labelforge.operators.features.term_rows`, or a long table of term counts.
    found: DataFrame | None = None
    counts: DataFrame | None = None

    @cached_property
    def entries(self) -> DataFrame:
        """``(doc, label, feature_idx, weight)``."""
        if self.counts is not None:
            return stored(tfidf(self.counts, self.vocab, self.doc, self.size, keep=[self.label]), "weights").drop("term")
        return row_entries(self.found, self.doc, [self.label])

    @cached_property
    def weights(self) -> DataFrame:
        """``(doc, label, feature_idx, term, weight)``."""
        terms = self.vocab.select("feature_idx", "term")
        return self.entries.join(terms, "feature_idx").select(self.doc, self.label, "feature_idx", "term", "weight")

    @cached_property
    def sparse(self) -> DataFrame:
        """``(doc, label, indices, values)`` of each training row."""
        if self.counts is not None:
            return stored(to_sparse(self.entries, self.docs, self.doc, [self.label]), "sparse")
        return joined_rows(self.found, self.doc, [self.label])

    @cached_property
    def rows(self) -> DataFrame:
        """``(doc, label, features)``, written on first use since solvers read it at every step."""
        return stored(as_vectors(self.sparse, self.doc, self.size, [self.label]), "vectors")

    @cached_property
    def classes(self) -> list[str]:
        return sorted(r[0] for r in self.docs.select(self.label).distinct().collect())

    @cached_property
    def blocks(self) -> DataFrame:
        """The same rows packed for :mod:`~labelforge.operators.linear`."""
        return linear.pack(self.sparse, self.label, self.classes)

    def weights_of(self, factors: Mapping[str, float] | None = None) -> tuple[float, ...]:
        """Balanced class weights times ``factors``, in the order of ``classes``."""
        found = {r[self.label]: r["class_weight"] for r in class_weights(self.docs, self.label, factors).collect()}
        return tuple(float(found[c]) for c in self.classes)


def build_features(
    train: DataFrame, doc: str, text: str, label: str, size: int = 10_000,
    ngram_range: tuple[int, int] = (1, 2), stop_words: Sequence[str] = (), counts: DataFrame | None = None,
    stats: DataFrame | None = None,
) -> Features:
    """Vocabulary and weights from the training rows only.

    A missing label becomes the class ``nan``.  The vocabulary is counted in the texts and the weights of a row are made
    where its text is read, so that no row for a term of a document is written or moved.  ``counts`` may hold stored
    term counts of the same rows, with their label; ``stats`` their ``size`` most frequent terms or more, with ``(term, cf, df)``.
    """
    train, stop_words = train.withColumn(label, as_text(label)), list(stop_words)
    if stats is None:
        stats = topk.top_terms(train, text, size, mode="train", stop_words=stop_words, ngram_range=ngram_range) if counts is None else topk.top_counts(counts, size)
    if counts is not None:
        docs, found = stored(train.select(doc, label), "labels"), None
        n_rows = docs.count()
        vocab = stored(vocabulary(stats, n_rows, size), "vocab")
    else:
        n_rows = train.count()
        vocab = stored(vocabulary(stats, n_rows, size), "vocab")
        found = stored(term_rows(train, doc, text, vocab, "train", stop_words, ngram_range, [label]), "rows")
        docs = found.select(doc, label)
    return Features(docs, doc, label, vocab, vocab.count(), n_rows, ngram_range, stop_words, found, counts)


@dataclass
class Fitted:
    """A fitted model as scorer parameters, and as a Spark ML pipeline where there is one."""

    params: LinearParams
    pipeline: PipelineModel | None = None


def _linear_params(feats: Features, classes: list[str], coef, intercept) -> LinearParams:
    """Attach a ``classes x terms`` coefficient matrix, which a solver returned to the driver."""
    spark = feats.vocab.sparkSession
    columns = [(i, [float(x) for x in c]) for i, c in enumerate(zip(*coef))]
    table = spark.createDataFrame(columns, "feature_idx int, coef array<double>")
    terms = stored(feats.vocab.select("term", "feature_idx", "idf").join(table, "feature_idx"), "terms")
    return LinearParams(
        classes, [float(b) for b in intercept], terms, feats.size, feats.ngram_range,
        stop_words=feats.stop_words,
    )


def _weighted(feats: Features, label: str, factors: Mapping[str, float] | None) -> DataFrame:
    """Training rows with their class weight."""
    return with_class_weight(feats.rows, label, class_weights(feats.docs, label, factors))


def fit_logreg(
    feats: Features, label: str, C: float = 1.0, factors: Mapping[str, float] | None = None,
    max_iter: int = 1000, tol: float = 1e-4,
) -> Fitted:
    """Multinomial logistic regression with balanced class weights times ``factors``.

    The penalty is ``1 / (C * sum of weights)`` because Spark averages the loss.
    """
    rows = _weighted(feats, label, factors).persist()
    total = rows.agg(F.sum("class_weight")).first()[0]
    indexer = StringIndexer(inputCol=label, outputCol="y", stringOrderType="alphabetAsc").fit(rows)
    lr = LogisticRegression(
        featuresCol="features", labelCol="y", weightCol="class_weight", family="multinomial",
        standardization=False, regParam=1.0 / (C * total), elasticNetParam=0.0, maxIter=max_iter, tol=tol,
    ).fit(indexer.transform(rows))
    rows.unpersist()
    back = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=indexer.labels)
    params = _linear_params(
        feats, indexer.labels, lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    )
    return Fitted(params, PipelineModel([lr, back]))


@dataclass
class Spec:
    """A linear model of a path: ``kind`` is ``svm`` (squared hinge, one class against the rest) or ``logreg``."""

    kind: str
    C: float = 1.0
    factors: Mapping[str, float] | None = None


@dataclass
class PathFit(Fitted):
    """With the solution of each class, or of all classes together."""

    solutions: Sequence[linear.Solution] = ()


def fit_path(feats: Features, label: str, specs: Sequence[Spec], tol: float = 1e-3, max_passes: int = 1000) -> list[PathFit]:
    """Several models of the same rows; every pass over the rows serves all that are not yet fitted.

    The objective is ``|w|^2 / 2 + C * sum of weight * loss``, solved until no entry of its gradient exceeds ``tol``.
    For an SVM a class's own rows carry its balanced weight and the others weight 1; the loss is the
    squared hinge and the intercept is penalised.  For logistic regression rows carry their
    class's weight and intercepts are free.
    """
    problems, owner = [], []
    for i, spec in enumerate(specs):
        weights = feats.weights_of(spec.factors)
        targets = range(len(feats.classes)) if spec.kind == "svm" else [None]
        problems += [linear.Problem(weights, spec.C, t) for t in targets]
        owner += [i] * len(targets)
    solved = linear.path(feats.blocks, feats.size, problems, tol, max_passes)
    out = []
    for i in range(len(specs)):
        mine = [x for x, o in zip(solved, owner) if o == i]
        coef = np.concatenate([x.coef for x in mine]) if mine else np.zeros((0, feats.size + 1))
        out.append(PathFit(_linear_params(feats, feats.classes, coef[:, :-1].tolist(), coef[:, -1].tolist()), solutions=mine))
    return out


def fit_ovr_svm(feats: Features, label: str, C: float = 1.0, max_iter: int = 1000, tol: float = 1e-3) -> PathFit:
    """One linear SVM per class against the rest, all classes in each pass; see :func:`fit_path`."""
    return fit_path(feats, label, [Spec("svm", C)], tol, max_iter)[0]


def hinge_slopes(feats: Features, label: str, params: LinearParams, C: float = 1.0, flat: float = 1e-3) -> DataFrame:
    """Per class the SVM objective, the squared norm and ``n_flat``, how many slopes are ``flat`` or less.

    Computed from exported parameters and the rows of weights, apart from the solver, in one pass over the rows: at the optimum every
    term and the intercept count as flat.
    """
    spark, classes, b = feats.docs.sparkSession, params.classes, np.array(params.intercept, float)
    per_class = class_weights(feats.docs, label).collect()
    weight_of = {r[label]: r["class_weight"] for r in per_class}
    held = params.terms.select("feature_idx", "coef").collect()
    places = np.array([r[0] for r in held], np.int64)
    coef = np.zeros((len(classes), max(feats.size, 1 + places.max(initial=-1))))
    coef[:, places] = np.array([r[1] for r in held], float).reshape(len(places), len(classes)).T
    shared = spark.sparkContext.broadcast(coef)

    def run(batches):
        coef = shared.value
        k, size = coef.shape
        total = np.zeros(2 * k + k * size)  # losses, slopes of the intercepts and of the terms
        for batch in batches:
            lists, labels = batch.column("indices"), batch.column(label)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            index, value = lists.flatten().to_numpy(), batch.column("values").flatten().to_numpy()
            weight = np.array([weight_of[x] for x in labels.to_pylist()], float)
            for i, c in enumerate(classes):
                own = pc.equal(labels, c).to_numpy(zero_copy_only=False)
                sign = np.where(own, 1.0, -1.0)
                short = np.maximum(1 - sign * (np.bincount(row, value * coef[i, index], len(lists)) + b[i]), 0)
                factor = C * np.where(own, weight, 1.0)
                slope = -2 * factor * sign * short
                total[i] += (factor * short * short).sum()
                total[k + i] += slope.sum()
                total[2 * k + i * size : 2 * k + (i + 1) * size] += np.bincount(index, value * slope[row], size)
        yield from linear.ranges(total)

    total = linear.collected(feats.sparse.select(label, "indices", "values").mapInArrow(run, linear.SUMS), 2 * len(classes) + coef.size)
    loss, slopes, terms = np.split(total, [len(classes), 2 * len(classes)])
    steep = np.abs(terms.reshape(coef.shape) + coef)[:, places] <= flat
    square = (coef * coef).sum(1) + b * b
    count = {r[label]: r["n_c"] for r in per_class}
    rows = [(c, float(loss[i] + square[i] / 2), float(square[i]), int(steep[i].sum() + (abs(slopes[i] + b[i]) <= flat)), count[c])
            for i, c in enumerate(classes) if c in count]
    return spark.createDataFrame(rows, f"`{label}` string, objective double, squared_norm double, n_flat long, n_c long")


def naive_bayes_tables(feats: Features, label: str, alpha: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """``(label, log_prior)`` and ``(label, term, feature_idx, log_prob)`` in closed form.

    The prior is not smoothed.  Sums per class and term combine in the tasks first; the
    zero-filled table has ``classes x terms`` rows.
    """
    everything = Window.partitionBy(F.lit(0))
    priors = feats.docs.groupBy(label).agg(F.count("*").alias("n_c")).select(
        label, F.log(F.col("n_c") / F.sum("n_c").over(everything)).alias("log_prior")
    )
    classes = [r[0] for r in priors.select(label).orderBy(label).collect()]
    per_term = feats.entries.groupBy("feature_idx").agg(
        *[F.sum(F.when(F.col(label) == c, F.col("weight")).otherwise(0.0)).alias(f"w{i}") for i, c in enumerate(classes)]
    ).join(feats.vocab.select("feature_idx", "term"), "feature_idx")
    long = per_term.select(
        "feature_idx", "term",
        F.inline(F.array(*[F.struct(F.lit(c).alias(label), F.col(f"w{i}").alias("w")) for i, c in enumerate(classes)])),
    )
    whole = F.sum("w").over(Window.partitionBy(label)) + F.lit(alpha * feats.size)
    probs = long.select(label, "term", "feature_idx", F.log((F.col("w") + alpha) / whole).alias("log_prob"))
    return priors, probs


def fit_naive_bayes(feats: Features, label: str, alpha: float = 0.1) -> Fitted:
    """Multinomial naive Bayes on TF-IDF weights, as a linear model in log space."""
    priors, probs = naive_bayes_tables(feats, label, alpha)
    by_class = priors.orderBy(label).collect()
    per_term = probs.groupBy("feature_idx").agg(
        F.array_sort(F.collect_list(F.struct(F.col(label).alias("l"), "log_prob")))["log_prob"].alias("coef")
    )
    terms = stored(feats.vocab.select("term", "feature_idx", "idf").join(per_term, "feature_idx"), "terms")
    params = LinearParams(
        [r[label] for r in by_class], [r["log_prior"] for r in by_class], terms, feats.size,
        feats.ngram_range, stop_words=feats.stop_words,
    )
    return Fitted(params)


def _fit_group(feats: Features, label: str, variants: Sequence[Mapping], key: tuple, paths: dict) -> dict:
    """Fit all linear variants of one range and size together, into ``paths`` by variant number."""
    same = [i for i, v in enumerate(variants) if v["kind"] != "nb" and (v["ngram_range"], v["size"]) == key]
    tol = min(variants[i].get("tol", 1e-3) for i in same)
    paths.update(zip(same, fit_path(feats, label, [Spec(variants[i]["kind"], variants[i]["C"]) for i in same], tol)))
    return paths


def run_variants(
    train: DataFrame, test: DataFrame, doc: str, text: str, label: str,
    variants: Sequence[Mapping], stop_words: Sequence[str] = (), categories: Sequence[str] = (),
) -> DataFrame:
    """Fit each variant on one split; one row of metrics per variant.

    A variant names ``variant_id``, ``description``, ``kind`` (``svm``, ``nb`` or ``logreg``),
    ``size``, ``ngram_range``, and ``C`` or ``alpha``.  Columns: number, id, description, accuracy, macro F1, and F1 per category.  The most
    frequent terms are counted once per n-gram range, features and the known terms of the test rows are written once
    per range and size; linear variants of the same features share the passes of one path.
    """
    spark = train.sparkSession
    train, test = (df.withColumn(label, as_text(label)) for df in (train, test))
    stop_words = list(stop_words)
    stats: dict = {}
    feats: dict = {}
    test_counts: dict = {}
    paths: dict = {}
    result = []
    for no, v in enumerate(variants):
        rng, key = v["ngram_range"], (v["ngram_range"], v["size"])
        if rng not in stats:
            most = max(x["size"] for x in variants if x["ngram_range"] == rng)
            stats[rng] = stored(topk.top_terms(train, text, most, mode="train", stop_words=stop_words, ngram_range=rng), "stats")
        if key not in feats:
            feats[key] = build_features(train, doc, text, label, v["size"], rng, stop_words, stats=stats[rng])
        if v["kind"] == "nb":
            fitted = fit_naive_bayes(feats[key], label, v["alpha"])
        else:
            fitted = paths[no] if no in paths else _fit_group(feats[key], label, variants, key, paths)[no]
        few = fitted.params.n_terms <= HELD
        if key not in test_counts:
            test_counts[key] = stored(
                model_counts(test, fitted.params, doc, text, "train") if few
                else term_counts(test, doc, text, "train", stop_words, rng, keep_empty=True), "counts")
        scored = score(test, fitted.params, doc, text, "train", test_counts[key]) if few else score_counts(test_counts[key], fitted.params, doc)
        predicted = scored.select(doc, "predicted_label")
        pairs = stored(test.select(doc, label).join(predicted, doc), "pairs")
        rep = report(pairs, label, "predicted_label")
        f1 = {r["label"]: r["f1"] for r in category_f1(rep, list(categories)).collect()} if categories else {}
        result.append(
            (no, v["variant_id"], v["description"], accuracy(pairs, label, "predicted_label").first()[0],
             averages(rep).first()["macro_f1"], *[f1[c] for c in categories])
        )
    names = ", ".join(f"`{c}_f1` double" for c in categories)
    schema = "variant_no int, variant_id string, description string, accuracy double, macro_f1 double"
    return spark.createDataFrame(result, f"{schema}, {names}" if names else schema)


def summary_table(metrics: DataFrame) -> DataFrame:
    """The written form of :func:`run_variants`: percent texts and rounded F1 values."""
    from ..functions.text import percent
    from .evaluate import with_delta

    f1 = [c for c in metrics.columns if c.endswith("f1")]
    return with_delta(metrics, "variant_no", "accuracy").select(
        "variant_id", "description",
        percent("accuracy").alias("acc"), percent("delta", signed=True).alias("delta"),
        *[F.round(c, 4).alias(c) for c in f1],
    )
