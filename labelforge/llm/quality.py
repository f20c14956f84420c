"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled rows are sampled up to a stated number.  A first net tells
positives from unlabelled rows; the least ratio of the unlabelled to the positive tail of its scores
on rows that it has not seen estimates the class prior.  A second net minimises the non-negative unbiased
risk ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``; negatives are never used.
Features are shares of bytes, words and repeats over the whole text, counted in numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import tidy

#: Rows of each kind that are sampled for training, and the steps of the two nets.
SAMPLE, STEPS, HIDDEN = 20_000, 600, 24
#: Parts of the training rows, each scored by a net of the others.
FOLDS = 3
FEATURES = 24


def _class(chars: str | bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode() if isinstance(chars, str) else chars)] = True
    return out


_UPPER, _LOWER, _DIGIT = _class(bytes(range(65, 91))), _class(bytes(range(97, 123))), _class("0123456789")
_HIGH, _SPACE = _class(bytes(range(128, 256))), _class("\t\n\v\f\r ")
_CONT = _class(bytes(range(128, 192)))
_MARKS = [_class(x) for x in (".", ",", "!?", "|", "#$%&*@^~", "<>{}[]\\/=+_", "\n", "-:;'\"()")]


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text; null and empty texts give zeros."""
    out = np.zeros((len(column), FEATURES), np.float64)
    for row, data, offsets in W.text_slices(column, 500_000):
        n = len(offsets) - 1
        def share(mask, offsets=offsets):
            total = np.concatenate([[0], np.cumsum(mask)])
            return total[offsets[1:]] - total[offsets[:-1]]
        starts, ends, before = W.word_spans(data, offsets)
        words = np.diff(before)
        owner = np.repeat(np.arange(n), words)
        hashes = W.word_hashes(data, starts, ends, fold=False)
        chars = share(~_CONT[data])
        upper, lower, high = _UPPER[data], _LOWER[data], _HIGH[data]
        letters = share(upper) + share(lower) + share(high & ~_CONT[data])
        w, c, l = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(letters, 1)
        by_row = lambda x, owner=owner, n=n: np.bincount(owner, x, n)
        size = (ends - starts).astype(float)
        mean = by_row(size) / w
        spread = np.sqrt(np.maximum(by_row(size * size) / w - mean**2, 0))
        def distinct(h, o, n=n):
            order = np.lexsort((h, o))
            h, o = h[order], o[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
            first = np.flatnonzero(new)
            most = np.zeros(n)
            np.maximum.at(most, o[first], np.diff(np.append(first, len(h))))
            return np.bincount(o[first], minlength=n), most
        kinds, most = distinct(hashes, owner)
        pairs, at = W.windows(hashes, before, 2)
        pair_owner = np.searchsorted(before, at, side="right") - 1
        pair_kinds, _ = distinct(pairs, pair_owner)
        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        cum = lambda m: np.concatenate([[0], np.cumsum(m)])
        lows, ups, any_letter = cum(lower), cum(upper), cum(upper | lower | high)
        shouted = (lows[ends] == lows[starts]) & (ups[ends] - ups[starts] > 1)
        bare = any_letter[ends] == any_letter[starts]
        ending = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        full = np.log1p(words)
        out[row : row + n] = np.stack([
            full, mean / 10, spread / 5, kinds / w, np.where(words > 1, pair_kinds / np.maximum(words - 1, 1), 1.0), most / w,
            by_row(same) / w, share(upper) / l, share(_DIGIT[data]) / c, share(high) / np.maximum(np.diff(offsets), 1),
            *[share(m[data]) / w for m in _MARKS], by_row(shouted) / w, by_row(bare) / w,
            by_row(np.isin(ending, list(b".!?"))) / w, kinds / np.maximum(w, 1) ** 0.8, by_row(size <= 3) / w, (words == 0).astype(float),
        ], 1)
    tidy()
    return out


class Net:
    """One hidden layer, trained by Adam from a fixed seed."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.sd = x.mean(0), x.std(0) + 1e-6
        d = x.shape[1]
        self.p = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self.m, self.v, self.t = [np.zeros_like(x) for x in self.p], [np.zeros_like(x) for x in self.p], 0

    def _hidden(self, x):
        x = np.clip((x - self.mean) / self.sd, -8, 8)
        return x, np.tanh(x @ self.p[0] + self.p[1])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self._hidden(x)[1] @ self.p[2] + self.p[3][0]

    def step(self, x: np.ndarray, slope, rate: float = 0.01, decay: float = 1e-4) -> None:
        """One step, where ``slope(margin)`` is the derivative of the loss by each margin."""
        x, h = self._hidden(x)
        g = slope(h @ self.p[2] + self.p[3][0])
        back = np.outer(g, self.p[2]) * (1 - h * h)
        grads = [x.T @ back + decay * self.p[0], back.sum(0), h.T @ g + decay * self.p[2], np.array([g.sum()])]
        self.t += 1
        for p, m, v, d in zip(self.p, self.m, self.v, grads):
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            p -= rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled rows, from the scores of a positive-against-unlabelled net."""
    best, n, m = 1.0, len(positive), len(unlabelled)
    slack = np.sqrt(np.log(20) / (2 * m)) + np.sqrt(np.log(20) / (2 * n))
    bound = np.inf
    for cut in np.unique(np.quantile(positive, np.linspace(0, 0.95, 96))):
        p, u = (positive >= cut).mean(), (unlabelled >= cut).mean()
        if p > 0 and (u + slack) / p < bound:
            bound, best = (u + slack) / p, u / p
    return float(np.clip(best, 0.01, 0.99))


def _set_aside(positive: np.ndarray, unlabelled: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores of all rows by nets that tell positives from unlabelled rows, none of which has seen the row itself.

    A fold without positives or unlabelled rows to learn from learns from all there are.
    """
    out = [np.zeros(len(positive)), np.zeros(len(unlabelled))]
    folds = [np.arange(len(x)) % FOLDS for x in (positive, unlabelled)]
    for fold in range(FOLDS):
        p, u = (x[f != fold] if (f != fold).any() else x for x, f in zip((positive, unlabelled), folds))
        x, y = np.concatenate([p, u]), np.concatenate([np.ones(len(p)), np.zeros(len(u))])
        net, weight = Net(x), np.where(y == 1, 0.5 / len(p), 0.5 / len(u))
        for _ in range(steps):
            net.step(x, lambda z, weight=weight, y=y: weight * (_sigmoid(z) - y))
        for o, rows, f in zip(out, (positive, unlabelled), folds):
            o[f == fold] = net.margin(rows[f == fold])
    return out[0], out[1]


def train(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS) -> tuple[Net, float]:
    """The net of least non-negative risk, and the estimated prior."""
    both = np.concatenate([positive, unlabelled])
    n, m = len(positive), len(unlabelled)
    prior = class_prior(*_set_aside(positive, unlabelled, steps // 2))
    net = Net(both)
    is_p = np.concatenate([np.ones(n, bool), np.zeros(m, bool)])

    def slope(z):
        s, loss = _sigmoid(z), np.logaddexp(0, z)
        g = np.zeros(len(z))
        if loss[~is_p].mean() - prior * loss[is_p].mean() >= 0:
            g[is_p] = prior * (s[is_p] - 1) / n - prior * s[is_p] / n
            g[~is_p] = s[~is_p] / m
        else:  # the risk of the negatives fell below zero: only undo that
            g[is_p], g[~is_p] = prior * s[is_p] / n, -s[~is_p] / m
        return g

    for i in range(steps):
        net.step(both, slope, 0.01 if i < steps * 2 // 3 else 0.002)
    return net, prior


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, ids: DataFrame, most: int) -> np.ndarray:
    """Features of the documents with the ``most`` least digests among ``ids``."""
    few = ids.distinct().orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(most)
    rows = docs.join(F.broadcast(few), "doc_id", "left_semi").select("doc_id", "text")

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), pa.array(list(features(b.column("text"))), pa.list_(pa.float64()))], names=["doc_id", "x"])

    got = rows.mapInArrow(run, "doc_id long, x array<double>").collect()
    got.sort(key=lambda r: (r[0], r[1]))
    return np.array([r[1] for r in got]).reshape(-1, FEATURES)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   sample: int = SAMPLE) -> Column:
    """A column of scores from 0 to 1 for ``text_col`` of ``docs``, fitted to the positives of ``labels``.

    Labels of rows with ``crc32(id) mod 5 = 0`` are not read.  At most ``sample`` positives and as many
    unlabelled rows are used, chosen by a digest of the id.  Null and empty texts get a score too.
    Null labels and labels without a document are ignored.  Without positives every score is 0.5.
    """
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("doc_id"))
    known = known.where(~held_out(F.col("doc_id"))).join(text.select("doc_id"), "doc_id", "left_semi")
    positive = _sample(text, known, sample)
    unlabelled = _sample(text, text.select("doc_id").where("doc_id is not null").where(~held_out(F.col("doc_id"))), sample)
    if not len(positive) or not len(unlabelled):
        return F.lit(0.5)
    net, _ = train(positive, unlabelled)
    return F.arrow_udf(lambda t: pa.array(_sigmoid(net.margin(features(t)))), "double")(F.col(text_col))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``, which replace columns of these names."""
    score = quality_scores(docs, labels, id_col, **options)
    out = docs.withColumn("held_out", held_out(docs[id_col])).withColumn("score", score)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
