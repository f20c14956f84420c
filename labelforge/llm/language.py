"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of up to ``ORDER`` bytes holds how often each byte followed.  In a
context that is known, a byte that was seen there costs ``-log2 c / (n + d)`` bits, where ``n`` is the context's
count and ``d`` the number of its different bytes; any other byte escapes with ``d / (n + d)`` to the context that
is one byte shorter, whose probabilities are scaled to the bytes that are still possible.  Below the
empty context all bytes are alike.  So the probabilities of a context add up to one, and a text's
cost is the length of its exact code.  The statistics are frozen: scoring does not change them.

The trees of all languages are one sorted table of byte strings per order with a column of bits for each
language.  Equal windows of a slice of texts are priced once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import signed, stored

#: Bytes of the longest context; rows learned from, shared by the languages, and the most bytes of such a row;
#: languages, the most frequent ones.
ORDER, SAMPLE, LONGEST, LANGUAGES = 4, 1_600, 65_536, 256
SLICE = 1_000_000
U64 = np.uint64
UNKNOWN = "und"


def _windows(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Each byte with the ``order`` bytes before it, packed; before a text stand line feeds."""
    n = len(offsets) - 1
    padded = np.full(len(data) + n * order, 10, np.uint8)
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1) * order, np.diff(offsets))
    padded[at] = data
    out = np.zeros(len(data), U64)
    for back in range(order, -1, -1):
        out = (out << U64(8)) | padded[at - back]
    return out


def _counted(order: int):
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for row, data, offsets in W.text_slices(batch.column("text"), SLICE):
                windows, here = _windows(data, offsets, order), langs[row : row + len(offsets) - 1]
                for lang in set(here):
                    grams, n = np.unique(windows[np.repeat(here == lang, np.diff(offsets))], return_counts=True)
                    yield pa.record_batch([pa.array([lang] * len(grams), pa.string()), signed(grams), pa.array(n, pa.int64())], names=["lang", "gram", "n"])
    return run


@dataclass
class Model:
    """Per order ``k`` the known strings of ``k`` bytes with two columns for each language: the bits of the last
    byte after the others, and the bits of the escapes from the whole string down to the empty context."""

    langs: list[str]
    order: int
    keys: list[np.ndarray]
    bits: list[np.ndarray]
    escapes: list[np.ndarray]

    def find(self, k: int, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys[k]
        if not len(keys):
            return np.zeros(len(strings), np.int64), np.zeros(len(strings), bool)
        at = np.minimum(np.searchsorted(keys, strings), len(keys) - 1)
        return at, keys[at] == strings

    def prices(self, windows: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each window, one column per language.

        The longest known suffix of the window gives the bits from its own context downwards; the escapes
        from the longest known context to that one are added.
        """
        out = np.full((len(windows), len(self.langs)), 8.0)
        todo = np.arange(len(windows))
        for k in range(self.order + 1, 0, -1):
            strings = _last(windows[todo], k)
            at, known = self.find(k, strings)
            out[todo[known]] = self.bits[k][at[known]] - self._escaped(k - 1, _front(strings[known]))
            todo = todo[~known]
        todo = np.arange(len(windows))
        for k in range(self.order, -1, -1):
            strings = _last(_front(windows[todo]), k)
            at, known = self.find(k, strings)
            out[todo[known]] += self.escapes[k][at[known]]
            todo = todo[~known]
        return out

    def _escaped(self, k: int, contexts: np.ndarray) -> np.ndarray:
        at, known = self.find(k, contexts)
        return self.escapes[k][at] * known[:, None]


def _last(strings: np.ndarray, k: int) -> np.ndarray:
    return strings & U64((1 << (8 * k)) - 1)


def _front(strings: np.ndarray) -> np.ndarray:
    return strings >> U64(8)


def train(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> Model:
    """The trees from each language's packed windows of ``order + 1`` bytes and their counts."""
    keys: list[np.ndarray] = [np.zeros(1, U64)]
    for k in range(1, order + 2):
        strings = [_last(grams, k) for grams, _ in counts]
        if k <= order:  # a context may end a text, but it is known only with a byte after it
            strings += [_last(_front(grams), k) for grams, _ in counts]
        keys.append(np.unique(np.concatenate(strings)) if strings else np.zeros(0, U64))
    blank = [np.full((len(x), len(langs)), np.nan, np.float32) for x in keys]
    model = Model(langs, order, keys, blank, [x.copy() for x in blank])
    for i, (grams, n) in enumerate(counts):
        _fit(model, i, grams, n)
        _fill(model, i)
    return model


def _fit(model: Model, i: int, grams: np.ndarray, n: np.ndarray) -> None:
    """Bits and escapes of one language's own strings, from the empty context up."""
    shorter = lower = np.zeros(0)
    for k in range(1, model.order + 2):
        strings, back = np.unique(_last(grams, k), return_inverse=True)
        count = np.bincount(back, n, len(strings))
        contexts, owner = np.unique(_front(strings), return_inverse=True)
        total, different = np.bincount(owner, count, len(contexts)), np.bincount(owner, minlength=len(contexts))
        # What one byte less of context gives the bytes seen here; after an escape they are no longer possible.
        if k == 1:
            below, before = np.full(len(strings), 1 / 256), np.zeros(len(contexts))
        else:
            below = shorter[1][np.searchsorted(shorter[0], _last(strings, k - 1))]
            before = lower[1][np.searchsorted(lower[0], _last(contexts, k - 2))]
        full = different == 256
        every = total + np.where(full, 0, different)
        left = np.maximum(1 - np.bincount(owner, below, len(contexts)), 1e-12)
        here = before - np.log2(np.where(full, 1, different / every / left))
        chance = count / every[owner]
        model.bits[k][model.find(k, strings)[0], i] = -np.log2(chance)
        model.escapes[k - 1][model.find(k - 1, contexts)[0], i] = here
        shorter, lower = (strings, chance), (contexts, here)


def _fill(model: Model, i: int) -> None:
    """The same for strings that other languages know: an unknown context escapes free of charge."""
    bits, escapes = model.bits, model.escapes
    escapes[0][:, i] = np.nan_to_num(escapes[0][:, i])
    for k in range(1, model.order + 1):
        new = np.isnan(escapes[k][:, i])
        escapes[k][new, i] = escapes[k - 1][model.find(k - 1, _last(model.keys[k][new], k - 1))[0], i]
    for k in range(1, model.order + 2):
        new = np.isnan(bits[k][:, i])
        strings = model.keys[k][new]
        here = escapes[k - 1][model.find(k - 1, _front(strings))[0], i]
        if k == 1:
            bits[k][new, i] = 8 + here
        else:
            below = escapes[k - 2][model.find(k - 2, _last(_front(strings), k - 2))[0], i]
            bits[k][new, i] = bits[k - 1][model.find(k - 1, _last(strings, k - 1))[0], i] + here - below


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
          sample: int = SAMPLE, longest: int = LONGEST, languages: int = LANGUAGES) -> Model:
    """Trees from rows with a text and a language whose ``crc32(id) mod 5`` is not 0.

    They are the ``sample // languages present`` rows of each language with the least digests of id and text, of
    at most ``longest`` bytes; rows equal in id, text and language count once.
    """
    known = docs.where(F.col(lang_col).isNotNull() & (F.octet_length(text_col).between(1, longest))).where(~held_out(F.col(id_col)))
    known = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("digest"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("digest").alias("kinds"))
    frequent = sorted((r.lang, r.kinds) for r in sizes.orderBy(F.desc("n"), "lang").limit(languages).collect())
    langs = [lang for lang, _ in frequent]
    if not langs:
        return train([], [], order)
    quota = max(1, sample // len(langs))
    # Digests are spread evenly, so the first of a language lie below a bound that only some times the quota reach.
    bounds = [(lang, min(2**63 - 1, 8 * (quota + 50) * 2**64 // max(1, kinds) - 2**63)) for lang, kinds in frequent]
    bounds = known.sparkSession.createDataFrame(bounds, "lang string, bound long")
    nth = F.expr("row_number() OVER (PARTITION BY lang ORDER BY digest)")
    low = known.select("lang", "digest").join(F.broadcast(bounds), "lang").where("digest <= bound").groupBy("lang", "digest").agg(F.lit(1).alias("one"))
    first = low.withColumn("nth", nth).where(F.col("nth") <= quota)
    last = stored(first.groupBy("lang").agg(F.max("digest").alias("last")), "languages")
    chosen = known.join(F.broadcast(last), "lang").where("digest <= last").groupBy("lang", "digest").agg(F.first("text").alias("text"))
    counts = chosen.select("lang", "text").mapInArrow(_counted(order), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    of, grams, n = np.array(counts.column("lang").to_pylist(), object), counts.column("gram").to_numpy().view(U64), counts.column("n").to_numpy()
    return train(langs, [(grams[of == x], n[of == x]) for x in langs], order)


def code_lengths(model: Model, texts: pa.Array) -> np.ndarray:
    """Bits of each text, one column per language."""
    out = np.zeros((len(texts), len(model.langs)))
    for row, data, offsets in W.text_slices(texts, SLICE):
        owner, total = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)), np.zeros((len(offsets) - 1, len(model.langs)))
        for at in range(0, len(data), SLICE):  # a long text comes alone; its windows reach back over the cut
            reach = min(at, model.order) if len(offsets) == 2 else 0
            part = data[at - reach : at + SLICE]
            windows = _windows(part, np.array([0, len(part)]) if at else np.minimum(offsets, len(part)), model.order)[reach:]
            strings, back = np.unique(windows, return_inverse=True)
            prices = model.prices(strings)
            for i in range(len(model.langs)):
                total[:, i] += np.bincount(owner[at : at + SLICE], prices[back, i], len(total))
        out[row : row + len(total)] = total
    return out


def language(model: Model, text: Column) -> Column:
    """``struct(lang_pred, score)``: the language of the shortest code, the least of equals, and its share of ``2 ** -bits``."""
    def run(texts: pa.Array) -> pa.Array:
        bits = code_lengths(model, texts)
        best = bits.argmin(1)
        share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
        return pa.StructArray.from_arrays([pa.array([model.langs[i] for i in best], pa.string()), pa.array(share)], names=["lang_pred", "score"])

    nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if not model.langs:
        return nothing
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), F.arrow_udf(run, "lang_pred string, score double")(text)).otherwise(nothing)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, which replace columns of these names.

    A null text, and one without a letter, is ``und`` with score 0, and so is every text if nothing was learned.
    Only the text decides: repeated rows get the same answer, a null id is never held out.  Further
    columns stay.  An empty table gives no rows.
    """
    model = learn(docs, id_col, text_col, lang_col, **options)
    out = docs.withColumn("held_out", held_out(docs[id_col])).withColumn("lang_pred", language(model, F.col(text_col)))
    return out.withColumn("score", F.col("lang_pred.score")).withColumn("lang_pred", F.col("lang_pred.lang_pred"))
