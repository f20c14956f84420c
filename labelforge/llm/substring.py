"""Substring de-duplication with fixed-block anchors.

Blocks of ``b = (window + 1) // 2`` words at every ``b``-th position of each text are indexed, and
every rolling window of ``b`` words probes the index.  A run of ``window`` words that occurs twice
holds a whole indexed block of its twin, so both places are hit.  Hits are then extended: each
window of ``window`` words around a hit is looked up by its own hash, and those that start at two
places or more cover exactly the maximal repeats of that length.  Anchors are told apart by 48 bits
and their bucket, which can only add hits; the extensions, which decide, by all 64 bits.

Hashes are dealt to buckets, so nothing is gathered by text or passage: a bucket holds a fixed
number of hashes, whatever share of the texts has the same passage, and answers with positions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import arrow_map, deal, stored, tidied

#: Hashes of a bucket.
BUCKET = 1_000_000
_BYTES_PER_WORD = 6
_POSTING = "bucket int, slice long, hash binary, at binary, flag binary, rows binary, before binary"
_REPLY = "slice long, at binary, rows binary, before binary"


def _pack_sorted(at: np.ndarray) -> bytes:
    step = np.diff(at, prepend=0)
    return step.astype("<u2").tobytes() if step.max(initial=0) < 65536 else step.astype("<u4").tobytes()


def _unpack_sorted(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, "<u2" if len(packed) == 2 * n else "<u4"), dtype=np.int64)


def _emit(rows: np.ndarray, before: np.ndarray, hashes: np.ndarray, at: np.ndarray, flag: np.ndarray, buckets: int, wide: bool = False):
    """One record per bucket with the slice's hashes, ``wide`` ones whole, and one with the slice's rows."""
    with np.errstate(over="ignore"):
        name = int(W.mix(np.sum(W.mix(rows.view(np.uint64) + np.arange(len(rows), dtype=np.uint64)), keepdims=True)).view(np.int64)[0])
    out = [[name % buckets], [name], [None], [None], [None], [rows.tobytes()], [before.astype("<u4").tobytes()]]
    b = W.bucket_of(hashes, buckets)
    order = np.argsort(b.astype(np.uint16) if buckets <= 65536 else b, kind="stable")
    b, hashes, at, flag = b[order], hashes[order], at[order], flag[order]
    for i, m in zip(*W.runs(b)):
        s = slice(i, i + m)
        for o, v in zip(out, (int(b[i]), name, hashes[s].astype("<u8").tobytes() if wide else W.pack48(hashes[s]), _pack_sorted(at[s]), np.packbits(flag[s]).tobytes(), None, None)):
            o.append(v)
    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
    return pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds)], names=["bucket", "slice", "hash", "at", "flag", "rows", "before"])


def _answer(judge: Callable[[np.ndarray, np.ndarray], np.ndarray], wide: bool = False):
    """Bucket: positions of the hashes that ``judge(hashes, flags)`` marks; rows pass through."""
    def run(group: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(4)]
        names, hashes, ats, flags = [], [], [], []
        for name, h, at, flag, rows, before in zip(*(group.column(x).to_pylist() for x in ("slice", "hash", "at", "flag", "rows", "before"))):
            if h is None:
                for o, v in zip(out, (name, None, rows, before)):
                    o.append(v)
                continue
            h = np.frombuffer(h, "<u8") if wide else W.unpack48(h)
            names.append(name)
            hashes.append(h)
            ats.append(at)
            flags.append(np.unpackbits(np.frombuffer(flag, np.uint8), count=len(h)).astype(bool))
        if hashes:
            hit = judge(np.concatenate(hashes), np.concatenate(flags))
            end = np.cumsum([len(h) for h in hashes])
            for name, h, at, e in zip(names, hashes, ats, end):
                mine = hit[e - len(h) : e]
                if mine.any():
                    for o, v in zip(out, (name, _unpack_sorted(at, len(h))[mine].astype("<u4").tobytes(), None, None)):
                        o.append(v)
        return pa.table([pa.array(x, t) for x, t in zip(out, (pa.int64(), *[pa.binary()] * 3))], names=["slice", "at", "rows", "before"])
    return run


def _by_row(group: pa.Table) -> pa.Table:
    """Slice: per row the runs ``(start, length)`` of positions that were answered."""
    rows = next(x for x in group.column("rows").to_pylist() if x is not None)
    before = next(x for x in group.column("before").to_pylist() if x is not None)
    rows, before = np.frombuffer(rows, "<i8"), np.frombuffer(before, "<u4").astype(np.int64)
    at = [np.frombuffer(x, "<u4") for x in group.column("at").to_pylist() if x is not None]
    at = np.unique(np.concatenate(at)).astype(np.int64) if at else np.zeros(0, np.int64)
    owner = np.searchsorted(before, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    pairs = np.stack([at[first] - before[owner[first]], length], 1).astype("<u4")
    i, m = W.runs(owner[first])
    return pa.table([pa.array(rows[owner[first][i]], pa.int64()), pa.array([pairs[a : a + c].tobytes() for a, c in zip(i, m)], pa.binary())],
                    names=["row", "runs"])


def _ask(postings: DataFrame, buckets: int, judge, wide: bool = False) -> DataFrame:
    answers = deal(postings, buckets, "bucket").groupBy("bucket").applyInArrow(tidied(_answer(judge, wide)), _REPLY)
    runs = answers.groupBy("slice").applyInArrow(_by_row, "row long, runs binary")
    return runs.groupBy("row").agg(F.first("runs").alias("runs"))  # rows with the same id and text have the same runs


def _is_hit(hashes: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Windows equal to an indexed block other than themselves."""
    known, count = np.unique(hashes[block], return_counts=True)
    if not len(known):
        return np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return (known[at] == hashes) & (count[at] > block)


def _is_repeat(hashes: np.ndarray, _: np.ndarray) -> np.ndarray:
    _, back, count = np.unique(hashes, return_inverse=True, return_counts=True)
    return count[back] > 1


def _anchors(block: int, buckets: int):
    def run(batch):
        rows = batch.column("row").to_numpy()
        for row, data, offsets in W.text_slices(batch.column("text")):
            starts, ends, before = W.word_spans(data, offsets)
            hashes, at = W.windows(W.word_hashes(data, starts, ends, fold=False), before, block)
            owner = np.searchsorted(before, at, side="right") - 1
            yield _emit(rows[row : row + len(offsets) - 1], before, hashes, at, (at - before[owner]) % block == 0, buckets)
    return run


def _spread(runs: list[bytes | None], before: np.ndarray, more: int, less: int) -> np.ndarray:
    """Per word of the slice: inside ``[start - less, start + length + more)`` of a run."""
    mark = np.zeros(before[-1] + 1, np.int64)
    for i, r in enumerate(runs):
        if r:
            start, length = np.frombuffer(r, "<u4").reshape(-1, 2).astype(np.int64).T
            lo, hi = before[i], before[i + 1]
            np.add.at(mark, np.maximum(start + lo - less, lo), 1)
            np.add.at(mark, np.minimum(start + lo + length + more, hi), -1)
    return np.cumsum(mark)[:-1] > 0


def _extensions(window: int, block: int, buckets: int, text: str):
    def run(batch):
        rows, runs = batch.column("row").to_numpy(), batch.column("runs").to_pylist()
        payload = batch.column("payload")
        for row, data, offsets in W.text_slices(payload.field(text)):
            n = len(offsets) - 1
            starts, ends, before = W.word_spans(data, offsets)
            hashes, at = W.windows(W.word_hashes(data, starts, ends, fold=False), before, window)
            near = _spread(runs[row : row + n], before, 0, window - block)[at]
            hashes, at = hashes[near], at[near]
            yield _emit(rows[row : row + n], before, hashes, at, np.zeros(len(at), bool), buckets, wide=True)
    return run


def _cut(window: int):
    """Kept words, number of words and of removed words, from a text and its runs of repeated windows."""
    def run(text: pa.Array, runs: pa.Array) -> pa.Array:
        runs, kept, total, gone = runs.to_pylist(), [], [], []
        for row, data, offsets in W.text_slices(text):
            _, _, before = W.word_spans(data, offsets)
            drop = _spread(runs[row : row + len(offsets) - 1], before, window - 1, 0)
            raw = data.tobytes()
            for i in range(len(offsets) - 1):
                lo, hi = before[i], before[i + 1]
                parts = raw[offsets[i] : offsets[i + 1]].split()
                cut = drop[lo:hi]
                n = int(cut.sum())
                total.append(len(parts))
                gone.append(n)
                kept.append(b" ".join(parts if not n else [parts[j] for j in np.flatnonzero(~cut)]).decode("utf-8"))
        return pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                          names=["n_words", "n_removed", "kept"])
    return F.arrow_udf(run, "n_words long, n_removed long, kept string")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, bucket: int = BUCKET) -> DataFrame:
    """``(payload, n_words, n_removed, kept)``: ``payload`` is the input row, ``kept`` its words without repeats.

    A word goes if a run of ``window`` words around it also starts anywhere else, in the same row or
    another.  Null and empty texts have no words and keep an empty text.  Rows that repeat an id are
    judged like any others, so rows equal in id and text lose every word of a text that has
    ``window`` words or more.  Ids may be null.  All further columns are in ``payload``.
    """
    block = (window + 1) // 2
    all_docs = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.struct(*[docs[c] for c in docs.columns]).alias("payload"))
    text = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, -(-size // (_BYTES_PER_WORD * bucket)))
    hits = stored(_ask(arrow_map(text, _anchors(block, buckets), _POSTING), buckets, _is_hit), "hits")
    near = all_docs.join(hits, "row").select("row", "payload", "runs")
    repeats = _ask(arrow_map(near, _extensions(window, block, buckets, text_col), _POSTING), buckets, _is_repeat, wide=True)
    found = all_docs.join(repeats, "row", "left")
    return (found.withColumn("r", _cut(window)(F.col("payload").getField(text_col), "runs"))
            .select("payload", "r.n_words", "r.n_removed", "r.kept"))
