"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

Texts longer than a window give full windows and a rest, which is cut into short pieces.  These are
dealt at random to groups that fill a fixed number of windows.  In a group every piece starts as a partition of its own into
``k`` windows; the two partitions with the largest imbalance are merged again and again, the
fullest windows of one with the emptiest of the other, until one is left.  If a window exceeds the
capacity, the group is packed again with one window more.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import deal, stored, tidied, tidy
from .bpe import encoder

#: Windows of a group, and the longest piece of a rest.
WINDOWS, PIECE = 256, 1024
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, nr long"
_ALONE = 1 << 62


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Items of each of ``k`` windows.

    A partition is its non-empty windows ``(sum, nr, items)``, the fullest first; items are a tree of
    pairs, so that joining two windows costs the same at every size.
    """
    heap = [(-size, i, [(size, i, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    nr = len(sizes)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        meet = len(a) + len(b) - k
        if meet > 0:  # the emptiest of the fuller partition take the fullest ones that are left of the other
            whole = a[: len(a) - meet] + b[: len(b) - meet]
            for x, y in zip(a[len(a) - meet :], reversed(b[len(b) - meet :])):
                whole.append((x[0] + y[0], nr, (x[2], y[2])))
                nr += 1
        else:
            whole = a + b
        whole.sort(key=lambda w: (-w[0], w[1]))
        low = whole[-1][0] if len(whole) == k else 0
        heapq.heappush(heap, (low - whole[0][0], i, whole))
    out = []
    for _, _, tree in heap[0][2] if heap else ():
        items, todo = [], [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            else:
                items.append(x)
        out.append(items)
    return out


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``, as few as differencing finds."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        packed = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in packed):
            return packed
        k += 1


def _pieces(path: str, end: int, capacity: int, piece: int):
    def run(batches):
        e, tail, part, nr = encoder(path), np.array([end], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for row, data, offsets in W.text_slices(batch.column("text")):
                raw, out = data.tobytes(), []
                for i in range(len(offsets) - 1):
                    ids = e.encode(raw[offsets[i] : offsets[i + 1]]) + tail
                    n = len(ids) // 4
                    full = n - n % capacity
                    for start in (*range(0, full, capacity), *range(full, n, piece)):
                        cut = ids[4 * start : 4 * (start + (capacity if start < full else piece))]
                        out.append((keys[row + i], start, len(cut) // 4, zlib.crc32(cut), n, (part << 36) + nr))
                        nr += 1
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out)],
                                      names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nr"])
        e.forget()
        tidy()
    return run


def _pack(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("nr")
        sizes = group.column("length").to_pylist()
        order, sequence, offset = [], [], []
        base = group.column("g")[0].as_py() << 24
        for s, items in enumerate(windows(sizes, capacity)):
            at = 0
            for i in items:
                order.append(i)
                sequence.append(base + s)
                offset.append(at)
                at += sizes[i]
        out = group.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).take(pa.array(order, pa.int64()))
        return out.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))
    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end: int = 2,
         windows_per_group: int = WINDOWS, piece: int = PIECE) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A text's ids are followed by ``end``, so null and empty texts are one piece of one token.  A text is
    cut into full windows, and what is left into pieces of at most ``piece``.  Repeated rows and rows without an id are packed like
    others.  An empty table gives no pieces.  Further columns are ignored.
    """
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = stored(text.mapInArrow(_pieces(path, end, capacity, min(piece, capacity)), _PIECES), "pieces")
    rests = pieces.where(F.col("length") < capacity)
    groups = max(1, round((rests.agg(F.sum("length")).first()[0] or 0) / (capacity * windows_per_group)))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    packed = deal(rests.withColumn("g", F.pmod(F.xxhash64("nr"), F.lit(groups))), groups, "g").groupBy("g").applyInArrow(
        tidied(_pack(capacity)), _PIECES.replace("nr long", "sequence_id long, offset long"))
    full = pieces.where(F.col("length") == capacity).select(*cols, (F.col("nr") + _ALONE).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
