"""Exact de-duplication against history, with minimal perfect hashes.

The distinct digests of the historical rows are dealt to shards of bounded size.  Each shard gets a
minimal perfect hash whose slots hold the full digests and the locators of their winners.  New
digests look up their slot and compare all bytes: equal ones join the slot's group, the others form
groups of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import deal, stored

#: Digests of a shard.
SHARD = 32_768
_GAMMA = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = W.mix(words[:, level % 4] + W.mix(words[:, (level + 1) % 4] + np.uint64(level)))
    return (x % np.uint64(size)).astype(np.int64)


def build(digests: np.ndarray) -> tuple[list[bytes], list[int], np.ndarray]:
    """Bits and size of each level, and the slot of each of the distinct 32-byte ``digests``."""
    words = np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)
    slot, left, bits, sizes, used = np.zeros(len(words), np.int64), np.arange(len(words)), [], [], 0
    while len(left):
        size = max(64, _GAMMA * len(left))
        at = _place(words[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        placed = alone[at]
        slot[left[placed]] = used + (np.cumsum(alone) - 1)[at[placed]]
        bits.append(np.packbits(alone).tobytes())
        sizes.append(size)
        used, left = used + int(placed.sum()), left[~placed]
    return bits, sizes, slot


def lookup(bits: list[bytes], sizes: list[int], digests: np.ndarray) -> np.ndarray:
    """Slot of each digest; -1 where no level has a bit.  A digest that was not built in may get any slot."""
    words = np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)
    slot, left, used = np.full(len(words), -1), np.arange(len(words)), 0
    for level, (b, size) in enumerate(zip(bits, sizes)):
        on = np.unpackbits(np.frombuffer(b, np.uint8), count=size).astype(bool)
        at = _place(words[left], level, size)
        here = on[at]
        slot[left[here]] = used + (np.cumsum(on) - 1)[at[here]]
        used, left = used + int(on.sum()), left[~here]
    return slot


def _digests(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("digest").to_pylist()), np.uint8).reshape(-1, 32)


def _index(group: pa.Table) -> pa.Table:
    digests = _digests(group)
    bits, sizes, slot = build(digests)
    order = np.argsort(slot)
    return pa.table({
        "shard": group.column("shard")[:1], "bits": pa.array([bits], pa.list_(pa.binary())), "sizes": pa.array([sizes], pa.list_(pa.int64())),
        "digests": pa.array([digests[order].tobytes()], pa.binary()),
        "winners": pa.array([group.column("winner").take(order).to_pylist()], pa.list_(pa.int64())),
        "counts": pa.array([group.column("c").take(order).to_pylist()], pa.list_(pa.int64())),
    })


def _groups(new: pa.Table, index: pa.Table) -> pa.Table:
    digests = np.zeros((0, 32), np.uint8)
    winners, counts = [], []
    if len(index):
        digests = np.frombuffer(index.column("digests")[0].as_py(), np.uint8).reshape(-1, 32)
        winners, counts = index.column("winners")[0].as_py(), index.column("counts")[0].as_py()
    out = [[x.tobytes() for x in digests], winners, counts]
    if len(new):
        asked = _digests(new)
        slot = lookup(index.column("bits")[0].as_py(), index.column("sizes")[0].as_py(), asked) if len(index) else np.full(len(asked), -1)
        known = slot >= 0
        known[known] = (digests[slot[known]] == asked[known]).all(1)
        for i, (s, w, c) in enumerate(zip(slot.tolist(), new.column("winner").to_pylist(), new.column("c").to_pylist())):
            if known[i]:
                out[1][s] = w if out[1][s] is None else out[1][s] if w is None else max(w, out[1][s])
                out[2][s] += c
            else:
                for o, v in zip(out, (asked[i].tobytes(), w, c)):
                    o.append(v)
    several = [i for i, c in enumerate(out[2]) if c > 1]
    return pa.table([pa.array([o[i] for i in several], t) for o, t in zip(out, (pa.binary(), pa.int64(), pa.int64()))],
                    names=["digest", "keep", "size"])


def exact_dedup(docs: DataFrame, is_old: Column, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for each row, old and new.

    Texts are equal if identical after lower-casing A-Z; null counts as empty.  Of equal texts the
    row with the largest id stays.  ``is_old`` marks the historical rows, null meaning new.  Rows that
    repeat the winning id all stay.  A null id loses to any other; where a group has no other, all its
    rows stay.  Further columns are ignored.
    """
    norm = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(norm, 256)).alias("digest"),
                              F.coalesce(is_old, F.lit(False)).alias("old")), "digests")
    by_age = {r["old"]: r["count"] for r in rows.groupBy("old").count().collect()}
    shards = max(1, -(-max(by_age.values(), default=1) // shard))
    distinct = (rows.groupBy("old", "digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("c"))
                .withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards))))
    index = stored(deal(distinct.where("old"), shards, "shard").groupBy("shard").applyInArrow(
        _index, "shard long, bits array<binary>, sizes array<long>, digests binary, winners array<long>, counts array<long>"), "index")
    new = deal(distinct.where("not old"), shards, "shard").groupBy("shard")
    groups = stored(new.cogroup(deal(index, shards, "shard").groupBy("shard")).applyInArrow(
        _groups, "digest binary, keep long, size long"), "groups")
    found = rows.join(groups, "digest", "left")
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
