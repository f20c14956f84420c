"""Substrings that may be among given texts, found by rolling hashes against a Bloom filter of bounded size.

Texts are compared as bytes: in UTF-8 one text lies inside another exactly if its bytes do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binding import cuts

#: Bits of the filter for a key, its 64-bit words at most, and the parts that it is made in.
BITS, WORDS, PARTS = 16, 1 << 22, 256
#: Bytes of text that are hashed together.
BYTES = 1_000_000

_BASE, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Hashes:
    """Hashes of substrings of a part of a column, from sums of its bytes times powers."""

    def __init__(self, texts: pa.Array):
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        self.bytes = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
        self.ends = (ends - ends[0]).astype(np.int64)
        n = len(self.bytes)
        powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE))])
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * powers[:n])])
        self.back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _INVERSE))])

    def of(self, at: np.ndarray, length: np.ndarray | int, whole: bool) -> np.ndarray:
        """Keys of the substrings of ``length`` bytes at the places ``at``; whole texts and openings have different ones."""
        h = (self.sums[at + length] - self.sums[at]) * self.back[at]
        h = h + np.atleast_1d(2 * length + whole).astype(np.uint64) * _BASE
        h = (h ^ (h >> np.uint64(30))) * _MIX1
        h = (h ^ (h >> np.uint64(27))) * _MIX2
        return h ^ (h >> np.uint64(31))

    def cut(self, at: np.ndarray, n: int) -> pa.Array:
        """The substrings of ``n`` bytes at the places ``at``."""
        data = self.bytes[(at[:, None] + np.arange(n)).reshape(-1)]
        ends = np.arange(len(at) + 1, dtype=np.int32) * np.int32(n)
        return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _parts(batch: pa.RecordBatch) -> Iterator[pa.Array]:
    texts = pc.fill_null(batch.column(0), "")
    for lo, hi in cuts(np.cumsum([0, *pc.binary_length(texts).to_numpy(zero_copy_only=False)]), BYTES):
        yield texts.slice(lo, hi - lo)


def _place(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of each key, by its upper bits, and the three bits there, by its lower ones."""
    one, six = np.uint64(1), np.uint64(63)
    bits = (one << (keys & six)) | (one << ((keys >> np.uint64(6)) & six)) | (one << ((keys >> np.uint64(12)) & six))
    return (keys >> np.uint64(64 - words.bit_length() + 1)).astype(np.int64), bits


def bloom(texts: DataFrame, steps: Sequence[int], keys: int) -> np.ndarray:
    """Words of a filter of all texts and of their openings of as many bytes as each of ``steps`` that they reach.

    A part of the filter is made where its keys meet; the driver holds 32 MB at most.
    """
    words = min(WORDS, max(PARTS, 1 << (keys * BITS // 64).bit_length()))
    own = words // PARTS

    def hashed(batches):
        for batch in batches:
            for part in _parts(batch):
                hashes = Hashes(part)
                at, length = hashes.ends[:-1], np.diff(hashes.ends)
                found = [hashes.of(at, length, True), *(hashes.of(at[length >= p], p, False) for p in steps)]
                key = np.unique(np.concatenate(found))
                yield pa.record_batch({"part": pa.array((key >> np.uint64(56)).astype(np.int32)), "key": pa.array(key.view(np.int64))})

    def made(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            word, bits = _place(batch.column("key").to_numpy().view(np.uint64), words)
            name = batch.column("part").to_numpy()
            for p in np.unique(name):
                mine = name == p
                np.bitwise_or.at(held.setdefault(int(p), np.zeros(own, np.uint64)), word[mine] % own, bits[mine])
        if held:
            yield pa.record_batch({"part": pa.array([*held], pa.int32()), "bits": pa.array([x.tobytes() for x in held.values()], pa.binary())})

    keyed = texts.mapInArrow(hashed, "part int, key long").repartition("part")
    out = np.zeros((PARTS, own), np.uint64)
    for row in keyed.mapInArrow(made, "part int, bits binary").collect():
        out[row.part] = np.frombuffer(row.bits, np.uint64)
    return out.reshape(-1)


def likely_substrings(hosts: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """Substrings of the only column of ``hosts`` that may be a text of ``wanted``, whose texts have ``least`` bytes or more.

    None that is one is left out; few others are among them.  A place in a host goes on to longer openings
    only while the filter has its opening of ``least``, twice as many, four times as many bytes, and only there
    the lengths up to the next step are tried.  Nothing but the substrings moves.
    """
    name = hosts.columns[0]
    sizes = {r[0]: r[1] for r in wanted.groupBy(F.octet_length(wanted.columns[0])).count().where("count > 0").collect() if r[0] is not None}
    steps, most = [least], max(sizes, default=0)
    while max(1, 2 * steps[-1]) <= most:
        steps.append(max(1, 2 * steps[-1]))
    words = bloom(wanted, steps, sum(n * (1 + sum(size >= p for p in steps)) for size, n in sizes.items()))
    shared = hosts.sparkSession.sparkContext.broadcast(words)
    groups = [(p, sorted(s for s in sizes if p <= s < q)) for p, q in zip(steps, [*steps[1:], most + 1])]

    def run(batches):
        words = shared.value

        def has(keys: np.ndarray) -> np.ndarray:
            word, bits = _place(keys, len(words))
            return (words[word] & bits) == bits

        for batch in batches:
            for part in _parts(batch):
                hashes = Hashes(part)
                at = np.arange(len(hashes.bytes))
                room = np.repeat(hashes.ends[1:], np.diff(hashes.ends)) - at
                for p, lengths in groups:
                    at, room = at[room >= p], room[room >= p]
                    kept = has(hashes.of(at, p, False))
                    at, room = at[kept], room[kept]
                    if not len(at):
                        break
                    for n in lengths:
                        starts = at[room >= n]
                        starts = starts[has(hashes.of(starts, n, True))]
                        step = max(1, BYTES // max(1, n))
                        for lo in range(0, len(starts), step):
                            # Equal substrings go once.
                            yield pa.record_batch([hashes.cut(starts[lo : lo + step], n).unique()], names=[name])

    return hosts.mapInArrow(run, f"`{name}` string")
