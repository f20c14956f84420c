"""Terms of rows counted in Arrow batches: a few rows at a time, by numbers that stand for their words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.binding import cuts
from ..functions.tokens import WORD_PATTERNS
from .substrings import Hashes

#: Bytes of text, and words, that are looked at together; what a task holds besides its batch goes by it.
BYTES, WORDS = 1_000_000, 200_000

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def lowered(text: Column | str) -> Column:
    """What :func:`word_lists` reads."""
    return F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def word_lists(texts: pa.Array, mode: str) -> Iterator[tuple[int, pa.ListArray]]:
    """``(first row, lists)``: the words of lowered texts as :func:`~labelforge.functions.tokens.tokens` finds them, by ranges of rows.

    A word is what stands between characters of other classes, if it has the pattern's least length.
    """
    letters, _, length = WORD_PATTERNS[mode].removeprefix("[").partition("]")
    least = 1 if length == "+" else int(length.strip("{,}"))
    ends = np.cumsum([0, *pc.binary_length(texts).to_numpy(zero_copy_only=False)])
    for lo, hi in cuts(ends, BYTES):
        words = _words(texts.slice(lo, hi - lo), letters, least)
        for first, last in cuts(words.offsets.to_numpy(), WORDS):
            yield lo + first, words.slice(first, last - first)


def _words(texts: pa.Array, letters: str, least: int) -> pa.ListArray:
    """Runs of at least ``least`` characters of each text that are in the class ``letters``, found by their bytes."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data, ends = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8), ends - ends[0]
    inside = np.append(_in_class(tuple(map(chr, range(128))), letters), np.zeros(128, bool))[data]
    # Characters of several bytes, each as one number; a part has few different ones.
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        byte = [np.where(size > k, data[np.minimum(lead + k, len(data) - 1)], 0).astype(np.int64) for k in range(4)]
        code, which = np.unique((byte[0] << 24) | (byte[1] << 16) | (byte[2] << 8) | byte[3], return_inverse=True)
        known = _in_class(tuple(int(c).to_bytes(4, "big").rstrip(b"\0").decode("utf-8", "replace") for c in code), letters)[which]
        for k in range(4):
            inside[lead[known & (size > k)] + k] = True
    # A word starts where the byte before is outside or in another row, and ends likewise.
    full = np.diff(ends) > 0
    start, last = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    for mark, edge in ((start, ends[:-1][full]), (last, ends[1:][full] - 1)):
        mark[edge] = inside[edge]
    start = np.flatnonzero(start)
    offsets = np.append(0, np.cumsum(np.flatnonzero(last) + 1 - start)).astype(np.int32)
    flat = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    first = np.searchsorted(start, ends)
    if least > 1:
        long = pc.greater_equal(pc.utf8_length(flat), least)
        flat, first = flat.filter(long), np.append(0, np.cumsum(long.to_numpy(zero_copy_only=False)))[first]
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), flat)


@lru_cache(maxsize=64)
def _in_class(chars: tuple[str, ...], letters: str) -> np.ndarray:
    return pc.match_substring_regex(pa.array(chars, pa.string()), f"^[{letters}]").to_numpy(zero_copy_only=False)


def _coded(words: pa.ListArray, lo: int, hi: int, stop_words: pa.Array | None) -> Iterator[tuple[np.ndarray, list[np.ndarray], pa.Array]]:
    """``(row, numbers of the words, words)`` of the runs of ``lo`` to ``hi`` words, by length of run."""
    flat, rows = words.flatten(), np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
    if stop_words is not None and len(stop_words):
        kept = pc.invert(pc.is_in(flat, stop_words))
        flat, rows = flat.filter(kept), rows[kept.to_numpy(zero_copy_only=False)]
    coded = flat.dictionary_encode()
    code, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    for n in range(lo, hi + 1):
        last = len(code) - n + 1
        if last <= 0:
            break
        inside = rows[:last] == rows[n - 1 :]
        yield rows[:last][inside], [code[i : i + last][inside] for i in range(n)], names


def row_terms(words: pa.ListArray, lo: int, hi: int, stop_words: pa.Array | None = None) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """``(row, term, n)`` of the runs of ``lo`` to ``hi`` words of each row, by length of run; stop words are taken out first."""
    for at, parts, names in _coded(words, lo, hi, stop_words):
        base = max(1, len(names))
        if base ** len(parts) * len(words) < 2**62:
            yield _by_number(at, parts, names, base)
        else:
            yield _by_name(at, parts, names)


def _buckets(parts: list[np.ndarray], names: pa.Array, buckets: int) -> np.ndarray:
    """The bucket of each run, by its words; ``buckets`` is a power of two."""
    hashes = Hashes(names)
    word = hashes.of(hashes.ends[:-1], np.diff(hashes.ends), True)
    key = word[parts[0]]
    for part in parts[1:]:
        key = key * _BASE + word[part]
    return (((key ^ (key >> np.uint64(32))) * _MIX) >> np.uint64(65 - buckets.bit_length())).astype(np.int64)


def run_buckets(words: pa.ListArray, lo: int, hi: int, stop_words: pa.Array | None, buckets: int) -> Iterator[np.ndarray]:
    """The bucket of each run of :func:`row_terms`, one entry for each occurrence; a term has the same bucket everywhere."""
    for _, parts, names in _coded(words, lo, hi, stop_words):
        yield _buckets(parts, names, buckets)


def all_terms(
    words: pa.ListArray, lo: int, hi: int, stop_words: pa.Array | None = None, wanted: np.ndarray | None = None,
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """``(term, cf, df)``: occurrences and rows of the runs of :func:`row_terms` over all rows, so that a term is one text here.

    ``wanted`` has a mark for each bucket of :func:`run_buckets`; other runs are left out.
    """
    for at, parts, names in _coded(words, lo, hi, stop_words):
        if wanted is not None:
            kept = wanted[_buckets(parts, names, len(wanted))]
            at, parts = at[kept], [part[kept] for part in parts]
        if not len(at):
            continue
        base, n_rows = max(1, len(names)), max(1, len(words))
        if base ** len(parts) * n_rows >= 2**62:
            _, term, n = _by_name(at, parts, names)
            yield term, n, np.ones(len(n), np.int64)
            continue
        # In order of term and row, a term's runs stand together, and so do those of one row.
        key = np.sort(_number(parts, base) * n_rows + at)
        other = np.diff(key, prepend=-1) != 0
        run = key // n_rows
        first = np.flatnonzero(np.diff(run, prepend=-1))
        df = np.add.reduceat(other, first, dtype=np.int64)
        yield _named(run[first], len(parts), names, base), np.diff(first, append=len(run)), df


class TermTable:
    """Finds the runs of words that are among given terms, by numbers.

    Words of terms are numbered, and so are terms' openings of one, two, ... words: one of ``k`` words by its place
    among the keys ``(number of the opening of k - 1 words, number of the last word)``.
    """

    def __init__(self, terms: list[str]):
        split = [t.split(" ") for t in terms]
        number = {w: i for i, w in enumerate(sorted({w for t in split for w in t}))}
        self.words, self.base = pa.array([*number], pa.string()), max(1, len(number))
        coded = [[number[w] for w in t] for t in split]
        self.keys, self.term = [], []
        opening = np.zeros(len(terms), np.int64)
        for k in range(max(map(len, coded), default=0)):
            long = np.array([i for i, t in enumerate(coded) if len(t) > k])
            keys, opening[long] = np.unique(opening[long] * self.base + [coded[i][k] for i in long], return_inverse=True)
            ends = np.array([i for i in long if len(coded[i]) == k + 1], np.int64)
            self.keys.append(keys)
            self.term.append(np.full(len(keys), -1))
            self.term[-1][opening[ends]] = ends

    def row_terms(self, words: pa.ListArray, lo: int, hi: int, stop_words: pa.Array | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(row, place of the term, n)`` of the terms among the runs that :func:`row_terms` gives."""
        for at, parts, names in _coded(words, lo, min(hi, len(self.keys)), stop_words):
            known = pc.fill_null(pc.index_in(names, self.words), -1).to_numpy().astype(np.int64)
            opening = np.zeros(len(at), np.int64)
            for part, keys in zip([known[part] for part in parts], self.keys, strict=False):
                key = opening * self.base + part
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                opening = np.where((opening >= 0) & (part >= 0) & (keys[place] == key), place, -1)
            term = np.where(opening >= 0, self.term[len(parts) - 1][opening], -1)
            found = term >= 0
            key, n = np.unique(at[found] * (len(self.term[len(parts) - 1]) + 1) + opening[found], return_counts=True)
            row, opening = np.divmod(key, len(self.term[len(parts) - 1]) + 1)
            yield row, self.term[len(parts) - 1][opening], n


def _join(parts: list[pa.Array]) -> pa.Array:
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, " ")


def _number(parts: list[np.ndarray], base: int, key: np.ndarray | int = 0) -> np.ndarray:
    for part in parts:
        key = key * base + part
    return key


def _named(key: np.ndarray, n: int, names: pa.Array, base: int) -> pa.Array:
    runs = []
    for _ in range(n):
        key, word = np.divmod(key, base)
        runs.insert(0, names.take(pa.array(word)))
    return _join(runs)


def _by_number(rows: np.ndarray, parts: list[np.ndarray], names: pa.Array, base: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    key, n = np.unique(_number(parts, base, rows), return_counts=True)
    return key // base ** len(parts), _named(key, len(parts), names, base), n


def _by_name(rows: np.ndarray, parts: list[np.ndarray], names: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The same where the numbers of runs would not fit into 64 bits."""
    table = pa.table({"row": rows, "term": _join([names.take(pa.array(p)) for p in parts])})
    table = table.group_by(["row", "term"]).aggregate([([], "count_all")]).combine_chunks()
    term = table.column("term").combine_chunks()
    return table.column("row").to_numpy(), term.chunk(0) if isinstance(term, pa.ChunkedArray) else term, table.column("count_all").to_numpy()
