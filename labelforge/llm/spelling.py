"""Spelling variants by dense prefix-suffix tiling.

Two words that differ by one edit share the first or the last half of the shorter one, so words meet in
groups of equal halves.  Groups are laid one after another and cut into tiles of rows; two tiles are
compared as a whole, as matrices of padded code points: the common prefix and the common suffix of all
pairs of rows come out of one comparison each, and a pair is near if they reach the longer length minus
one.  A group that outgrows a bucket is cut into chunks, and each pair of chunks is compared on its own.

Pairs are not written: a tile adds to each of its words the number of near words and the most frequent one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import arrow_map, deal, stored

#: Rows of a tile, of a chunk of a large group, and of a bucket; bytes of text counted together.
TILE, CHUNK, BUCKET, SLICE = 32, 4_000, 100_000, 8_000_000
#: Cells of one dense comparison, and runs longer than this are digested one by one.
CELLS, LONG = 4_000_000, 48
_NEAR = "word string, n_near long, best struct<rest:long,form:string>"

_CRC = np.array([zlib.crc32(bytes([i])) for i in range(256)], np.uint32)
_CRC ^= _CRC[0]  # the table of plain byte steps: a digest of one byte is it and a constant


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of A-Z, a-z and U+00C0 to U+00FF; the latter are all that the lead byte C3 begins."""
    lower = data | 0x20
    lead = data == 0xC3
    inside = ((lower >= 97) & (lower <= 122)) | lead
    inside[1:] |= lead[:-1]
    return inside


def _digests(first: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start : start + length]`` continued from ``first``, byte by byte for all at once."""
    order = np.argsort(-lengths, kind="stable")
    crc, at, left = ~first[order], starts[order], lengths[order]
    short = int(np.searchsorted(-left, -LONG, side="left"))
    for i in range(short):
        raw = data[at[i] : at[i] + left[i]].tobytes()
        crc[i] = ~np.uint32(zlib.crc32(raw, int(~crc[i])))
    live = len(left)
    for step in range(int(left[short]) if short < live else 0):
        live = int(np.searchsorted(-left, -step, side="left"))
        part = slice(short, live)
        crc[part] = _CRC[(crc[part] ^ data[at[part] + step]) & 0xFF] ^ (crc[part] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~crc
    return out


def variants(ids: list, data: np.ndarray, offsets: np.ndarray, every: int) -> pa.Array:
    """The words of a slice of texts, one by one, with the planted deletions."""
    inside = _letters(data)
    folded = np.where((data >= 65) & (data <= 90), data + 32, data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    # Where each run ends: its letters are all that lie between its start and the next one's.
    before = np.concatenate([[0], np.cumsum(inside)])
    bounds = before[np.append(starts, len(data))]
    lengths = np.diff(bounds)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    planted = _digests(seeds[owner], folded, starts, lengths) if len(starts) else np.zeros(0, np.uint32)
    raw = np.ascontiguousarray(folded[inside])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw))
    hit = planted % every == 0
    changed = []
    for i in np.flatnonzero(hit):
        word = words[int(i)].as_py()
        cut = int(planted[i]) % len(word)
        changed.append(word[:cut] + word[cut + 1 :])
    return pa.concat_arrays([words.filter(pa.array(~hit)), pa.array(changed, pa.large_string())])


def _parts(data: np.ndarray, offsets: np.ndarray):
    """The slice itself, or a longer text cut between runs."""
    if len(data) <= SLICE or len(offsets) > 2:
        yield data, offsets
        return
    at = 0
    while at < len(data):
        end = at + SLICE
        while end < len(data) and _letters(data[end - 2 : end + 1])[-2:].all():
            back = np.flatnonzero(~_letters(data[at:end]))
            end = at + int(back[-1]) + 1 if len(back) else end + SLICE
        end = min(end, len(data))
        yield data[at:end], np.array([0, end - at])
        at = end


def _counted(shortest: int, every: int):
    def run(batch):
        ids = batch.column("id").to_pylist()
        for row, data, offsets in W.text_slices(batch.column("text"), SLICE):
            for part, ends in _parts(data, offsets):
                words = variants(ids[row : row + len(offsets) - 1], part, ends, every)
                counts = pc.value_counts(words.filter(pc.greater_equal(pc.utf8_length(words), shortest)))
                yield pa.record_batch([counts.field(0).cast(pa.string()), counts.field(1)], names=["word", "n"])
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, every: int = 199) -> DataFrame:
    """``(word, n)`` of all runs of Latin letters of ``shortest`` code points or more, A-Z lower-cased.

    Of each run whose ``crc32("id:run")`` is divisible by ``every``, the code point at that number modulo
    the length is deleted first.  Null texts have no runs; a null id is empty in the digest.
    """
    text = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return arrow_map(text, _counted(shortest, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _matrix(words: list[str], length: np.ndarray, right: bool) -> np.ndarray:
    """One row of code points per word, the last ones first if ``right``; the padding is no code point."""
    width = int(length.max())
    points = np.frombuffer("".join(w[::-1] if right else w for w in words).encode("utf-32-le"), "<u4")
    kind = np.uint8 if points.max(initial=0) < 255 else np.uint32
    out = np.full((len(words), width), np.iinfo(kind).max, kind)
    out[np.arange(width) < length[:, None]] = points
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of all pairs of rows of ``(tiles, rows, width)`` matrices."""
    alike = a[:, :, None, :] == b[:, None, :, :]
    n = alike.shape[-1]
    return np.where(alike.all(-1), n, alike.argmin(-1))


class _Laid:
    """Rows of all groups of a bucket, group after group, and what a word has gained."""

    def __init__(self, words: list[str], group: np.ndarray, chunk: np.ndarray, short: np.ndarray, prefix: np.ndarray, same: np.ndarray):
        self.words, self.group, self.chunk, self.short, self.prefix, self.same = words, group, chunk, short, prefix, same
        self.length = np.array([len(w) for w in words], np.int64)
        self.left, self.right = _matrix(words, self.length, False), _matrix(words, self.length, True)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Near pairs of the rows of tiles ``a`` with those of ``b``, both ``(tiles, rows)`` with -1 as padding."""
        found = []
        step = max(1, CELLS // (a.shape[1] * b.shape[1] * self.left.shape[1]))
        for i in range(0, len(a), step):
            x, y = a[i : i + step], b[i : i + step]
            u, v = x[:, :, None], y[:, None, :]
            ok = (u < v) & (u >= 0) & (self.group[u] == self.group[v])
            ok &= (np.abs(self.length[u] - self.length[v]) <= 1) & (self.short[u] | self.short[v])
            ok &= (self.chunk[u] != self.chunk[v]) | self.same[u]
            if not ok.any():
                continue
            start, end = _common(self.left[x], self.left[y]), _common(self.right[x], self.right[y])
            longer = np.maximum(self.length[u], self.length[v])
            half = (np.minimum(self.length[u], self.length[v]) + 1) // 2
            # Pairs that share the first half are found in its group alone.
            ok &= (np.minimum(start, longer) + np.minimum(end, longer) >= longer - 1) & (self.prefix[u] | (start < half))
            t, p, q = np.nonzero(ok)
            found.append((x[t, p], y[t, q]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """All near pairs: each tile with itself and with those that the group of its last row reaches into."""
        rows, side = len(self.words), min(TILE, max(1, int((CELLS // max(1, self.left.shape[1])) ** 0.5)))
        tiles = np.full(-(-rows // side) * side, -1, np.int64)
        tiles[:rows] = np.arange(rows)
        tiles = tiles.reshape(-1, side)
        head, tail = self.group[tiles[:, 0]], self.group[tiles.max(1)]
        out = [self.pairs(tiles, tiles)]
        for gap in range(1, len(tiles)):
            at = np.flatnonzero(tail[:-gap] == head[gap:])
            if not len(at):
                break
            out.append(self.pairs(tiles[at], tiles[at + gap]))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _bucket(group: pa.Table) -> pa.Table:
    """What the words of a bucket gain; its groups are laid out by classes of length, so that padding is bounded."""
    group = group.sort_by([("key", "ascending"), ("u", "ascending"), ("v", "ascending"), ("word", "ascending")])
    words = group.column("word").to_pylist()
    n, short, prefix, chunk, u, v = (group.column(c).to_numpy(zero_copy_only=False) for c in ("n", "short", "prefix", "chunk", "u", "v"))
    key = np.array(group.column("key").to_pylist(), object)
    new = np.ones(len(words), bool)
    new[1:] = (key[1:] != key[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    place = np.cumsum(new)
    # The longest word of a group is at most one longer than its shortest.
    size = np.array([int(k[: k.index("<" if p else ">")]) for k, p in zip(key, prefix)], np.int64)
    left, right = [], []
    for level in np.unique(np.log2(np.maximum(size, 1)).astype(int)):
        at = np.flatnonzero(np.log2(np.maximum(size, 1)).astype(int) == level)
        a, b = _Laid([words[i] for i in at], place[at], chunk[at], short[at], prefix[at], (u == v)[at]).near()
        left.append(at[a])
        right.append(at[b])
    word, other = np.concatenate([*left, *right]), np.concatenate([*right, *left])
    # Per word: how many, and the one with the largest count, the least of these.
    names, code = np.unique(np.array(words, object), return_inverse=True)
    word, best = code[word], code[other]
    order = np.lexsort((best, -n[other], word))
    word, best, most = word[order], best[order], n[other][order]
    i, m = W.runs(word)
    forms = pa.StructArray.from_arrays([pa.array(-most[i], pa.int64()), pa.array(names[best[i]].tolist(), pa.string())], names=["rest", "form"])
    return pa.table([pa.array(names[word[i]].tolist(), pa.string()), pa.array(m, pa.int64()), forms], names=["word", "n_near", "best"])


def halves(word: Column) -> Column:
    """The groups of a word: its first and its last half, as the shorter word of a pair and as the longer one."""
    n = F.char_length(word)

    def key(short: Column, prefix: bool) -> Column:
        size = F.floor((short + 1) / 2).cast("int") if prefix else F.floor(short / 2).cast("int")
        part = F.left(word, size) if prefix else F.right(word, size)
        mark = "<" if prefix else ">"
        return F.struct(F.concat(short.cast("string"), F.lit(mark), part).alias("key"), (short == n).alias("short"), F.lit(prefix).alias("prefix"))

    return F.array(*[key(n - less, prefix) for less in (0, 1) for prefix in (True, False)])


def near_words(words: DataFrame, chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """``(word, n_near, form, form_n)`` of the words that have near ones, from distinct ``(word, n)``.

    Two words are near if one inserted, deleted or replaced code point turns one into the other; ``form`` is
    the near word of largest ``n``, the least in code-point order of these.
    """
    keyed = words.select("word", "n", F.explode(halves(F.col("word"))).alias("h")).select("word", "n", "h.*")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size"), F.bool_or("short").alias("any"))
    sizes = stored(sizes.where("size > 1 AND any"), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    parts = F.ceil(F.col("size") / chunk).cast("int")
    members = keyed.join(sizes.select("key", parts.alias("parts")), "key")
    members = members.withColumn("chunk", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("word"), F.col("parts"))).otherwise(F.lit(0)).cast("int"))
    # A large group: a word goes to each pair of chunks that its own is part of.
    others = F.explode(F.expr("transform(sequence(0, parts - 1), x -> struct(least(x, chunk) AS u, greatest(x, chunk) AS v))"))
    members = members.withColumn("pair", others).select("word", "n", "key", "short", "prefix", "chunk", "pair.*")
    buckets = max(1, -(-int(total) // bucket))
    where = F.when((F.col("u") == 0) & (F.col("v") == 0), F.pmod(F.xxhash64("key"), F.lit(buckets))).otherwise(F.pmod(F.xxhash64("key", "u", "v"), F.lit(buckets)))
    found = deal(members.withColumn("bucket", where), buckets, "bucket").groupBy("bucket").applyInArrow(_bucket, _NEAR)
    out = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return out.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.rest")).alias("form_n"))


def spelling_groups(words: DataFrame, factor: int = 5, **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct ``(word, n)``.

    ``form`` is the near word of largest ``n`` if that is ``factor`` times the word's or more, else null like
    ``form_n``; ``root`` is the last of the forms that follow from the word, itself if it has none.  Ties go
    to the least word in code-point order.  Null words are ignored; words of every length and script are
    compared by code points.  Further columns are ignored.  An empty table gives no rows.
    """
    words = words.where("word IS NOT NULL").select("word", "n")
    near = near_words(words, **options)
    chosen = F.col("form_n") >= factor * F.col("n")
    out = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("form")).alias("form"), F.when(chosen, F.col("form_n")).alias("form_n")), "forms")
    # Counts grow along forms, so there are no circles; each round doubles the forms that a root looks ahead.
    step = stored(out.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = stored(step.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        step = new.select("word", "root")
        if new.where("moved").isEmpty():
            break
    return out.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
