"""N-gram Jaccard join by T-occurrence search.

Documents with equal shingle sets count as one set.  An inverted index from shingle to sets is
built in hash buckets.  A set can link only if enough of its shingles occur in other sets too, and
two linked sets share a shingle of their prefixes in the order (document frequency, shingle), so
stars over prefix shingles join linked sets into families.  Within blocks of families each set
searches the index: short lists are merged by a heap, the longest ones are set aside and probed by
binary search (DivideSkip), and sets that reach the overlap their sizes demand are links.  The
search walks each component, so a set that has been reached leaves the index and a group of copies
costs about its size.  A family larger than a block is split; then one hub of each block, and after
that every set outside the family's largest component, is searched in all its blocks, so no link
between components is lost.

The few thousand most frequent shingles (``LONG``) never enter the index; each set keeps its own,
and they come last in the order.  The choice of ``LONG`` changes costs, not results.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import arrow_map, components, deal, signed, stored, tidied

#: Most frequent shingles kept out of the index; 8 bytes each go to every task.
LONG = 100_000
#: Postings of an index bucket and of a search block.
BUCKET, BLOCK = 1_000_000, 500_000
#: DivideSkip's weight of a probe against a merge step.
MU = 0.01

U64 = np.uint64


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of rows: first row, set sizes, set ids, and the distinct (row, shingle) pairs."""
    for row, data, offsets in W.text_slices(batch.column("text")):
        rows = len(offsets) - 1
        starts, ends, before = W.word_spans(data, offsets)
        hashes = W.word_hashes(data, starts, ends, fold=True)
        grams, at = W.windows(hashes, before, k)
        owner = np.searchsorted(before, at, side="right") - 1
        count = np.diff(before)
        short = np.flatnonzero((count > 0) & (count < k))
        grams = np.concatenate([grams, W.whole(hashes, before, short)])
        owner = np.concatenate([owner, short])
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        grams, owner = grams[new], owner[new]
        size = np.bincount(owner, minlength=rows)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(grams) + 1, U64)
            np.cumsum(W.mix(grams), out=sums[1:])
            hi = np.cumsum(size)
            ids = W.mix((sums[hi] - sums[hi - size]) + size.astype(U64))
        yield row, size, ids, owner, grams


def _firsts(ids: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows that are the first with their set; rows without shingles are none."""
    first = np.zeros(len(ids), bool)
    first[np.unique(ids, return_index=True)[1]] = True
    return first & (size > 0)


def _profile(k: int):
    def run(batch):
        for row, size, ids, owner, grams in _sets(batch, k):
            n = len(size)
            keep = _firsts(ids, size)
            seen, docs = np.unique(grams[keep[owner]], return_counts=True)
            often = docs >= max(8, keep.sum() // 64)
            seen, docs = seen[often], docs[often]
            m = len(seen)
            yield pa.record_batch([
                pa.concat_arrays([batch.column("doc_id").slice(row, n).cast(pa.int64()), pa.nulls(m, pa.int64())]),
                pa.concat_arrays([pa.array(size.astype(np.int64)), pa.nulls(m, pa.int64())]),
                pa.concat_arrays([signed(ids), signed(seen)]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(docs.astype(np.int64))]),
            ], names=["doc_id", "n", "id", "often"])
    return run


def _token(grams: np.ndarray, buckets: int) -> np.ndarray:
    """The form of a shingle that the index keeps: its bucket and 48 further bits."""
    with np.errstate(over="ignore"):
        return (W.bucket_of(grams, buckets).astype(U64) << U64(48)) + (grams & U64(2**48 - 1))


POSTINGS = "bucket int, part int, a binary, b binary, c binary, d binary"


def _postings(k: int, buckets: int, parts: int, frequent: np.ndarray):
    def run(batch):
        for _, size, ids, owner, grams in _sets(batch, k):
            out: list[list] = [[] for _ in range(6)]
            keep = _firsts(ids, size)
            mine = keep[owner]
            owner, grams = owner[mine], grams[mine]
            at = np.searchsorted(frequent, grams)
            is_long = (at < len(frequent)) & (frequent[np.minimum(at, len(frequent) - 1)] == grams) if len(frequent) else np.zeros(len(grams), bool)
            # what a set is: its size and its frequent shingles
            rows = np.flatnonzero(keep)
            n_long = np.bincount(owner[is_long], minlength=len(size))
            tokens = _token(grams[is_long], buckets)
            lo = np.cumsum(n_long) - n_long
            part = (ids[rows] % U64(parts)).astype(np.int64)
            for p in np.unique(part):
                r = rows[part == p]
                cut = [tokens[lo[i] : lo[i] + n_long[i]] for i in r]
                for o, v in zip(out, (int(p) % buckets, int(p), ids[r].tobytes(), size[r].astype("<u4").tobytes(),
                                      n_long[r].astype("<u4").tobytes(), np.concatenate(cut).tobytes())):
                    o.append(v)
            # where it is in the index
            owner, grams = owner[~is_long], grams[~is_long]
            b = W.bucket_of(grams, buckets)
            order = np.argsort(b, kind="stable")  # the rows of a bucket stay together
            b, owner, grams = b[order], owner[order], grams[order]
            for i, m in zip(*W.runs(b)):
                first, length = W.runs(owner[i : i + m])
                for o, v in zip(out, (int(b[i]), None, W.pack48(grams[i : i + m]), length.astype("<u2" if length.max() < 65536 else "<u4").tobytes(),
                                      ids[owner[i : i + m][first]].tobytes(), None)):
                    o.append(v)
            if out[0]:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(out, (pa.int32(), pa.int32(), *[pa.binary()] * 4))],
                                      names=["bucket", "part", "a", "b", "c", "d"])
    return run


def _lists(parts: int):
    """Index bucket: postings of shingles that several sets have, dealt to the parts of their sets."""
    def run(group: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(5)]
        ids, tokens = [], []
        bucket = U64(group.column("bucket")[0].as_py())
        for part, a, b, c, d in zip(*(group.column(x).to_pylist() for x in ("part", "a", "b", "c", "d"))):
            if part is not None:
                for o, v in zip(out, (part, a, b, c, d)):
                    o.append(v)
                continue
            low, docs = W.unpack48(a), np.frombuffer(c, "<u8")
            tokens.append(low)
            ids.append(np.repeat(docs, np.frombuffer(b, "<u2" if len(b) == 2 * len(docs) else "<u4")))
        if tokens:
            tokens, ids = np.concatenate(tokens), np.concatenate(ids)
            order = np.argsort(tokens)
            tokens, ids = tokens[order], ids[order]
            first, length = W.runs(tokens)
            several = np.repeat(length > 1, length)
            tokens, ids = tokens[several], ids[several]
            order = np.lexsort((ids, tokens))
            tokens, ids = tokens[order], ids[order]
            new = np.ones(len(ids), bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1])
            tokens, ids = tokens[new], ids[new]
            first, length = W.runs(tokens)
            df = np.repeat(length, length)
            with np.errstate(over="ignore"):
                tokens, ids, df = (tokens + (bucket << U64(48)))[df > 1], ids[df > 1], df[df > 1]
            part = (ids % U64(parts)).astype(np.int64)
            order = np.lexsort((ids, part))
            part, ids, tokens, df = part[order], ids[order], tokens[order], df[order]
            for i, m in zip(*W.runs(part)):
                s = slice(i, i + m)
                for o, v in zip(out, (int(part[i]), ids[s].tobytes(), tokens[s].tobytes(), df[s].astype("<u4").tobytes(), None)):
                    o.append(v)
        return pa.table([pa.array(x, t) for x, t in zip(out, (pa.int32(), *[pa.binary()] * 4))], names=["part", "a", "b", "c", "d"])
    return run


def _candidates(percent: int):
    """Part of the sets: those that can link, their shared shingles, and the prefix among them."""
    def run(group: pa.Table) -> pa.Table:
        sets, ids, tokens, df = {}, [], [], []
        for a, b, c, d in zip(*(group.column(x).to_pylist() for x in ("a", "b", "c", "d"))):
            if d is None:
                ids.append(np.frombuffer(a, "<u8"))
                tokens.append(np.frombuffer(b, "<u8"))
                df.append(np.frombuffer(c, "<u4"))
            else:
                longs, at = np.frombuffer(d, "<u8"), 0
                for i, n, m in zip(np.frombuffer(a, "<u8").tolist(), np.frombuffer(b, "<u4").tolist(), np.frombuffer(c, "<u4").tolist()):
                    sets[i] = (n, longs[at : at + m])
                    at += m
        out: list[list] = [[] for _ in range(4)]
        spans = {}
        if ids:
            ids, tokens, df = np.concatenate(ids), np.concatenate(tokens), np.concatenate(df)
            order = np.lexsort((tokens, df, ids))
            ids, tokens = ids[order], tokens[order]
            spans = {int(ids[i]): (i, i + m) for i, m in zip(*W.runs(ids))}
        for i, (n, longs) in sets.items():
            lo, hi = spans.get(i, (0, 0))
            need = -(-percent * n // 100)
            shared = hi - lo + len(longs)
            if shared >= need:
                own = np.concatenate([tokens[lo:hi] if hi else np.zeros(0, U64), np.sort(longs)]).astype(np.uint64)
                for o, v in zip(out, (np.uint64(i).astype(np.int64), n, own[: shared - need + 1].view(np.int64), own.tobytes())):
                    o.append(v)
        return pa.table([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))],
                        names=["id", "n", "keys", "tokens"])
    return run


# --- search in a block -------------------------------------------------------------------------


def occurrences(lists: list[np.ndarray], need: int, mu: float = MU) -> tuple[np.ndarray, np.ndarray]:
    """Members that occur in at least ``need`` of the sorted ``lists``, and in how many (DivideSkip)."""
    lists = sorted((x for x in lists if len(x)), key=len)
    if len(lists) < need or not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    aside = min(int(need / (mu * np.log2(len(lists[-1]) + 1) + 1)), need - 1)
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    if sum(map(len, short)) <= 20_000:
        merged = [(doc, sum(1 for _ in same)) for doc, same in groupby(heapq.merge(*(x.tolist() for x in short)))]
        docs, count = (np.array(x, np.int64) for x in zip(*merged))
    else:  # the same merge of sorted runs, by numpy
        docs, count = np.unique(np.concatenate(short), return_counts=True)
    enough = count >= need - aside
    docs, count = docs[enough], count[enough]
    for rest, x in zip(range(len(long), 0, -1), long):
        enough = count + rest >= need
        docs, count = docs[enough], count[enough]
        if not len(docs):
            break
        at = np.minimum(np.searchsorted(x, docs), len(x) - 1)
        count = count + (x[at] == docs)
    enough = count >= need
    return docs[enough], count[enough]


class Index:
    """Inverted lists over the sets ``members`` of a block."""

    def __init__(self, lo: np.ndarray, tokens: np.ndarray, members: np.ndarray):
        size = lo[members + 1] - lo[members]
        at = np.arange(size.sum()) + np.repeat(lo[members] - (np.cumsum(size) - size), size)
        doc = np.repeat(members, size)
        order = np.argsort(tokens[at], kind="stable")
        self.docs, keys = doc[order], tokens[at][order]
        self.first, length = W.runs(keys)
        self.keys, self.end = keys[self.first], self.first + length

    def lists(self, tokens: np.ndarray, alive: np.ndarray) -> list[np.ndarray]:
        if not len(self.keys):
            return []
        at = np.minimum(np.searchsorted(self.keys, tokens), len(self.keys) - 1)
        at = at[self.keys[at] == tokens]
        found = (self.docs[self.first[i] : self.end[i]] for i in at)
        return [x[alive[x]] for x in found]


def _links(index: Index, tokens: np.ndarray, n: int, sizes: np.ndarray, alive: np.ndarray, percent: int) -> np.ndarray:
    docs, overlap = occurrences(index.lists(tokens, alive), -(-percent * n // 100))
    return docs[100 * overlap >= percent * (n + sizes[docs] - overlap)]


def walk(sizes: np.ndarray, lo: np.ndarray, tokens: np.ndarray, percent: int) -> np.ndarray:
    """For each set the first member of its component."""
    n = len(sizes)
    alive, label = np.ones(n, bool), np.arange(n)
    index, indexed = Index(lo, tokens, np.arange(n)), n
    left = n
    for seed in range(n):
        if not alive[seed]:
            continue
        alive[seed], left, front = False, left - 1, [seed]
        while front:
            q = front.pop()
            if left * 2 < indexed:
                index, indexed = Index(lo, tokens, np.flatnonzero(alive)), left
            hits = _links(index, tokens[lo[q] : lo[q + 1]], sizes[q], sizes, alive, percent)
            label[hits], alive[hits], left = seed, False, left - len(hits)
            front.extend(hits.tolist())
    return label


def _unpack(group: pa.Table, only: np.ndarray | None = None):
    blobs = [np.frombuffer(x, "<u8") for x in group.column("tokens").to_pylist()]
    lo = np.concatenate([[0], np.cumsum([len(x) for x in blobs])]).astype(np.int64)
    return group.column("n").to_numpy(), lo, np.concatenate(blobs) if blobs else np.zeros(0, U64)


def _search(percent: int):
    def run(group: pa.Table) -> pa.Table:
        sizes, lo, tokens = _unpack(group)
        ids = group.column("id").to_numpy()
        return pa.table([group.column("id"), pa.array(ids[walk(sizes, lo, tokens, percent)])], names=["id", "label"])
    return run


def _across(percent: int):
    """Block and queries of its family: ``(u, v)`` labels that a query joins."""
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sizes, lo, tokens = _unpack(group)
        label, asks = group.column("label").to_numpy(), group.column("asks").to_numpy(zero_copy_only=False)
        members = np.flatnonzero(~asks)
        index, found = Index(lo, tokens, members), set()
        for q in np.flatnonzero(asks):
            alive = label != label[q]
            hits = _links(index, tokens[lo[q] : lo[q + 1]], sizes[q], sizes, alive, percent)
            found.update((int(label[q]), int(x)) for x in np.unique(label[hits]))
        u, v = ([x[i] for x in found] for i in (0, 1))
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
    return run


def _join_blocks(big: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Labels of split families after the searches across blocks."""
    for step in ("hub", "rest"):
        rows = stored(big.join(labels, "id"), "blocks")
        if step == "hub":
            sized = rows.groupBy("family", "block", "label").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("hub"))
            hubs = sized.groupBy("family", "block").agg(F.max_by("hub", F.struct("c", "hub")).alias("id")).select("id")
            asking = rows.join(hubs, "id", "left_semi")
        else:
            sized = rows.groupBy("family", "label").agg(F.count(F.lit(1)).alias("c"))
            main = sized.groupBy("family").agg(F.max_by("label", F.struct("c", "label")).alias("label"))
            asking = rows.join(main, ["family", "label"], "left_anti")
        copies = asking.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        cols = ["family", "block", "id", "n", "tokens", "label"]
        both = (rows.select(*cols).withColumn("asks", F.lit(False))
                .unionByName(copies.select(*cols).withColumn("asks", F.lit(True))))
        joined = stored(both.groupBy("family", "block").applyInArrow(tidied(_across(percent)), "u long, v long").distinct(), "joined")
        lower = components(joined).withColumnRenamed("label", "lower").withColumnRenamed("node", "label")
        labels = stored(labels.join(lower, "label", "left").select("id", F.coalesce("lower", "label").alias("label")), "labels")
    return labels


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75,
    bucket: int = BUCKET, block: int = BLOCK, long_lists: int = LONG,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs``.

    Rows link when ``100 * intersection >= percent * union`` of their shingle sets; the component id
    is the least id reachable by links.  Null and empty texts have no shingles and link with nothing:
    their component id is their own id.  A text of fewer words than a shingle is one shingle.  Rows
    that repeat an id are kept and judged by their own text; a null id is never a component id unless
    a component has no other.  Further columns are ignored.
    """
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profile = stored(arrow_map(text, _profile(words), "doc_id long, n long, id long, often long"), "profile")
    rows = profile.where("often is null").select("doc_id", "n", "id")
    frequent = (profile.where("often is not null").groupBy("id").agg(F.sum("often").alias("c"))
                .orderBy(F.desc("c"), "id").limit(long_lists).select("id").collect())
    frequent = np.sort(np.array([r[0] for r in frequent], np.int64).view(U64))
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = parts = max(1, -(-total // bucket))

    postings = deal(arrow_map(text, _postings(words, buckets, parts, frequent), POSTINGS), buckets, "bucket")
    shared = postings.groupBy("bucket").applyInArrow(tidied(_lists(parts)), "part int, a binary, b binary, c binary, d binary")
    able = stored(
        deal(shared, parts, "part").groupBy("part").applyInArrow(tidied(_candidates(percent)), "id long, n long, keys array<long>, tokens binary"),
        "able")

    keys = stored(able.select("id", F.explode("keys").alias("key")), "keys")
    stars = stored(keys.groupBy("key").agg(F.min("id").alias("star"), F.count(F.lit(1)).alias("c")).where("c > 1").select("key", "star"), "stars")
    families = components(keys.join(stars, "key").select(F.col("id").alias("u"), F.col("star").alias("v")))
    named = stored(able.select("id", (F.length("tokens") / 8).alias("w")).join(
        families.select(F.col("node").alias("id"), F.col("label").alias("family")), "id"), "families")
    weight = stored(named.groupBy("family").agg(F.sum("w").alias("w")).withColumn("blocks", F.ceil(F.col("w") / block)), "weights")
    groups = max(1, int((weight.where("blocks = 1").agg(F.sum("w")).first()[0] or 0) // block + 1))
    placed = (named.select("id", "family").join(weight.select("family", "blocks"), "family")
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
              .withColumn("g", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(groups))).otherwise(F.xxhash64("family", "block"))))
    placed = stored(placed.select("id", "g", "family", "block", "blocks"), "placed")
    blocks = able.select("id", "n", "tokens").join(placed, "id")
    labels = stored(blocks.select("g", "id", "n", "tokens").groupBy("g").applyInArrow(tidied(_search(percent)), "id long, label long"), "labels")
    if not placed.where("blocks > 1").isEmpty():
        labels = _join_blocks(blocks.where("blocks > 1").drop("g"), labels, percent)

    sets = rows.where("n > 0").groupBy("id").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("c"))
    known = sets.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    known = stored(known.select("id", "label", "least", "c"), "sets")
    least = known.groupBy("label").agg(F.min("least").alias("component_id"), F.sum("c").alias("c")).where("c > 1")
    member = stored(known.join(least.drop("c"), "label").select("id", "component_id"), "members")
    return rows.join(member, "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
