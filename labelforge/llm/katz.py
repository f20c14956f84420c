"""Language-model scoring with a Katz back-off bigram model.

``P(w | v) = d(r) r / c(v)`` for a pair seen ``r`` times, with Good-Turing discounts for ``r <= 5``;
else ``a(v) P(w)``, where ``a(v)`` spreads exactly the mass that the context ``v`` has left over the
words not seen after it.  ``P(w)`` is the same scheme one order lower, and what it has left is the
probability of an unknown word.

Tokens are dealt, packed, to buckets of their context, where all training pairs of a context meet
the tokens to score.  Unigram counts are a written table of buckets; those of the most frequent
words, a bounded number, go to every task, and tokens of other words pass their word's bucket
first to fetch the count.  Frequent contexts are split by the following word; their sums over all
parts are gathered in the same pass as the counts of counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import deal, stored

U64 = np.uint64
#: Words whose counts go to every task, contexts that are split, tokens of a bucket, tokens packed at once.
HEAD, SPLIT, BUCKET, BATCH = 300_000, 20_000, 1_500_000, 1_500_000
#: Counts up to this one are discounted.
LOW = 5
END = U64(0x51ED270B7F2A9C35)
_OTHER = U64(1 << 63)
_TRAIN = np.uint16(1 << 15)
_ROWS = 30_000

RECORD = "bucket int, kind int, slice long, prev binary, runs binary, cur binary, cnt binary, idx binary, row binary, slices binary, nth binary"
_KINDS = (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 8)
_NAMES = ["bucket", "kind", "slice", "prev", "runs", "cur", "cnt", "idx", "row", "slices", "nth"]
TOKENS, TAIL, META, BASE, MARK = range(5)


class Records:
    def __init__(self):
        self.columns: list[list] = [[] for _ in _NAMES]

    def add(self, *values) -> None:
        for o, v in zip(self.columns, (*values, None, None)):
            o.append(v if v is None or isinstance(v, int) else v.tobytes())

    def table(self) -> pa.Table:
        return pa.table([pa.array(x, t) for x, t in zip(self.columns, _KINDS)], names=_NAMES)


class Unigrams:
    """Good-Turing unigram model from global counts alone."""

    def __init__(self, tokens: int, kinds: int, counts_of_counts: list[int]):
        self.tokens, self.kinds = tokens, kinds
        self.discount = discounts(counts_of_counts)
        lost = sum((1 - self.discount[r]) * r * counts_of_counts[r - 1] for r in range(1, LOW + 1))
        self.scale = 1.0
        if tokens and lost / tokens < 1e-12:  # nothing discounted: an unknown word counts as seen once
            self.scale = tokens / (tokens + 1)
        self.unknown = max(lost / tokens, 1 / (tokens + 1)) if tokens else 1.0

    def p(self, count: np.ndarray) -> np.ndarray:
        d = self.discount[np.clip(count, 0, LOW + 1)]
        return np.where(count > 0, self.scale * d * count / max(self.tokens, 1), self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((np.maximum(count, 0) + 1) / (self.tokens + self.kinds + 1))


def discounts(n: list[int]) -> np.ndarray:
    """``d(0..6)`` from the numbers of events seen 1 to 6 times; 1 where the counts give no sound discount."""
    d = np.ones(LOW + 2)
    if len(n) > LOW and n[0] > 0:
        common = (LOW + 1) * n[LOW] / n[0]
        for r in range(1, LOW + 1):
            if n[r - 1] > 0 and common < 1:
                x = ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common)
                if 0 < x < 1:
                    d[r] = x
    return d


def _short(batches):
    """Batches of rows whose numbers fit beside a flag, whatever the session's batch size."""
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            yield batch.slice(i, _ROWS)


def _tokens(batch: pa.RecordBatch):
    """Per slice: first row, training flags, and of each token its row, its word and whether it begins a text; ends included."""
    train = batch.column("train").to_numpy(zero_copy_only=False)
    for row, data, offsets in W.text_slices(batch.column("text")):
        n = len(offsets) - 1
        starts, ends, before = W.word_spans(data, offsets)
        hashes = W.word_hashes(data, starts, ends, fold=True)
        words = np.diff(before)
        last = np.cumsum(words + 1) - 1
        cur = np.empty(len(hashes) + n, U64)
        inner = np.ones(len(cur), bool)
        inner[last] = False
        cur[inner], cur[last] = hashes, END
        begin = np.zeros(len(cur), bool)
        begin[last - words] = True
        yield row, train[row : row + n], np.repeat(np.arange(n), words + 1), cur, begin


def _count_words(buckets: int):
    def run(batches):
        for batch in batches:
            found = [cur[train[owner]] for _, train, owner, cur, _ in _tokens(batch)]
            if not found:
                continue
            words, count = np.unique(np.concatenate(found), return_counts=True)
            b = W.bucket_of(words, buckets)
            i, m = W.runs(b)  # words are sorted, so buckets are
            yield pa.record_batch([pa.array(b[i], pa.int32()), pa.array([words[a : a + c].tobytes() for a, c in zip(i, m)], pa.binary()),
                                   pa.array([count[a : a + c].astype("<i8").tobytes() for a, c in zip(i, m)], pa.binary())],
                                  names=["bucket", "words", "counts"])
    return run


def _sum_words(group: pa.Table) -> pa.Table:
    words = np.frombuffer(b"".join(group.column("words").to_pylist()), "<u8")
    counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), "<i8")
    words, back = np.unique(words, return_inverse=True)
    counts = np.bincount(back, counts, len(words)).astype("<i8")
    return pa.table([group.column("bucket")[:1].cast(pa.int32()), pa.array([words.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())],
                    names=["bucket", "words", "counts"])


def _histogram(batches):
    for b in batches:
        for c in b.column("counts").to_pylist():
            count, n = np.unique(np.frombuffer(c, "<i8"), return_counts=True)
            yield pa.record_batch([pa.array(count, pa.int64()), pa.array(n.astype(np.int64), pa.int64())], names=["c", "n"])


def _at_least(least: int):
    def run(batches):
        for b in batches:
            for w, c in zip(b.column("words").to_pylist(), b.column("counts").to_pylist()):
                w, c = np.frombuffer(w, "<i8"), np.frombuffer(c, "<i8")
                yield pa.record_batch([pa.array(w[c >= least], pa.int64()), pa.array(c[c >= least], pa.int64())], names=["word", "c"])
    return run


class Head:
    """The most frequent words: their counts, and which of them are split as contexts.

    A word's code is its place here, or its hash with the top bit set; the code after the last place is
    the start of a text.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, split: np.ndarray):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.split = np.append(np.isin(self.words, split), True)

    def code(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return words | _OTHER
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at.astype(U64), words | _OTHER)

    @property
    def start(self) -> int:
        return len(self.words)

    def is_split(self, codes: np.ndarray) -> np.ndarray:
        near = codes < _OTHER
        out = np.zeros(len(codes), bool)
        out[near] = self.split[codes[near].astype(np.int64)]
        return out

    def bucket(self, prev: np.ndarray, cur: np.ndarray, buckets: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return W.bucket_of(W.mix(np.where(self.is_split(prev), prev + W.mix(cur), prev) + U64(1)), buckets)


def _narrow(codes: np.ndarray) -> np.ndarray:
    return codes.astype("<u4") if codes.max(initial=0) < 2**32 else codes


def _codes(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "<u4" if len(blob) == 4 * n else "<u8").astype(U64)


def _pack(out: Records, kind: int, name: int | None, bucket, prev, cur, count, row, slices=None, nth=None) -> None:
    """A record for each bucket.  Rows are of the slice ``name``, or of ``slices[nth]``."""
    far = prev >= _OTHER
    key = bucket * 2 + far
    order = np.lexsort((prev, key))
    key, prev, cur, row = key[order], prev[order], cur[order], row[order]
    count = count[order] if count is not None else None
    nth = nth[order] if nth is not None else None
    for i, m in zip(*W.runs(key)):
        s = slice(i, i + m)
        first, length = W.runs(prev[s])
        kinds, at, idx = np.unique(cur[s], return_index=True, return_inverse=True)
        out.add(int(key[i]) // 2, kind, name, _narrow(prev[s][first]), length.astype("<u4"), _narrow(kinds), count[s][at].astype("<i8") if count is not None else None,
                idx.astype("<u2" if len(kinds) <= 65536 else "<u4"), row[s], *_slices(slices, nth, s))


def _slices(slices: np.ndarray | None, nth: np.ndarray | None, s: slice) -> tuple:
    if slices is None:
        return ()
    used, back = np.unique(nth[s], return_inverse=True)
    return slices[used], back.astype("<u4")


def _slice_of(r: dict, n: int) -> np.ndarray:
    """The slice of each of the ``n`` entries of a record."""
    return np.full(n, r["slice"], np.int64) if r["slices"] is None else np.frombuffer(r["slices"], "<i8")[np.frombuffer(r["nth"], "<u4")]


def _unpack(r: dict, head: Head | None = None):
    """Context codes, words, counts and rows; words of ``TAIL`` are hashes, others codes."""
    runs, m = np.frombuffer(r["runs"], "<u4"), len(r["row"]) // 2
    prev = np.repeat(_codes(r["prev"], len(runs)), runs)
    wide = len(r["idx"]) == 4 * m
    idx = np.frombuffer(r["idx"], "<u4" if wide else "<u2")
    cur = _codes(r["cur"], int(idx.max()) + 1)
    count = None
    if head is not None:
        count = (np.frombuffer(r["cnt"], "<i8") if r["cnt"] is not None else head.counts[cur.astype(np.int64)])[idx]
    return prev, cur[idx], count, np.frombuffer(r["row"], "<u2")


def _deal(buckets: int, head: Head, uni: Unigrams):
    def pack(held: list, name: int):
        ids, train, owner, cur, begin, nulls = (np.concatenate([h[i] for h in held]) for i in range(6))
        rows = len(ids)
        code = head.code(cur)
        prev = np.empty_like(code)
        prev[1:] = code[:-1]
        prev[begin] = head.start
        known = code < _OTHER
        count = np.zeros(len(code), np.int64)
        count[known] = head.counts[code[known].astype(np.int64)]
        out = Records()
        row = owner.astype(np.uint16) | np.where(train[owner], _TRAIN, np.uint16(0))
        out.add(name % buckets, META, name, ids, train | (nulls << 1).astype(np.uint8), np.bincount(owner, minlength=rows).astype("<u4"),
                np.bincount(owner, known & (count > 0), rows).astype("<u4"), np.bincount(owner, np.where(known, uni.base(count), 0.0), rows), None)
        _pack(out, TOKENS, name, head.bucket(prev[known], code[known], buckets), prev[known], code[known], None, row[known])
        tail = ~known
        _pack(out, TAIL, name, W.bucket_of(cur[tail], buckets), prev[tail], cur[tail], None, row[tail])
        return out.table().to_batches()

    def run(batches):
        name, held, rows, size = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in _short(batches):
            ids = batch.column("doc_id")
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for row, train, owner, cur, begin in _tokens(batch):
                n = len(train)
                if held and (rows + n > _ROWS or size + len(cur) > BATCH):
                    yield from pack(held, name)
                    name, held, rows, size = name + 1, [], 0, 0
                held.append((ids[row : row + n], train, owner + rows, cur, begin, null[row : row + n]))
                rows, size = rows + n, size + len(cur)
        if held:
            yield from pack(held, name)
    return run


def _attach(buckets: int, head: Head, uni: Unigrams):
    """Tokens of a word's bucket get the word's count and go on to their context's bucket."""
    def run(tokens: pa.Table, counts: pa.Table) -> pa.Table:
        known = np.frombuffer(b"".join(counts.column("words").to_pylist()), "<u8")
        number = np.frombuffer(b"".join(counts.column("counts").to_pylist()), "<i8")
        out = Records()
        out.add(counts.column("bucket")[0].as_py(), MARK, 0, None, None, None, None, None, None)  # every bucket has one
        parts, slices = [], []
        for r in _rows(tokens, TAIL):
            prev, cur, _, row = _unpack(r)
            parts.append((prev, cur, row, np.full(len(row), len(slices))))
            slices.append(r["slice"])
        if parts:  # all slices together, so that what goes on is a record for each bucket
            prev, cur, row, nth = (np.concatenate([p[i] for p in parts]) for i in range(4))
            slices = np.array(slices, np.int64)
            count = np.zeros(len(cur), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, cur), len(known) - 1)
                count = np.where(known[at] == cur, number[at], 0)
            owner, back = np.unique(nth * (1 << 16) + (row & ~_TRAIN), return_inverse=True)
            out.add(counts.column("bucket")[0].as_py(), BASE, 0, None, None, np.bincount(back, count > 0, len(owner)).astype("<u4"), None,
                    np.bincount(back, uni.base(count), len(owner)), (owner & 0xFFFF).astype("<u2"), slices, (owner >> 16).astype("<u4"))
            cur = cur | _OTHER
            _pack(out, TOKENS, 0, head.bucket(prev, cur, buckets), prev, cur, count, row, slices, nth)
        return out.table()
    return run


def _rows(t: pa.Table, *kinds: int):
    t = t.filter(pa.compute.is_in(t.column("kind"), pa.array(kinds, pa.int32())))
    for b in t.to_batches(max_chunksize=64):
        yield from b.to_pylist()


class Bucket:
    """All tokens of a bucket: pair counts and sums by context."""

    def __init__(self, head: Head, *tables: pa.Table):
        parts = []
        for t in tables:
            for r in _rows(t.select(_NAMES), TOKENS):
                p = _unpack(r, head)
                parts.append((*p, _slice_of(r, len(p[0]))))
        empty = (np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.uint16), np.zeros(0, np.int64))
        prev, cur, self.count, self.row, self.slice = (np.concatenate([p[i] for p in parts]) if parts else empty[i] for i in range(5))
        self.train = (self.row & _TRAIN) > 0
        self.contexts, self.context = np.unique(prev, return_inverse=True)
        with np.errstate(over="ignore"):
            _, self.first, self.pair = np.unique(W.mix(prev + U64(1)) * U64(3) + W.mix(cur), return_index=True, return_inverse=True)
        self.seen = np.bincount(self.pair, self.train, len(self.first)).astype(np.int64)

    def sums(self, uni: Unigrams) -> np.ndarray:
        """Per context: training tokens, pairs seen 1 to 5 times, and the unigram mass of its seen words."""
        n, at = len(self.contexts), self.context[self.first]
        out = np.zeros((n, LOW + 2))
        out[:, 0] = np.bincount(at, self.seen, n)
        for r in range(1, LOW + 1):
            out[:, r] = np.bincount(at[self.seen == r], minlength=n)
        out[:, -1] = np.bincount(at, np.where(self.seen > 0, uni.p(self.count[self.first]), 0.0), n)
        return out


STATS = "word long, s array<double>"


def _statistics(head: Head, uni: Unigrams):
    """Counts of counts of pairs under a null word, and the sums of split contexts."""
    def run(tokens: pa.Table, more: pa.Table) -> pa.Table:
        b = Bucket(head, tokens, more)
        if not len(b.contexts):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(pa.float64()))], names=["word", "s"])
        split = head.is_split(b.contexts)
        words = [None, *b.contexts[split].view(np.int64).tolist()]
        low = np.bincount(np.minimum(b.seen, LOW + 2), minlength=LOW + 3)[1 : LOW + 2].astype(float)
        return pa.table([pa.array(words, pa.int64()), pa.array([np.append(low, 0.0), *b.sums(uni)[split]], pa.list_(pa.float64()))], names=["word", "s"])
    return run


REPLY = "slice long, kind int, a binary, b binary, c binary, d binary, e binary"


def _score(head: Head, uni: Unigrams):
    def run(tokens: pa.Table, more: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(7)]
        def reply(*values):
            for o, v in zip(out, values):
                o.append(v)

        for t in (tokens, more):
            for r in _rows(t.select(_NAMES), META, BASE):
                if r["kind"] == META:
                    reply(r["slice"], META, r["prev"], r["runs"], r["cur"], r["cnt"], r["idx"])
                    continue
                row, base, known = np.frombuffer(r["row"], "<u2"), np.frombuffer(r["idx"], "<f8"), np.frombuffer(r["cur"], "<u4")
                names = _slice_of(r, len(row))  # sorted by slice
                for i, m in zip(*W.runs(names)):
                    s = slice(i, i + m)
                    reply(int(names[i]), BASE, row[s].tobytes(), base[s].tobytes(), known[s].tobytes(), None, None)
        b = Bucket(head, tokens, more)
        if len(b.contexts):
            stats = next(x for x in more.column("stats").to_pylist() if x is not None)
            total = next((x["s"] for x in stats if x["word"] is None), [0.0] * (LOW + 2))
            d = discounts([int(x) for x in total[: LOW + 1]])
            sums = b.sums(uni)
            split = {x["word"]: x["s"] for x in stats if x["word"] is not None}
            for i, w in enumerate(b.contexts.view(np.int64).tolist()):
                if w in split:
                    sums[i] = split[w]
            c = sums[:, 0]
            low = np.arange(1, LOW + 1)
            left = (sums[:, 1 : LOW + 1] * (1 - d[low]) * low).sum(1) / np.maximum(c, 1)
            scale = np.ones(len(c))
            none = (c > 0) & (left < 1e-12)  # nothing discounted: one unseen event counts as seen once
            scale[none], left[none] = c[none] / (c[none] + 1), 1 / (c[none] + 1)
            left[c == 0] = 1.0
            alpha = left / np.maximum(1 - sums[:, -1], 1e-300)
            r = b.seen[b.pair]
            p = np.where(r > 0, scale[b.context] * d[np.minimum(r, LOW + 1)] * r / np.maximum(c[b.context], 1), alpha[b.context] * uni.p(b.count))
            names, which = np.unique(b.slice, return_inverse=True)
            owner, back = np.unique(which * (1 << 16) + (b.row & ~_TRAIN), return_inverse=True)
            sums = np.bincount(back, np.log10(p), len(owner))
            for i, m in zip(*W.runs(owner >> 16)):
                s = slice(i, i + m)
                reply(int(names[owner[i] >> 16]), TOKENS, (owner[s] & 0xFFFF).astype("<u2").tobytes(), sums[s].tobytes(), None, None, None)
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 5)
        return pa.table([pa.array(x, t) for x, t in zip(out, kinds)], names=["slice", "kind", "a", "b", "c", "d", "e"])
    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _results(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    meta = next(r for r in rows if r["kind"] == META)
    ids, flags = np.frombuffer(meta["a"], "<i8"), np.frombuffer(meta["b"], np.uint8)
    n, known, base = (np.frombuffer(meta[x], t).copy() for x, t in (("c", "<u4"), ("d", "<u4"), ("e", "<f8")))
    known, score = known.astype(np.int64), np.zeros(len(ids))
    for r in rows:
        if r["kind"] == TOKENS:
            score[np.frombuffer(r["a"], "<u2")] += np.frombuffer(r["b"], "<f8")
        elif r["kind"] == BASE:
            at = np.frombuffer(r["a"], "<u2")
            np.add.at(base, at, np.frombuffer(r["b"], "<f8"))  # a row may come twice
            np.add.at(known, at, np.frombuffer(r["c"], "<u4"))
    return pa.table([pa.array(ids, pa.int64(), mask=(flags & 2) > 0), pa.array((flags & 1) == 0), pa.array(n.astype(np.int64)), pa.array(known),
                     pa.array(base), pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def katz_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET,
                head_words: int = HEAD, split_words: int = SPLIT) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row.

    ``train`` marks the rows to learn from, null meaning not; the others are held out.  A text's tokens
    are its words, A-Z lower-cased, and one end; null and empty texts have the end alone.
    ``base_score`` is add-one unigram scoring, ``score`` the model's log10 probability.  Repeated rows
    count and are scored each; null ids stay null; further columns are ignored.  Without training
    rows every word is unknown and has probability 1.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, -(-size // (6 * bucket)))
    counted = deal(rows.mapInArrow(_count_words(buckets), "bucket int, words binary, counts binary"), buckets, "bucket")
    table = stored(counted.groupBy("bucket").applyInArrow(_sum_words, "bucket int, words binary, counts binary"), "unigrams")
    histogram = table.mapInArrow(_histogram, "c long, n long").groupBy("c").agg(F.sum("n").alias("n"))
    totals = histogram.agg(F.sum(F.col("c") * F.col("n")), F.sum("n"), *[F.sum(F.when(F.col("c") == r, F.col("n"))) for r in range(1, LOW + 2)]).first()
    uni = Unigrams(int(totals[0] or 0), int(totals[1] or 0), [int(x or 0) for x in totals[2:]])
    least, left = 1 << 62, head_words
    for c, n in histogram.orderBy(F.desc("c")).limit(head_words).collect():
        if n > left:
            break
        least, left = c, left - n
    words = table.mapInArrow(_at_least(least), "word long, c long").toArrow()
    hashes, counts = (words.column(x).to_numpy().astype(np.int64) for x in ("word", "c"))
    hashes = hashes.view(U64)
    often = np.argsort(-counts, kind="stable")[:split_words]
    often = often[counts[often] >= bucket // 8]
    head = Head(hashes, counts, hashes[often])

    dealt = deal(rows.mapInArrow(_deal(buckets, head, uni), RECORD), buckets, "bucket")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), *[F.lit(b"").alias(x) for x in ("words", "counts")])
    by_word = deal(table.unionByName(every), buckets, "bucket")
    tail = deal(dealt.groupBy("bucket").cogroup(by_word.groupBy("bucket")).applyInArrow(_attach(buckets, head, uni), RECORD), buckets, "bucket")
    parts = dealt.groupBy("bucket").cogroup(tail.groupBy("bucket")).applyInArrow(_statistics(head, uni), STATS)
    summed = parts.select("word", F.posexplode("s")).groupBy("word", "pos").agg(F.sum("col").alias("v"))
    whole = summed.groupBy("word").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]).alias("s"))
    stats = whole.agg(F.collect_list(F.struct("word", "s")).alias("stats")).scalar()
    marked = tail.withColumn("stats", F.when(F.col("kind") == MARK, stats))
    replies = dealt.groupBy("bucket").cogroup(marked.groupBy("bucket")).applyInArrow(_score(head, uni), REPLY)
    return replies.groupBy("slice").applyInArrow(_results, RESULT).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(uni.tokens).cast("long").alias("train_tokens"), "base_score", "score")
