"""N-gram join, substring and exact de-duplication against plain models."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelforge.llm import exact, ngram_join, substring

from .data import fold, frame, rows, words


def components(table):
    sets = []
    for i, t, _ in table:
        w = words(fold(t))
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(table)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(table)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    least = {}
    for a, (i, _, _) in enumerate(table):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    return sorted(((i, len(sets[a]), least.get(root(a))) for a, (i, _, _) in enumerate(table)), key=str)


@pytest.mark.parametrize("options", [{}, {"bucket": 5000, "long_lists": 0}, {"block": 400, "bucket": 3000, "long_lists": 200}])
def test_ngram_join(spark, options):
    got = ngram_join.ngram_join(frame(spark, rows()), **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == components(rows())


def test_ngram_join_of_a_split_family_with_a_chain(spark):
    """Copies that drift: ends of the chain are linked only through others, across blocks."""
    w = [f"c{i}" for i in range(80)]
    table = [(i, " ".join(w[2 * i : 2 * i + 80]), "s") for i in range(1)]
    chain = [f"c{i}" for i in range(400)]
    table = [(i, " ".join(chain[3 * i : 3 * i + 80]), "s") for i in range(60)] + [(100 + i, " ".join(chain[150:230] + [f"z{i}"]), "s") for i in range(30)]
    got = ngram_join.ngram_join(frame(spark, table), block=900).collect()
    assert sorted((tuple(r) for r in got), key=str) == components(table)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.ngram_join(frame(spark, [])).count() == 0
    got = ngram_join.ngram_join(frame(spark, [(4, None, None), (5, "", None)])).collect()
    assert sorted(map(tuple, got)) == [(4, 0, 4), (5, 0, 5)]


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(3)
    for _ in range(50):
        lists = [np.unique(rng.integers(0, 40, rng.integers(1, 30))) for _ in range(rng.integers(1, 25))]
        need = int(rng.integers(1, 15))
        docs, count = np.unique(np.concatenate(lists), return_counts=True)
        got = ngram_join.occurrences(lists, need)
        order = np.argsort(got[0])
        assert got[0][order].tolist() == docs[count >= need].tolist()
        assert got[1][order].tolist() == count[count >= need].tolist()


def without_repeats(table, k=35):
    seen = {}
    for a, (_, t, _) in enumerate(table):
        w = words(t)
        for p in range(len(w) - k + 1):
            seen.setdefault(tuple(w[p : p + k]), []).append((a, p))
    gone = [set() for _ in table]
    for places in seen.values():
        if len(places) > 1:
            for a, p in places:
                gone[a].update(range(p, p + k))
    out = []
    for a, (i, t, _) in enumerate(table):
        w = words(t)
        out.append((i, len(w), len(gone[a]), " ".join(x for j, x in enumerate(w) if j not in gone[a])))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", [2_000_000, 3000])
def test_substring_dedup(spark, bucket):
    got = substring.substring_dedup(frame(spark, rows()), bucket=bucket).select("payload.doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == without_repeats(rows())


def test_substring_dedup_keeps_the_input_row(spark):
    df = frame(spark, rows())
    out = substring.substring_dedup(df)
    assert out.select("payload.*").columns == df.columns and out.select("payload.*").exceptAll(df).isEmpty()
    assert substring.substring_dedup(frame(spark, [])).count() == 0


def groups(table):
    by_text = {}
    for i, t, _ in table:
        by_text.setdefault(fold(t), []).append(i)
    out = []
    for i, t, _ in table:
        ids = [x for x in by_text[fold(t)] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(by_text[fold(t)]), i == keep, hashlib.sha256(fold(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("old", ["doc_id < 15", "true", "false", "doc_id % 2 = 0", "cast(null as boolean)"])
def test_exact_dedup(spark, old):
    got = exact.exact_dedup(frame(spark, rows()), F.expr(old), shard=7).collect()
    assert sorted((tuple(r) for r in got), key=str) == groups(rows())


def test_exact_dedup_of_nothing(spark):
    assert exact.exact_dedup(frame(spark, []), F.lit(True)).count() == 0


def test_perfect_hash_is_minimal_and_refuses_others():
    rng = np.random.default_rng(5)
    digests = rng.integers(0, 256, (3000, 32), dtype=np.uint8)
    bits, sizes, slot = exact.build(digests)
    assert sorted(slot.tolist()) == list(range(3000))
    assert (exact.lookup(bits, sizes, digests) == slot).all()
    others = rng.integers(0, 256, (500, 32), dtype=np.uint8)
    at = exact.lookup(bits, sizes, others)
    by_slot = digests[np.argsort(slot)]
    assert not (by_slot[at[at >= 0]] == others[at >= 0]).all(1).any()


@pytest.mark.parametrize("wide", [False, True])
def test_extensions_compare_whole_hashes(wide):
    """Two windows of a bucket that differ above the lower 48 bits only: no repeat, while anchors may take them for one."""
    hashes = np.array([5, 5 + 2**50, 9, 9], np.uint64)
    batch = substring._emit(np.array([7]), np.array([0, 4]), hashes, np.arange(4), np.zeros(4, bool), 1, wide)
    out = substring._answer(substring._is_repeat, wide)(pa.Table.from_batches([batch]))
    at = [np.frombuffer(x, "<u4").tolist() for x in out.column("at").to_pylist() if x is not None]
    assert at == [[2, 3] if wide else [0, 1, 2, 3]]


def test_extensions_are_asked_with_whole_hashes(monkeypatch):
    monkeypatch.setattr(substring.W, "windows", lambda hashes, before, k: (np.array([5, 5 + 2**50], np.uint64), np.arange(2)))
    payload = pa.StructArray.from_arrays([pa.array([" ".join("abcdef")])], names=["text"])
    runs = pa.array([np.array([[0, 3]], "<u4").tobytes()], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array([7], pa.int64()), payload, runs], names=["row", "payload", "runs"])
    out = [x for b in substring._extensions(5, 3, 1, "text")(batch) for x in b.column("hash").to_pylist() if x is not None]
    assert [len(x) for x in out] == [16]
