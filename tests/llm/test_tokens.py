"""Encoding, packing and language-model scoring against the library and plain models."""

import math
import random
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelforge.llm import bpe, katz, packing

from .data import fold, frame, rows, words

ODD = [
    "", " ", "  ", "\n", "a  b", "a \n b", "à b", "à  b", "x　  a", "x  y", "don't I'LL we're", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>",
    "foo  <|startoftext|>x", "İstanbul ΣΑΣ ß", "é café ́x", "\x1c\x1d a\x85b", "1234 56,78", "tab\tnew\r\nline  ", "a" * 5000, "日本語 テキスト。" * 50,
    "ĳ ŉ ǅ Ȣ", "🙂🙂 ok", "a​b   c", "%%% ### $$$", "word.\n\nWord", "\t\t\tindent", "naïve façade coöperate",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoding_equals_the_library(name):
    e = bpe.Encoder(public_tokenizers.path(name))
    library = Tokenizer.from_file(public_tokenizers.path(name))
    for text in ODD + [t or "" for _, t, _ in rows()]:
        ids = list(struct.unpack(f"<{len(e.encode(text.encode())) // 4}I", e.encode(text.encode())))
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:80]
        if e.byte_level:
            assert e.decode(e.encode(text.encode()), step=7).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\r'abcABCéÉà 　́.,!?0123|<>_%日🙂sStTlL"), max_size=60))
def test_encoding_of_any_mixture(text):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        ids = bpe.encoder(path).encode(text.encode())
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_cuts_stand_at_pairs_inside_no_token():
    e = bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    text = "one two\nthree à b".encode()
    parts = e.cuts.split(text)
    assert b"".join(parts) == text and len(parts) >= 3
    assert all(not e.inside[a[-1], b[0]] for a, b in zip(parts, parts[1:]))


def test_encode_table(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = bpe.encode(frame(spark, rows()), path, decode=True).collect()
    assert sorted(((r.key, r.decoded) for r in got), key=str) == sorted(((i, t or "") for i, t, _ in rows()), key=str)
    assert bpe.encode(frame(spark, []), path).count() == 0


@pytest.mark.parametrize("windows", [128, 1])
def test_packing(spark, windows):
    path = public_tokenizers.path("word_bpe_49k.json")
    table = [r for r in rows() if r[0] is not None][:-1]
    pieces = packing.pack(frame(spark, table), path, windows_per_group=windows).collect()
    library = Tokenizer.from_file(path)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t, _ in table}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        cut = ids[p.doc_id][p.start : p.start + p.length]
        assert len(cut) == p.length and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, cuts in by_doc.items():
        at = 0
        for start, length in sorted(cuts):
            assert start == at
            at += length
        assert at == len(ids[i])
    assert set(by_doc) == set(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= 4096
    assert packing.pack(frame(spark, []), path).count() == 0


def test_repeated_rows_and_null_ids_are_packed(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(frame(spark, [(1, "a b", None)] * 3 + [(None, None, None)]), path)
    assert sorted((r.doc_id or 0, r.length) for r in got.collect()) == [(0, 1), (1, 3), (1, 3), (1, 3)]


def test_windows_are_full_and_even():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 1024) for _ in range(1000)]
    packed = packing.windows(sizes, 4096)
    assert sorted(i for w in packed for i in w) == list(range(1000))
    sums = [sum(sizes[i] for i in w) for w in packed]
    assert max(sums) <= 4096 and sum(sums) / (4096 * len(sums)) > 0.98 and max(sums) - min(sums) < 200


def katz_model(table, train):
    """Discounts, back-off weights and probabilities, pair by pair."""
    seqs = [words(fold(t)) + ["</s>"] for _, t, _ in table]
    uni, pairs = Counter(), Counter()
    for s, learn in zip(seqs, train):
        if learn:
            uni.update(s)
            pairs.update(zip(["<s>", *s], s))
    n, d1, d2 = sum(uni.values()), *({r: x for r, x in enumerate(katz.discounts([list(c.values()).count(i) for i in range(1, 7)]))} for c in (uni, pairs))
    lost = sum((1 - d1[min(c, 6)]) * c for c in uni.values())
    flat = lost / n < 1e-12
    unknown = 1 / (n + 1) if flat else lost / n
    p1 = lambda w: (uni[w] * d1[min(uni[w], 6)] / n * (n / (n + 1) if flat else 1)) if w in uni else unknown
    after = {}
    for (v, w), c in pairs.items():
        after.setdefault(v, {})[w] = c

    def p2(v, w):
        seen = after.get(v)
        if not seen:
            return p1(w)
        c = sum(seen.values())
        left = sum((1 - d2[min(x, 6)]) * x for x in seen.values()) / c
        scale = 1
        if left < 1e-12:
            left, scale = 1 / (c + 1), c / (c + 1)
        if w in seen:
            return scale * d2[min(seen[w], 6)] * seen[w] / c
        return left / (1 - sum(map(p1, seen))) * p1(w)

    return seqs, uni, n, p1, p2, unknown


@pytest.mark.parametrize("options", [{}, {"bucket": 500, "head_words": 20, "split_words": 5}, {"bucket": 2000, "head_words": 0}])
def test_katz_scores(spark, options):
    rng = random.Random(4)
    table = [(i, " ".join(rng.choices([f"t{j}" for j in range(60)], [1 / (j + 1) for j in range(60)], k=rng.randrange(0, 90))), "s") for i in range(60)]
    table += [(100, None, None), (101, "", None), (102, "NEVER seen t1 T2", None), (None, "t1 t2", None), (5, "t1", None)]
    train = [i is not None and i % 7 != 2 for i, _, _ in table]
    seqs, uni, n, _, p2, _ = katz_model(table, train)
    want = []
    for (i, _, _), s, learn in zip(table, seqs, train):
        base = sum(math.log10((uni[w] + 1) / (n + len(uni) + 1)) for w in s)
        want.append((i, not learn, len(s), sum(w in uni for w in s), n, round(base, 6), round(sum(math.log10(p2(v, w)) for v, w in zip(["<s>", *s], s)), 6)))
    got = katz.katz_scores(frame(spark, table), F.col("doc_id") % 7 != 2, **options).collect()
    assert sorted(((*r[:5], round(r[5], 6), round(r[6], 6)) for r in got), key=str) == sorted(want, key=str)


def test_katz_scores_do_not_depend_on_the_batch(spark):
    """A batch with more rows than a slice can number is cut."""
    table = spark.range(70_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), (F.col("id") % 5).cast("string")).alias("text"))
    table = table.coalesce(1).cache()
    got = []
    for n in (1_000, 10_000, 100_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
        try:
            rows = katz.katz_scores(table, F.col("doc_id") % 7 != 2).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        got.append(sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in rows))
    assert got[0] == got[1] == got[2] and len(got[0]) == 70_000


def test_katz_is_normalised():
    rng = random.Random(4)
    table = [(i, " ".join(rng.choices([f"t{j}" for j in range(40)], [1 / (j + 1) for j in range(40)], k=50)), "s") for i in range(40)]
    _, uni, _, p1, p2, unknown = katz_model(table, [True] * 40)
    assert abs(sum(map(p1, uni)) + unknown - 1) < 1e-9
    for v in ("t0", "t1", "t20", "<s>", "never"):
        assert abs(sum(p2(v, w) for w in uni) + p2(v, "unseen word") - 1) < 1e-9


def test_katz_of_nothing(spark):
    assert katz.katz_scores(frame(spark, []), F.lit(True)).count() == 0
    got = katz.katz_scores(frame(spark, [(1, "a b", None)]), F.lit(False)).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.score) for r in got] == [(True, 3, 0, 0, 0.0)]
