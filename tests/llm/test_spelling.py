"""Spelling variants against plain models."""

import random
import re
import zlib
from collections import Counter

import pytest

from labelforge.llm import spelling
from labelforge.llm.spelling import near_words, spelling_groups, word_counts

from .data import fold, frame, rows


def counts_model(table, shortest=6, every=199):
    out = Counter()
    for i, t, _ in table:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = fold(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= shortest:
                out[w] += 1
    return out


def edits_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups_model(n, factor=5):
    near = {w: [x for x in n if edits_one(w, x)] for w in n}
    best = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in near.items() if xs}
    form = {w: x for w, x in best.items() if n[x] >= factor * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


ODD_TEXTS = ["Ünïcôdé ünïcôdé×÷ AĀbcdefgh", "ABCDEFG" * 40 + " x" + "y" * 500, "\xc0\xff" * 9, "don't re-use cóoperate", "é" * 7 + "¿" + "abcdef", "日本語abcdefg日本", "abcdef\x00ghijkl"]


@pytest.mark.parametrize("every", [199, 3, 1])
def test_word_counts(spark, every):
    table = [*rows(), *((900 + i, t, "s") for i, t in enumerate(ODD_TEXTS)), (None, "nothing known here", None)]
    got = word_counts(frame(spark, table), every=every).collect()
    assert {r.word: r.n for r in got} == counts_model(table, every=every) and len(got) == len({r.word for r in got})


def test_long_texts_are_cut_between_runs(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 64)
    rng = random.Random(3)
    for text in ["".join(rng.choice("abcé ") for _ in range(2000)), "é" * 300 + " " + "b" * 200, " " * 500]:
        data = text.encode()
        import numpy as np

        parts = list(spelling._parts(np.frombuffer(data, np.uint8), np.array([0, len(data)])))
        assert b"".join(p.tobytes() for p, _ in parts) == data
        words = [w for p, ends in parts for w in spelling.variants([5], p, ends, 199).to_pylist()]
        want = spelling.variants([5], np.frombuffer(data, np.uint8), np.array([0, len(data)]), 199).to_pylist()
        assert Counter(words) == Counter(want)


def vocabulary(seed, size, letters="abc", lengths=(1, 9)):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randrange(*lengths))): rng.choice([1, 2, 5, 25, 30, 200]) for _ in range(size)}


ODD_WORDS = {"a": 5, "": 3, "b": 30, "x" * 3000: 4, "x" * 3001: 40, "x" * 2999 + "y": 4, "\0a": 2, "a\0": 2, "ÿa": 9, "aÿ": 7, "日本語": 5, "日本誤": 50, "🙂🙂": 1, "🙂": 5}


@pytest.mark.parametrize("options", [{}, {"chunk": 5, "bucket": 60}, {"chunk": 1, "bucket": 10_000}])
def test_groups_equal_all_pairs(spark, options):
    n = {**vocabulary(1, 300), **vocabulary(2, 200, "aé", (5, 8)), **ODD_WORDS}
    got = spelling_groups(spark.createDataFrame(list(n.items()), "word string, n long"), **options).collect()
    assert len(got) == len(n) and {tuple(r) for r in got} == groups_model(n)


def test_a_group_that_holds_a_third_of_all_words(spark):
    """600 words share the first half of each, and are cut into chunks."""
    n = {f"prefix{i:03d}abc": i + 1 for i in range(600)} | vocabulary(4, 600, "abcdefgh", (6, 9))
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = spelling_groups(df, chunk=50, bucket=400).collect()
    assert {tuple(r) for r in got} == groups_model(n)


def test_chains_and_ties(spark):
    n = {"aaaaaa": 1, "baaaaa": 5, "bbaaaa": 25, "bbbaaa": 125, "aaaaab": 5, "zzzzzz": 7, "zzzzzzz": 34, "zzzzzzzz": 35}
    got = {r.word: r for r in spelling_groups(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert got["aaaaaa"].form == "aaaaab" and got["aaaaaa"].root == "aaaaab" and got["baaaaa"].root == "bbbaaa"
    assert got["zzzzzz"].form is None and got["zzzzzz"].n_near == 1


def test_nothing_and_nulls(spark):
    empty = spark.createDataFrame([], "word string, n long, form string")
    assert spelling_groups(empty).count() == 0 and near_words(empty).count() == 0 and word_counts(frame(spark, [])).count() == 0
    got = spelling_groups(spark.createDataFrame([(None, 4, "x"), ("abcdef", 3, "y")], "word string, n long, form string")).collect()
    assert [tuple(r) for r in got] == [("abcdef", None, "abcdef", 3, 0, None)]
