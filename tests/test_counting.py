"""Counting in parts, against plain Python."""

import collections
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from labelforge.functions import html as H
from labelforge.operators import counting, features, score, topk

TEXTS = ["a bb cc bb cc", "", "x_1 été-bb  cc", "a b c", "bb cc bb"]


@pytest.mark.parametrize("size,most", [(1_000_000, 200_000), (4, 2)])
@pytest.mark.parametrize("how", ["number", "name"])
def test_terms_of_rows_in_parts_of_any_size(monkeypatch, size, most, how):
    monkeypatch.setattr(counting, "BYTES", size)
    monkeypatch.setattr(counting, "WORDS", most)
    if how == "name":
        monkeypatch.setattr(counting, "_by_number", lambda rows, parts, names, base: counting._by_name(rows, parts, names))
    got, largest = Counter(), 0
    for first, words in counting.word_lists(pa.array(TEXTS), "train"):
        largest = max(largest, len(words))
        for row, term, n in counting.row_terms(words, 1, 2, pa.array(["été"])):
            got.update({(first + r, t): int(k) for r, t, k in zip(row.tolist(), term.to_pylist(), n)})
    want = Counter()
    for i, words in enumerate([["bb", "cc", "bb", "cc"], [], ["x_1", "bb", "cc"], [], ["bb", "cc", "bb"]]):
        want.update((i, w) for w in words)
        want.update((i, f"{a} {b}") for a, b in zip(words, words[1:]))
    assert got == want and (size > 4 or largest < len(TEXTS))


def test_pages_become_python_strings_a_part_at_a_time(monkeypatch):
    monkeypatch.setattr(H, "BYTES", 10)
    seen = []
    texts = pa.array(["abcdef", None, "xyz", "", "long enough for a part of its own", "q"])
    real = pa.array
    monkeypatch.setattr(H.pa, "array", lambda x, *a: (seen.append(len(x)), real(x, *a))[1])
    assert H._by_parts(str.upper, pa.string())(texts).to_pylist() == ["ABCDEF", None, "XYZ", "", "LONG ENOUGH FOR A PART OF ITS OWN", "Q"]
    assert len(seen) > 1 and sum(seen) == len(texts)
    assert H._by_parts(str.upper, pa.string())(texts[:0]).to_pylist() == []


@pytest.mark.parametrize("wide", [False, True])
def test_terms_over_all_rows(monkeypatch, wide):
    """The same occurrences and rows as term by term of each row, also where runs have no numbers of 62 bits."""
    texts = ["a b a b a", "", "b a b", "c", "a b"] + [f"w{i} w{i + 1}" for i in range(40)]
    words = pa.array([t.split() for t in texts], pa.list_(pa.string()))
    want = collections.defaultdict(lambda: [0, 0])
    for t in texts:
        grams = [" ".join(t.split()[i : i + n]) for n in (1, 2, 12 if wide else 3) for i in range(len(t.split()) - n + 1)]
        for g, n in collections.Counter(grams).items():
            want[g][0] += n
            want[g][1] += 1
    got = collections.defaultdict(lambda: [0, 0])
    for n in (1, 2, 12 if wide else 3):
        for term, cf, df in counting.all_terms(words, n, n):
            for g, c, d in zip(term.to_pylist(), cf.tolist(), df.tolist(), strict=True):
                got[g][0] += c
                got[g][1] += d
    assert got == want


def test_vocabulary_reads_texts_once(spark):
    """The vocabulary of term counts is made from their texts in one pass, and from other rows as they are."""
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None), (4, "a b")], "id long, text string")
    counts = features.term_counts(docs, "id", "text", "export", (), (1, 2), keep_empty=True)
    plan = topk.top_terms(*counts._texts[:2], 3, **counts._texts[2])
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(plan) == rows(topk.top_counts(counts, 3)) == [("a", 3, 2), ("a b", 2, 2), ("b", 3, 3)]
    assert rows(features.fit_vocabulary(docs, counts, 3)) == rows(features.fit_vocabulary(docs, counts.where("true"), 3))
    few = counts.where("id > 1")
    assert not hasattr(few, "_texts") and [r.term for r in features.fit_vocabulary(docs, few, 1).collect()] == ["b"]


def test_known_terms_of_rows(spark):
    """Terms of one to three words, also where a longer one has no shorter one at its front, and other terms stay in the worker."""
    docs = spark.createDataFrame(
        [(1, "a b a b c"), (2, "c c"), (3, None), (None, "b c the a"), (1, "zz a"), (5, "zz")], "id long, text string")
    terms = ["a", "a b", "b c d", "a b c", "c c", "", "zz top", "b a"]
    got = features.known_counts(docs, "id", "text", terms, "export", ["the"], (1, 3)).collect()
    want = [(1, "a", 2), (1, "a b", 2), (1, "b a", 1), (1, "a b c", 1), (2, "c c", 1), (None, "a", 1), (1, "a", 1), (3, None, None), (5, None, None)]
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.id, None if r.place is None else terms[r.place], r.n) for r in got), key=key) == sorted(want, key=key)
    assert features.known_counts(docs, "id", "text", [], "export", (), (1, 2)).where("place IS NULL").count() == 6


@pytest.mark.parametrize("mode", ["train", "export"])
def test_scores_by_numbers_and_by_terms(spark, monkeypatch, mode):
    """One score for each id, with repeated ids and terms, and NULLs; only rows of known terms meet the join."""
    docs = spark.createDataFrame([(1, "aa bb aa bb cc"), (1, "bb"), (None, "aa"), (None, "cc"), (2, None), (3, "xx")], "id long, text string")
    rows = [("aa", 1.0, [1.0, 0.5]), ("aa bb", 2.0, [0.25, None]), ("aa bb", 1.5, [0.0, 1.0]), (None, 1.0, [1.0, 1.0]), ("cc", None, [1.0, 1.0]), ("bb", 0.5, [-1.0, 3.0])]
    params = score.LinearParams(["x", "y"], [0.0, 0.1], spark.createDataFrame(rows, "term string, idf double, coef array<double>"), len(rows), stop_words=["bb"])
    got = {r[0]: r[1:] for r in score.score(docs, params, "id", "text", mode).collect()}
    monkeypatch.setattr(score, "HELD", 0)
    assert got == {r[0]: r[1:] for r in score.score(docs, params, "id", "text", mode).collect()} and got.keys() == {1, 2, 3, None}


@pytest.mark.parametrize("mode", list(counting.WORD_PATTERNS))
def test_words_are_found_by_their_bytes(monkeypatch, mode):
    """Characters of one to four bytes, in slices and by parts, as the pattern finds them."""
    monkeypatch.setattr(counting, "BYTES", 50)
    letters = counting.WORD_PATTERNS[mode].partition("]")[0] + "]"
    rng = np.random.default_rng(5)
    texts = pa.array(["", "é", "_", "", "漢", *("".join(rng.choice(list("aZé_ 9\tßœ漢字िक्́😀𝒳٣½ ‍.-Ⅷº\0"), 12)) for _ in range(300)), ""]).slice(1)
    least = 2 if counting.WORD_PATTERNS[mode].endswith("{2,}") else 1
    lists = counting.pc.split_pattern_regex(texts, letters.replace("[", "[^") + "+").to_pylist()
    assert [w for _, part in counting.word_lists(texts, mode) for w in part.to_pylist()] == [[w for w in row if len(w) >= least] for row in lists]
