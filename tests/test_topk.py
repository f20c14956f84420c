"""Corpus counts and the most frequent terms against plain counting."""

import random
from collections import Counter

import pytest

from labelforge.operators import topk


def final_plan(df):
    df.collect()  # adaptive execution fixes the plan while it runs
    return df._jdf.queryExecution().executedPlan().toString()


def plain(texts, lo, hi):
    cf, df = Counter(), Counter()
    for t in texts:
        w = [x for x in (t or "").split()]
        grams = [" ".join(w[i : i + n]) for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]
        cf.update(grams)
        df.update(set(grams))
    return cf, df


def some_texts(seed=1, n=120):
    rng = random.Random(seed)
    words = [f"w{i:02d}" for i in range(60)]
    return [" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randrange(0, 30))) for _ in range(n)] + [None, "", "w00", "w00 w00 w00"]


def table(spark, texts, parts=5):
    return spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)


@pytest.mark.parametrize("lo, hi", [(1, 1), (1, 2), (2, 3)])
@pytest.mark.parametrize("held", [1_000_000, 40])
def test_corpus_stats(spark, lo, hi, held):
    cf, df = plain(some_texts(), lo, hi)
    got = topk.corpus_stats(table(spark, some_texts()), "text", ngram_range=(lo, hi), held=held).collect()
    assert {r.term: (r.cf, r.df) for r in got} == {t: (cf[t], df[t]) for t in cf} and len(got) == len(cf)


@pytest.mark.parametrize("size", [1, 7, 25, 60, 5000])
@pytest.mark.parametrize("held", [1_000_000, 40])
def test_top_terms_and_ties_at_the_edge(spark, size, held):
    texts = some_texts() + ["tie1 tie2 tie3 tie4"] * 9
    cf, df = plain(texts, 1, 2)
    want = sorted(cf, key=lambda t: (-cf[t], t))[:size]
    got = topk.top_terms(table(spark, texts), "text", size, ngram_range=(1, 2), held=held).collect()
    assert [(r.term, r.cf, r.df) for r in got] == [(t, cf[t], df[t]) for t in want]


def test_a_term_that_no_head_holds_is_found(spark):
    """Second in every list, first overall."""
    parts = [" ".join([f"own{i}"] * 5 + ["common"] * 4) for i in range(4)]
    df = spark.createDataFrame([(t,) for t in parts], "text string").repartition(4)
    assert topk.top_terms(df, "text", 1).first().term == "common"


def test_rare_terms_do_not_travel(spark):
    """10,000 terms that occur once stay where they were counted."""
    texts = [" ".join(f"once{i}" for i in range(j * 100, j * 100 + 100)) + " often" * 50 + " again" * 40 for j in range(100)]
    lists = topk.stored(topk.term_lists(table(spark, texts), "text", size=2), "lists")
    kept = topk.survivors(lists, 2)
    assert {r.term for r in kept.select("term").distinct().collect()} == {"often", "again"}
    assert lists.count() > 10_000
    plan = final_plan(topk._summed(kept))
    assert "BroadcastHashJoin" in plan and plan.index("BroadcastHashJoin") > plan.index("Exchange hashpartitioning(term")


def test_no_rows(spark):
    assert topk.top_terms(table(spark, [], 1), "text", 5).count() == 0 and topk.corpus_stats(table(spark, [None, ""]), "text").count() == 0


@pytest.mark.parametrize("size", [1, 7, 25, 500])
@pytest.mark.parametrize("buckets", [16, 64, 1 << 12])
def test_top_terms_by_crowded_buckets(spark, size, buckets):
    """A bound from buckets that many terms share is too high, and terms below it are still found; all ties are seen."""
    texts = some_texts() + ["tie1 tie2 tie3 tie4"] * 9
    cf, df = plain(texts, 1, 2)
    want = sorted(cf, key=lambda t: (-cf[t], t))[:size]
    counts = topk.bucket_counts(table(spark, texts), "text", ngram_range=(1, 2), buckets=buckets)
    assert len(counts) == buckets and counts.sum() == sum(cf.values())
    got = topk.top_terms(table(spark, texts), "text", size, ngram_range=(1, 2), buckets=buckets).collect()
    assert [(r.term, r.cf, r.df) for r in got] == [(t, cf[t], df[t]) for t in want]


def test_rare_terms_are_not_written(spark, monkeypatch):
    """Of 10,000 terms that occur once, those in a bucket with others at most become rows."""
    texts = [" ".join(f"once{i}" for i in range(j * 100, j * 100 + 100)) + " often" * 50 + " again" * 40 + " third" * 30 + " last" * 20 for j in range(100)]
    written = []

    def stored(df, name="stage", plain=topk.stored):
        out = plain(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(topk, "stored", stored)
    assert [r.term for r in topk.top_terms(table(spark, texts), "text", 2).collect()] == ["often", "again"]
    assert written and max(written) < 100
