"""Urls, lines, fingerprints and the classifier against plain models."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelforge.llm import fingerprint, lines, quality, urls
from labelforge.llm.queries import RULES

from .data import frame, rows

SF = "/root/testdata/sf0.01"


def test_urls(spark):
    listed = ["http://www.Example.COM/en/1?q#f", "https://example.com/en/", "http://a.example.com/en", "ftp://x.net/es/q", "http://net/fr/", "http://com",
              "http://com/", "http://xcom/", "nothing", "", None, "://", "http://a.b.c.net/fr/x/y", "http://example.com:80/en/", "http://x.net?/es/", "http://.com/", "http://com./"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(listed)] + [(None, "http://x.com/", "h", "r")] * 2, "page_id long, url string, host string, rule string")

    def judge(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        return host, path, best[2], best[3]

    want = [(i, *judge(u)) for i, u in enumerate(listed)] + [(None, *judge("http://x.com/"))] * 2
    assert sorted(map(tuple, urls.url_filter(pages, RULES).collect()), key=str) == sorted(want, key=str)
    assert urls.url_filter(pages.limit(0), RULES).count() == 0


def test_urls_of_very_many_labels_and_segments(spark):
    """Only suffixes as long as a listed host are looked at, so the work grows with the url."""
    long = [f"http://{'a.' * 100_000}www.example.com/en/x", f"http://{'.' * 100_000}net/es/", "http://" + "x" * 200_000, f"http://b.net{'/fr' * 50_000}", f"http://{'net.' * 1000}"]
    pages = spark.createDataFrame(list(enumerate(long)), "page_id long, url string")
    got = {r.page_id: r.rule for r in urls.url_filter(pages, RULES).collect()}
    assert got == {0: "www.example.com/en/", 1: "net/es/", 2: None, 3: "net/fr/", 4: None}


def test_cascade_is_exact_over_the_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = [f"k{i}" for i in range(0, 20_000, 97)] + ["absent"]
    cascade = urls.build(universe, listed)
    assert len(cascade.levels) > 1
    got = universe.select("key", *urls._hashes(F.col("key"))).toDF("key", "a", "b").collect()
    keys = np.array([(r.a, r.b) for r in got], np.int64).view(np.uint64)
    assert {r.key for r, hit in zip(got, cascade.has(keys)) if hit} == set(listed) - {"absent"}


def test_lines(spark):
    table = [(i, f"head\nbody {i}\n\nfoot\nfoot" if i % 2 else f"body {i}\nfoot", "a") for i in range(40)]
    table += [(50 + i, "head\nx", "b") for i in range(3)] + [(60, None, "a"), (61, "", "a"), (62, "head", None)] + [(70 + i, "same", None) for i in range(5)]
    out = {r.doc_id: r for r in lines.line_dedup(frame(spark, table)).collect()}
    assert out[1].text == "body 1\n" and (out[1].n_lines, out[1].n_removed) == (5, 3)
    assert out[50].text == "head\nx"  # too few pages
    assert out[60].text is None and out[60].n_lines == 0 and out[61].text == "" and out[61].n_lines == 1
    assert out[62].text == "head" and out[70].text == "" and out[70].n_removed == 1
    assert lines.line_dedup(frame(spark, [])).count() == 0


def test_copies_of_a_page_are_one_page(spark):
    table = [(i, "own head\nown body", "a") for i in range(30)] + [(30 + i, f"menu\nbody {i}", "a") for i in range(60)]
    table += [(90 + i, t, s) for i, (t, s) in enumerate([(None, "a"), (None, "a"), ("", "a"), ("", "a"), ("x", None), ("x", None)])]
    out = {r.doc_id: r for r in lines.line_dedup(frame(spark, table), distinct=True).collect()}
    assert len(out) == len(table) and all(out[i].text == "own head\nown body" for i in range(30))
    assert all((out[30 + i].text, out[30 + i].n_removed) == (f"body {i}", 1) for i in range(60))
    assert [out[90 + i].text for i in range(6)] == [t for _, t, _ in table[90:]]
    out = {r.doc_id: r for r in lines.line_dedup(frame(spark, table)).collect()}
    assert out[0].text == "" and out[0].n_removed == 2  # each row a page


def test_fingerprints(spark):
    table = [r for r in rows() if r[0] is not None][:-1]
    rng = random.Random(8)
    table += [(900 + i, "\n".join(f"Line {j}, of text {i % 2}. It is long; is it? " * 3 for j in range(900 + 40 * i)), "s") for i in range(3)]
    table += [(1000 + 3 * i, "\n".join(f"line {rng.randrange(400)}" for _ in range(rng.randrange(0, 120))), "s") for i in range(40)]
    table.sort(key=lambda r: r[0])
    def paras(t):
        return {x for x in t.split("\n") + re.split(r"\n|(?<=[.!?,;]) +", t) if x.strip(" ")}

    def near(a, b):
        a, b = paras(a), paras(b)
        return round(len(a & b) / len(a | b), 9) if a | b else 1.0

    want = []
    for j, (i, t, _) in enumerate(table):
        t, after = t or "", table[(j + 1) % len(table)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), near(t, edited), near(t, after)))
    for options in ({}, {"range_rows": 1}, {"size": 2}):
        got = fingerprint.fingerprints(frame(spark, table), **options).collect()
        assert sorted((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == sorted(want)
        by_text = {}
        for r in got:
            by_text.setdefault(dict((i, t or "") for i, t, _ in table)[r.doc_id], set()).add(r.fingerprint)
        assert all(len(x) == 1 for x in by_text.values())


def test_fingerprints_cut_versions_of_every_length_alike(spark):
    """Edits that lead from 2,000 characters or more to fewer, and long texts without line breaks."""
    def prose(start, n):
        return " ".join(f"Sentence {i} says this, and clause {i} says that." for i in range(start, start + n))

    table = [(1, "\n".join(prose(i, 3) for i in range(0, 48, 3)), "s"), (2, prose(100, 4), "s"), (3, prose(200, 60), "s"), (4, prose(300, 60), "s")]

    def paras(t):
        return {x for x in t.split("\n") + re.split(r"\n|(?<=[.!?,;]) +", t) if x.strip(" ")}

    want = {}
    for j, (i, t, _) in enumerate(table):
        after = table[(j + 1) % len(table)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        want[i] = [len(paras(t) & paras(x)) / len(paras(t) | paras(x)) for x in (edited, after)]
    assert len(table[0][1]) >= 2000 > len(table[0][1]) - len(table[0][1]) // 2 + len(table[1][1])
    got = {r.doc_id: [r.near_edited, r.near_next] for r in fingerprint.fingerprints(frame(spark, table)).collect()}
    assert got == {i: pytest.approx(x) for i, x in want.items()}
    assert all(got[i][0] > 0.3 for i in (1, 3, 4))


def test_fingerprints_of_little(spark):
    assert fingerprint.fingerprints(frame(spark, [])).count() == 0
    got = fingerprint.fingerprints(frame(spark, [(None, "ab", None)])).collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256, r.near_next) for r in got] == [(None, 2, hashlib.sha256(b"aa").hexdigest(), 1.0)]
    got = fingerprint.fingerprints(frame(spark, [(3, "ab", None), (3, "cd", None), (3, "ab", None)])).collect()
    assert sorted(r.edited_sha256 for r in got) == sorted(hashlib.sha256(x).hexdigest() for x in (b"aa", b"ac", b"ca"))


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = {k: [r.predicted == r.quality for r in out if r.quality == k] for k in (0, 1)}
    assert np.mean(right[1]) >= 0.97 and np.mean(right[0]) >= 0.6
    assert all(0 <= r.score <= 1 for r in out)


def test_quality_reads_no_labels_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.classify(docs, x).collect()} for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(0, 1), (None, 1), (3, None), (999, 1)], [(i, 1) for i in range(30)]])
def test_quality_of_odd_rows(spark, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality.classify(frame(spark, rows()), table).collect()
    assert len(out) == len(rows()) and all(0 <= r.score <= 1 for r in out)
    assert quality.classify(frame(spark, []), table).count() == 0


def test_features_ignore_the_batch():
    texts = [t for _, t, _ in rows()]
    one = np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(one, quality.features(pa.array(texts, pa.string()))) and np.isfinite(one).all()
    assert one.shape[1] == quality.FEATURES


@pytest.mark.parametrize("planted", [0.2, 0.5, 0.85])
@pytest.mark.parametrize("n, slack", [(10, 0.35), (100, 0.2), (1000, 0.08), (5000, 0.06)])
def test_planted_priors(planted, n, slack):
    """One rule for every number of rows; what few rows can tell is less."""
    found = []
    for seed in range(3 if n < 1000 else 1):
        rng = np.random.default_rng(seed)
        inside = rng.random(n) < planted
        unlabelled = np.where(inside[:, None], rng.normal(2, 1, (n, 2)), rng.normal(-2, 1, (n, 2)))
        found.append(quality.train(rng.normal(2, 1, (n, 2)), unlabelled, steps=200)[1])
    assert abs(np.mean(found) - planted) < slack, found


@pytest.mark.parametrize("n, m", [(1, 1), (1, 50), (2, 3), (50, 1), (3, 3)])
def test_few_rows_have_an_estimate(n, m):
    rng = np.random.default_rng(1)
    net, prior = quality.train(rng.normal(1, 1, (n, 2)), rng.normal(0, 1, (m, 2)), steps=50)
    assert 0.01 <= prior <= 0.99 and np.isfinite(net.margin(rng.normal(0, 1, (9, 2)))).all()


def plain_risk(net, positive, unlabelled, prior):
    """The risk and its slope by one weight, from sums over single rows."""
    loss = lambda z: float(np.log1p(np.exp(-z)))
    p, u = net.margin(positive).tolist(), net.margin(unlabelled).tolist()
    wrong = sum(loss(-z) for z in u) / len(u) - prior * sum(loss(-z) for z in p) / len(p)
    return prior * sum(loss(z) for z in p) / len(p) + max(0.0, wrong)


def test_training_lowers_the_plain_risk():
    """The net's risk, computed row by row, is near the least that small changes of its weights reach."""
    rng = np.random.default_rng(4)
    positive = rng.normal(1, 1, (400, 2))
    unlabelled = np.concatenate([rng.normal(1, 1, (300, 2)), rng.normal(-1.5, 1, (200, 2))])
    net, prior = quality.train(positive, unlabelled)
    assert abs(prior - 0.6) < 0.15
    at = plain_risk(net, positive, unlabelled, prior)
    start = plain_risk(quality.Net(np.concatenate([positive, unlabelled])), positive, unlabelled, prior)
    assert at < 0.7 * start
    for part in net.p:
        for i in range(min(3, part.size)):
            old = part.flat[i]
            for step in (-0.2, 0.2):
                part.flat[i] = old + step
                assert plain_risk(net, positive, unlabelled, prior) > at - 0.01
            part.flat[i] = old


def test_class_prior():
    rng = np.random.default_rng(1)
    pos, neg = rng.normal(1, 1, (4000, 2)), rng.normal(-2, 1, (1200, 2))
    unlabelled = np.concatenate([rng.normal(1, 1, (2800, 2)), neg])
    net, prior = quality.train(pos, unlabelled)
    assert abs(prior - 0.7) < 0.08
    assert (net.margin(neg) > 0).mean() < 0.1 and (net.margin(pos) > 0).mean() > 0.9
