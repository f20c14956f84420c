"""Language identification against a plain model, and on held-out rows."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelforge.llm import language
from labelforge.llm.language import code_lengths, identify, learn, train

from .data import frame, rows

SF = "/root/testdata/sf0.01"


class Plain:
    """Contexts of up to ``order`` bytes, byte by byte, with no shared tables."""

    def __init__(self, texts, order):
        self.order, self.after = order, defaultdict(Counter)
        for t in texts:
            data = b"\n" * order + t.encode()
            for i in range(order, len(data)):
                for k in range(order + 1):
                    self.after[data[i - k : i]][data[i]] += 1

    def chances(self, context):
        """Probability of each of the 256 bytes."""
        lower = self.chances(context[1:]) if context else [1 / 256] * 256
        seen = self.after.get(context)
        if not seen:
            return lower
        n, d = sum(seen.values()), len(seen)
        left = 1 - sum(lower[b] for b in seen)
        return [seen[b] / (n + d) if b in seen else d / (n + d) * lower[b] / left for b in range(256)]

    def bits(self, text):
        data = b"\n" * self.order + text.encode()
        return -sum(math.log2(self.chances(data[i - self.order : i])[data[i]]) for i in range(self.order, len(data)))


def some_texts(seed, letters, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(n)]


def fitted(sets, order):
    counts = []
    for texts in sets:
        data = "".join(texts).encode()
        offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
        counts.append(np.unique(language._windows(np.frombuffer(data, np.uint8), offsets, order), return_counts=True))
    return train([f"l{i}" for i in range(len(sets))], counts, order)


SETS = [some_texts(1, "abc é.", 12), some_texts(2, "abd \n", 9), ["zzzz zz z", "\n\n"], ["日本語 テキスト"]]


@pytest.mark.parametrize("order", [0, 1, 2, 4, 7])
def test_code_lengths_equal_a_plain_model(order):
    model = fitted(SETS, order)
    texts = some_texts(3, "abcdé. \nz", 12) + ["q", "日本", "ab" * 40, "\n\n\n", "z"]
    want = [[Plain(s, order).bits(t) for s in SETS] for t in texts]
    assert np.allclose(code_lengths(model, pa.array(texts)), want, rtol=1e-5, atol=1e-4)
    assert np.allclose(code_lengths(model, pa.array([None, ""], pa.string())), 0)


def test_probabilities_add_up_to_one():
    model = fitted(SETS, 3)
    for context in (b"abc", b"zzz", b"\n\n\n", b"xyz", b"xya", "日".encode()):
        windows = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert np.allclose(np.exp2(-model.prices(windows)).sum(0), 1, atol=1e-4)


def test_long_texts_are_priced_in_parts(monkeypatch):
    model = fitted(SETS, 4)
    texts = pa.array(["ab c" * 100, "x", "日本語" * 30, ""])
    whole = code_lengths(model, texts)
    monkeypatch.setattr(language, "SLICE", 17)
    assert np.allclose(code_lengths(model, texts), whole)


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = identify(docs).select("held_out", "lang", "lang_pred", "score").collect()
    right = [r.lang == r.lang_pred for r in out if r.held_out]
    assert len(right) > 150 and np.mean(right) >= 0.98 and all(0 <= r.score <= 1 for r in out)


def test_held_out_rows_and_other_columns_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in identify(x).collect()} for x in (docs, other))
    assert a == b


def test_odd_rows(spark):
    table = frame(spark, rows()).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "aa").when(F.col("doc_id") % 3 == 1, "bb")).withColumn("score", F.lit("x"))
    out = identify(table).collect()
    assert len(out) == len(rows()) and all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out if r.text is None or not any(c.isalpha() for c in r.text)} == {"und"}
    assert {r.lang_pred for r in out if r.text and any(c.isalpha() for c in r.text)} <= {"aa", "bb"}
    assert not [r for r in out if r.doc_id is None and r.held_out]
    assert identify(table.limit(0)).count() == 0
    none = identify(table.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_the_sample_is_bounded_and_does_not_depend_on_the_order(spark):
    table = frame(spark, [(i, f"word{i} and more", "s") for i in range(200)] + [(7, "same text", "s")] * 50)
    table = table.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb"))
    a = learn(table, sample=20)
    b = learn(table.orderBy(F.desc("doc_id")).repartition(3), sample=20)
    assert a.langs == ["aa", "bb"] and all(np.array_equal(x, y, equal_nan=True) for x, y in zip(a.bits, b.bits))
    rows_read = np.exp2(-a.bits[1]) > 0
    assert rows_read.all() and learn(table, sample=20, longest=5).langs == []


def test_ties_go_to_the_least_language(spark):
    model = fitted([SETS[0], SETS[0]], 3)
    got = frame(spark, rows()).select(language.language(model, F.col("text")).alias("x")).select("x.*").collect()
    assert {(r.lang_pred, r.score) for r in got} == {("l0", 0.5), ("und", 0.0)}
