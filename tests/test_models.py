import collections
import math

import pytest
from pyspark.sql import functions as F

from labelforge.operators import evaluate, features, models, split
from labelforge.operators.score import parity, score
from labelforge.sources import params

TOPICS = {"sky": "moon star orbit light", "sea": "wave fish salt tide", "land": "tree soil hill path"}


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(120):
        label = ("sky", "sky", "sea", "sky", "land", "sea")[i % 6]
        words = TOPICS[label].split()
        rows.append((i, label, f"the {words[i % 4]} and {words[(i // 2) % 4]} near {words[(i * 7) % 4]} {'common' if i % 5 else 'rare'}"))
    return spark.createDataFrame(rows, "id long, label string, text string").cache()


def quotas(counts, frac):
    n = sum(counts.values())
    n_train = n - math.ceil(frac * n)
    whole = {k: c * n_train // n for k, c in counts.items()}
    rest = sorted(counts, key=lambda k: (-(counts[k] * n_train % n), k))
    for k in rest[: n_train - sum(whole.values())]:
        whole[k] += 1
    return {k: counts[k] - whole[k] for k in counts}


@pytest.mark.parametrize("frac", [0.2, 0.33, 0.01])
def test_split_quotas_are_exact_and_repeatable(spark, docs, frac):
    parts = split.stratified_split(docs, "label", "id", frac, 7)
    got = collections.Counter(r["label"] for r in parts.where("part = 'test'").collect())
    want = quotas(collections.Counter(r["label"] for r in docs.collect()), frac)
    assert {k: v for k, v in want.items() if v} == dict(got)
    again = split.stratified_split(docs.repartition(5), "label", "id", frac, 7)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, again.collect()))


def test_split_moves_no_rows(docs):
    """One class may hold most rows: its rows meet a broadcast cut and are not shuffled."""
    plan = split.stratified_split(docs, "label", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_class_weights(spark, docs):
    got = {r["label"]: r["class_weight"] for r in split.class_weights(docs, "label", {"sea": 0.7}).collect()}
    assert got == pytest.approx({"sky": 120 / (3 * 60), "sea": 0.7 * 120 / (3 * 40), "land": 120 / (3 * 20)})


def test_tfidf_against_plain_arithmetic(spark, docs):
    counts = features.term_counts(docs, "id", "text", stop_words=["the"], ngram_range=(1, 2))
    vocab = features.fit_vocabulary(docs, counts, 20)
    rows = features.tfidf(counts, vocab, "id", 20).collect()
    texts = {r["id"]: [w for w in r["text"].split() if w != "the"] for r in docs.collect()}
    grams = {i: w + [f"{a} {b}" for a, b in zip(w, w[1:])] for i, w in texts.items()}
    cf = collections.Counter(g for gs in grams.values() for g in gs)
    df = collections.Counter(g for gs in grams.values() for g in set(gs))
    top = sorted(sorted(cf, key=lambda t: (-cf[t], t))[:20])
    idf = {t: math.log(121 / (1 + df[t])) + 1 for t in top}
    want = {}
    for i, gs in grams.items():
        raw = {t: (1 + math.log(gs.count(t))) * idf[t] for t in set(gs) & set(top)}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        want |= {(i, top.index(t)): v / norm for t, v in raw.items()}
    assert {(r["id"], r["feature_idx"]): r["weight"] for r in rows} == pytest.approx(want)


@pytest.fixture(scope="module")
def fitted_features(docs):
    return models.build_features(docs, "id", "text", "label", 40, (1, 2), ["the", "and"])


def test_vectors_hold_the_weights(docs, fitted_features):
    by_doc = collections.defaultdict(dict)
    for r in fitted_features.weights.collect():
        by_doc[r["id"]][r["feature_idx"]] = r["weight"]
    for r in fitted_features.rows.collect():
        assert dict(zip(r["features"].indices, r["features"].values)) == pytest.approx(by_doc[r["id"]])
        assert r["features"].size == fitted_features.size


def test_document_without_terms_has_a_zero_vector(spark, docs):
    extra = docs.unionByName(spark.createDataFrame([(999, "sky", "!!")], docs.schema))
    feats = models.build_features(extra, "id", "text", "label", 30)
    assert feats.rows.where("id = 999").first()["features"].numNonzeros() == 0


def test_logreg_pipeline_and_export_agree(spark, docs, fitted_features, tmp_path):
    fitted = models.fit_logreg(fitted_features, "label")
    plain = fitted.pipeline.transform(fitted_features.rows)
    from pyspark.ml.functions import vector_to_array

    reference = plain.select("id", vector_to_array("probability").alias("probs"))
    scored = score(docs, fitted.params, "id", "text", tokenizer="train")
    assert parity(scored, reference, "id").first()["max_abs_diff"] < 1e-9
    assert evaluate.accuracy(plain, "label", "predicted_label").first()[0] > 0.95
    params.save_fitted(fitted, str(tmp_path))
    back = params.load_fitted(spark, str(tmp_path))
    again = score(docs, back.params, "id", "text", tokenizer="export")
    assert again.count() == 120
    assert back.pipeline.transform(fitted_features.rows).select("predicted_label").collect() == plain.select("predicted_label").collect()


def test_naive_bayes_closed_form(docs, fitted_features):
    priors, probs = models.naive_bayes_tables(fitted_features, "label", 0.1)
    assert {r["label"]: r["log_prior"] for r in priors.collect()} == pytest.approx(
        {"sky": math.log(0.5), "sea": math.log(1 / 3), "land": math.log(1 / 6)}
    )
    total = probs.groupBy("label").agg(F.sum(F.exp("log_prob")).alias("s"), F.count("*").alias("n")).collect()
    assert all(r["s"] == pytest.approx(1.0) and r["n"] == fitted_features.size for r in total)


def test_all_kinds_learn(docs, fitted_features):
    for fitted in (models.fit_ovr_svm(fitted_features, "label", max_iter=20), models.fit_naive_bayes(fitted_features, "label")):
        got = docs.join(score(docs, fitted.params, "id", "text", tokenizer="train"), "id")
        assert evaluate.accuracy(got, "label", "predicted_label").first()[0] > 0.9


def test_prompts_are_scored(spark, fitted_features):
    prompts = spark.createDataFrame([(0, "a bright moon in orbit"), (1, "fish in the salt tide"), (2, "চাঁদ")], "id long, text string")
    fitted = models.fit_naive_bayes(fitted_features, "label")
    got = {r["id"]: r["predicted_label"] for r in score(prompts, fitted.params, "id", "text").collect()}
    assert got == {0: "sky", 1: "sea", 2: "sky"}  # without a known term the largest prior wins


def test_variants(docs):
    variants = [
        {"variant_id": "first", "description": "one", "kind": "svm", "C": 1.0, "size": 30, "ngram_range": (1, 2), "tol": 1e-3},
        {"variant_id": "second", "description": "two", "kind": "nb", "alpha": 0.1, "size": 30, "ngram_range": (1, 2)},
    ]
    parts = split.stratified_split(docs, "label", "id")
    train, test = (parts.where(f"part = '{p}'").drop("part") for p in ("train", "test"))
    table = models.run_variants(train, test, "id", "text", "label", variants, ["the"], ["sky", "none"])
    rows = models.summary_table(table).collect()
    assert [r["variant_id"] for r in rows] == ["first", "second"]
    assert rows[0]["delta"] == "+0.00%" and rows[0]["acc"].endswith("%")
    assert rows[0]["none_f1"] == 0.0 and rows[0]["sky_f1"] > 0.8


def test_report_edge_cases(spark):
    pairs = [("a", "a")] * 3 + [("b", "a")] * 2 + [("c", "d")] + [("e", "e")]
    df = spark.createDataFrame(pairs, "t string, p string")
    rep = {r["label"]: tuple(r)[1:] for r in evaluate.report(df, "t", "p").collect()}
    assert rep["a"] == pytest.approx((0.6, 1.0, 0.75, 3))
    assert rep["b"] == (0.0, 0.0, 0.0, 2) and rep["d"] == (0.0, 0.0, 0.0, 0) and rep["e"] == (1.0, 1.0, 1.0, 1)
    worst = evaluate.bottom_k(evaluate.report(df, "t", "p"), 4).collect()
    assert [(r["rank"], r["label"]) for r in worst] == [(1, "b"), (2, "c"), (3, "d"), (4, "a")]
    avg = evaluate.averages(evaluate.report(df, "t", "p")).first()
    assert avg["macro_f1"] == pytest.approx(1.75 / 5) and avg["weighted_f1"] == pytest.approx((0.75 * 3 + 1) / 7)
    cm = {r["truth"]: (r["a"], r["b"]) for r in evaluate.confusion_matrix(df, "t", "p", ["a", "b"]).collect()}
    assert cm == {"a": (3, 0), "b": (2, 0)}


def test_every_kind_scores_text_after_reload_with_its_stop_words(spark, docs, tmp_path):
    feats = models.build_features(docs, "id", "text", "label", 30, (1, 2), ["near", "and"])
    for kind, fitted in (
        ("svm", models.fit_ovr_svm(feats, "label", tol=1e-3)), ("bayes", models.fit_naive_bayes(feats, "label")),
        ("logistic", models.fit_logreg(feats, "label")),
    ):
        params.save_fitted(fitted, str(tmp_path / kind))
        back = params.load_fitted(spark, str(tmp_path / kind))
        assert back.params.stop_words == ["near", "and"]
        old, new = (score(docs, p.params, "id", "text", tokenizer="train") for p in (fitted, back))
        assert parity(old, new, "id").first()["max_abs_diff"] == 0
    text = spark.read.text(str(tmp_path / "bayes" / "vocabulary")).first()[0]
    assert "near" in text and "english" not in text


def test_missing_labels_are_a_class(spark, docs):
    some = docs.withColumn("label", F.when(F.col("id") % 4 > 0, F.col("label")))
    feats = models.build_features(some, "id", "text", "label", 30)
    assert split.with_class_weight(feats.docs, "label", split.class_weights(feats.docs, "label")).count() == 120
    assert "nan" in models.fit_naive_bayes(feats, "label").params.classes
    weighted = split.with_class_weight(some, "label", split.class_weights(some, "label"))
    assert weighted.count() == 120
    parts = split.stratified_split(some, "label", "id").where("part = 'test'")
    assert parts.count() == 24 and parts.where("label IS NULL").count() == 6


def test_missing_predictions_count_as_wrong(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None)], "truth string, pred string")
    assert evaluate.accuracy(df, "truth", "pred").first()[0] == 0.5


def test_features_come_from_the_texts_alone(spark, docs, monkeypatch):
    """No long table of terms is made on the way to the solver, also where ids come twice or are missing; the weights are those of the long tables."""
    import labelforge.operators.features as f

    odd = docs.unionByName(docs.where("id % 10 = 0")).unionByName(docs.where("id % 7 = 0").withColumn("id", F.lit(None).cast("long")))
    odd = odd.unionByName(spark.createDataFrame([(999, "sky", "!!"), (3, "sea", "wave fish wave"), (5, "land", None)], docs.schema))
    counts = f.term_counts(odd, "id", "text", "train", ["the"], (1, 2), ["label"]).persist()
    old = models.build_features(odd, "id", "text", "label", 30, (1, 2), ["the"], counts)
    assert old.entries.count() and old.sparse.count()
    for where, name in ((models, "term_counts"), (models, "tfidf"), (models.topk, "top_counts")):
        monkeypatch.setattr(where, name, None)
    new = models.build_features(odd, "id", "text", "label", 30, (1, 2), ["the"])
    assert new.n_rows == old.n_rows and new.classes == old.classes
    assert sorted(map(tuple, new.vocab.collect())) == sorted(map(tuple, old.vocab.collect()))

    def entries(feats):
        return collections.Counter((r["id"], r["label"], r["feature_idx"], r["term"], round(r["weight"], 9)) for r in feats.weights.collect())

    def rows(feats):
        return collections.Counter((r["id"], r["label"], tuple(r["indices"]), tuple(round(x, 9) for x in r["values"])) for r in feats.sparse.collect())

    assert entries(new) == entries(old) and rows(new) == rows(old)
    assert sum(rows(new).values()) == odd.count() and any(i is None for i, *_ in rows(new))


def test_variants_count_the_terms_of_a_range_once(docs, monkeypatch):
    calls, top_terms = [], models.topk.top_terms
    monkeypatch.setattr(models.topk, "top_terms", lambda *a, **k: calls.append(a[2]) or top_terms(*a, **k))
    monkeypatch.setattr(models, "term_counts", None)  # no long table of terms is written
    variants = [{"variant_id": str(n), "description": "", "kind": "nb", "alpha": 0.1, "size": n, "ngram_range": (1, 2)} for n in (10, 30)]
    train, test = docs.where("id % 4 > 0"), docs.where("id % 4 = 0")
    rows = models.run_variants(train, test, "id", "text", "label", variants, ["the"], ["sky"]).collect()
    assert calls == [30] and [r["variant_id"] for r in rows] == ["10", "30"] and rows[1]["accuracy"] > 0.6
