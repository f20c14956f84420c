"""Split, weights, training, evaluation and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, features, models, rules, score, split
from . import sqltext as S
from .feature_queries import STOP, WEIGHTS_SQL, grams_sql, vocab_sql
from .registry import query
from .text_queries import documents, texts

TERMS = 10_000
# The grid of the comparison query: kinds, penalties, sizes and ranges.  Linear variants of the same features share their passes.
GRID = (
    {"variant_id": "svm", "description": "one-vs-rest SVM", "kind": "svm", "C": 1.0, "size": TERMS, "ngram_range": (1, 2)},
    {"variant_id": "svm-strict", "description": "one-vs-rest SVM, strong penalty", "kind": "svm", "C": 0.25, "size": TERMS, "ngram_range": (1, 2)},
    {"variant_id": "svm-phrases", "description": "one-vs-rest SVM, up to three words", "kind": "svm", "C": 1.0, "size": TERMS, "ngram_range": (1, 3)},
    {"variant_id": "svm-small", "description": "one-vs-rest SVM, fewer terms", "kind": "svm", "C": 1.0, "size": TERMS // 4, "ngram_range": (1, 2)},
    {"variant_id": "bayes", "description": "naive Bayes", "kind": "nb", "alpha": 0.1, "size": TERMS, "ngram_range": (1, 2)},
    {"variant_id": "logistic", "description": "logistic regression", "kind": "logreg", "C": 1.0, "size": TERMS, "ngram_range": (1, 2)},
)
CLASSES = ("de", "en", "es", "fr")
GUESS = (
    ("en", rules.word_edges("the|and|of")),
    ("fr", rules.word_edges("le|les|des")),
    ("de", rules.word_edges("der|die|das")),
)
TRACKED = ("fr", "es", "nl")

SPLIT_SQL = """class_n AS (SELECT lang, count(*) AS n_c, (sum(count(*)) OVER ())::BIGINT AS n FROM documents GROUP BY lang),
shared AS (SELECT *, (n - ceil(n * 0.2))::BIGINT AS n_train FROM class_n),
floors AS (SELECT *, n_c * n_train // n AS whole, n_c * n_train % n AS rest FROM shared),
quota AS (SELECT lang, n_c - whole - (row_number() OVER (ORDER BY rest DESC, lang)
    <= n_train - sum(whole) OVER ())::BIGINT AS n_test FROM floors),
parts AS (SELECT d.*, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '42'), doc_id) <= n_test
    THEN 'test' ELSE 'train' END AS part FROM documents d JOIN quota USING (lang))"""


@query(f"WITH {SPLIT_SQL} SELECT doc_id, lang, part FROM parts")
def stratified_split(spark, sf):
    return split.stratified_split(documents(spark, sf).select("doc_id", "lang"), "lang", "doc_id")


@query("""SELECT lang, count(*) AS n_c, round(sum(count(*)) OVER () / (count(*) OVER () * count(*))
    * CASE lang WHEN 'fr' THEN 0.7 ELSE 1.0 END, 6) AS class_weight FROM documents GROUP BY lang""")
def class_weights(spark, sf):
    return split.class_weights(documents(spark, sf), "lang", {"fr": 0.7}).withColumn(
        "class_weight", F.round("class_weight", 6)
    )


def pairs(spark, sf):
    """True language and the one a few stop words suggest."""
    guess = F.coalesce(rules.pattern_label("text", GUESS), F.lit("es"))
    return texts(spark, sf).select("doc_id", F.col("lang").alias("truth"), guess.alias("pred"))


PAIRS_SQL = f"pairs AS (SELECT doc_id, lang AS truth, {S.case_patterns('text', GUESS, chr(39) + 'es' + chr(39))} AS pred FROM documents)"
REPORT_SQL = f"""{PAIRS_SQL},
sides AS (SELECT truth AS label, 1 AS support, 0 AS predicted, (truth = pred)::INT AS hit FROM pairs
    UNION ALL SELECT pred, 0, 1, 0 FROM pairs),
sums AS (SELECT label, sum(support)::BIGINT AS support, sum(predicted)::BIGINT AS predicted, sum(hit)::BIGINT AS hits FROM sides GROUP BY label),
rep AS (SELECT label, CASE WHEN predicted = 0 THEN 0.0 ELSE hits::DOUBLE / predicted END AS precision,
    CASE WHEN support = 0 THEN 0.0 ELSE hits::DOUBLE / support END AS recall,
    2.0::DOUBLE * hits / (support + predicted) AS f1, support FROM sums)"""


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(f"WITH {PAIRS_SQL} SELECT truth, " + ", ".join(f"count(*) FILTER (pred = '{c}') AS {c}" for c in CLASSES)
       + " FROM pairs GROUP BY truth")
def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(pairs(spark, sf), "truth", "pred", CLASSES)


@query(f"WITH {PAIRS_SQL} SELECT round(avg((truth = pred)::INT), 6) AS accuracy FROM pairs")
def accuracy(spark, sf):
    return _rounded(evaluate.accuracy(pairs(spark, sf), "truth", "pred"), "accuracy")


@query(f"WITH {REPORT_SQL} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep")
def classification_report(spark, sf):
    return _rounded(evaluate.report(pairs(spark, sf), "truth", "pred"), "precision", "recall", "f1")


AVERAGES = ("precision", "recall", "f1")


@query(f"WITH {REPORT_SQL} SELECT " + ", ".join(
    [f"round(avg({c}), 6) AS macro_{c}" for c in AVERAGES]
    + [f"round(sum({c} * support) / sum(support), 6) AS weighted_{c}" for c in AVERAGES]) + " FROM rep")
def macro_weighted_avg(spark, sf):
    avg = evaluate.averages(evaluate.report(pairs(spark, sf), "truth", "pred"))
    return _rounded(avg, *avg.columns)


@query(f"WITH {REPORT_SQL} SELECT row_number() OVER (ORDER BY f1, label) AS rank, label, round(f1, 6) AS f1, support FROM rep ORDER BY rank LIMIT 2")
def bottom_k_f1(spark, sf):
    worst = evaluate.bottom_k(evaluate.report(pairs(spark, sf), "truth", "pred"), 2)
    return _rounded(worst, "f1").withColumn("rank", F.col("rank").cast("bigint"))


@query(f"WITH {REPORT_SQL} SELECT label, round(coalesce(f1, 0), 6) AS f1 FROM {S.values_table(TRACKED, 'label')} LEFT JOIN rep USING (label)")
def target_category_f1(spark, sf):
    return _rounded(evaluate.category_f1(evaluate.report(pairs(spark, sf), "truth", "pred"), TRACKED), "f1")


def formula_params(spark, sf) -> score.LinearParams:
    """Parameters over the top terms with coefficients from a formula."""
    d = texts(spark, sf)
    counts = features.term_counts(d, "doc_id", "text", "export", (), (1, 2))
    coef = F.array(*[((c * 31 + F.col("feature_idx") * 17) % 13 - 6) / 10.0 for c in range(len(CLASSES))])
    terms = features.fit_vocabulary(d, counts, TERMS).withColumn("coef", coef)
    return score.LinearParams(list(CLASSES), [c / 10.0 for c in range(len(CLASSES))], terms, TERMS)


SCORE_SQL = f"""WITH {vocab_sql(grams_sql(mode='export'), TERMS)}, {WEIGHTS_SQL},
classes AS (SELECT * FROM (VALUES (0, 'de'), (1, 'en'), (2, 'es'), (3, 'fr')) v(c, name)),
dots AS (SELECT doc_id, c, sum(weight * ((c * 31 + feature_idx * 17) % 13 - 6) / 10.0::DOUBLE) AS s FROM weights, classes GROUP BY doc_id, c),
scores AS (SELECT d.doc_id, c, name, coalesce(s, 0) + c / 10.0::DOUBLE AS s FROM documents d CROSS JOIN classes LEFT JOIN dots USING (doc_id, c)),
probs AS (SELECT *, exp(s - max(s) OVER w) / sum(exp(s)) OVER w * exp(max(s) OVER w) AS p FROM scores WINDOW w AS (PARTITION BY doc_id))"""


@query(SCORE_SQL + """ SELECT doc_id, name AS predicted_label, round(p, 6) AS confidence FROM probs
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(p, 12) DESC, c) = 1""")
def score_linear_softmax(spark, sf):
    scored = score.score(texts(spark, sf), formula_params(spark, sf), "doc_id", "text")
    return scored.select("doc_id", "predicted_label", F.round("confidence", 6).alias("confidence"))


@query(SCORE_SQL + " SELECT doc_id, name AS label, round(p, 6) AS probability FROM probs")
def score_probability_map(spark, sf):
    params = formula_params(spark, sf)
    scored = score.probability_map(score.score(texts(spark, sf), params, "doc_id", "text"), params)
    return scored.select("doc_id", F.explode("probabilities").alias("label", "p")).select(
        "doc_id", "label", F.round("p", 6).alias("probability")
    )


def split_documents(spark, sf):
    whole = split.stratified_split(texts(spark, sf).select("doc_id", "lang", "text"), "lang", "doc_id")
    return whole.where("part = 'train'").drop("part"), whole.where("part = 'test'").drop("part")


def _predicted(test, fitted, places=4):
    predicted = score.score(test, fitted.params, "doc_id", "text", tokenizer="train")
    return test.select("doc_id", F.col("lang").alias("truth")).join(predicted, "doc_id").select(
        "doc_id", "truth", "predicted_label", F.round("confidence", places).alias("confidence")
    )


NB_SQL = f"""WITH {SPLIT_SQL}, train AS (SELECT * FROM parts WHERE part = 'train'), test AS (SELECT * FROM parts WHERE part = 'test'),
{vocab_sql(grams_sql('train'), TERMS, 'train')}, {WEIGHTS_SQL},
sums AS (SELECT lang, feature_idx, sum(weight) AS w FROM weights JOIN train USING (doc_id) GROUP BY lang, feature_idx),
filled AS (SELECT l.lang, v.feature_idx, v.term, v.idf, coalesce(w, 0) AS w FROM (SELECT DISTINCT lang FROM train) l
    CROSS JOIN vocab v LEFT JOIN sums USING (lang, feature_idx)),
logp AS (SELECT lang, term, idf, ln((w + 0.1::DOUBLE) / (sum(w) OVER (PARTITION BY lang) + 0.1::DOUBLE * (SELECT count(*) FROM vocab))) AS lp FROM filled),
prior AS (SELECT lang, ln(count(*)::DOUBLE / (SELECT count(*) FROM train)) AS lprior FROM train GROUP BY lang),
tt AS (SELECT doc_id, term, (1.0::DOUBLE + ln(count(*)::DOUBLE)) AS tf FROM ({grams_sql('test')}) GROUP BY doc_id, term),
tw AS (SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS x FROM tt JOIN vocab USING (term)),
ts AS (SELECT t.doc_id, p.lang, any_value(t.lang) AS truth, any_value(lprior) + coalesce(sum(x * lp), 0) AS s
    FROM test t CROSS JOIN prior p LEFT JOIN (SELECT doc_id, x, lp, logp.lang FROM tw JOIN logp USING (term)) d
    ON d.doc_id = t.doc_id AND d.lang = p.lang GROUP BY t.doc_id, p.lang)
SELECT doc_id, truth, lang AS predicted_label, round(1 / sum(exp(s - ms)) , 4) AS confidence FROM (
    SELECT a.doc_id, a.truth, b.s, first_value(a.lang) OVER w AS lang, max(b.s) OVER (PARTITION BY a.doc_id) AS ms, a.lang AS l1, b.lang AS l2
    FROM ts a JOIN ts b USING (doc_id) WHERE a.lang = b.lang WINDOW w AS (PARTITION BY a.doc_id ORDER BY a.s DESC, a.lang))
GROUP BY doc_id, truth, lang"""


@query(NB_SQL)
def train_naive_bayes(spark, sf):
    train, test = split_documents(spark, sf)
    feats = models.build_features(train, "doc_id", "text", "lang", TERMS, (1, 2), STOP)
    return _predicted(test, models.fit_naive_bayes(feats, "lang"))


def _classes(text: str, sep: str = ", ") -> str:
    return sep.join(text.format(i=i) for i in range(len(CLASSES)))


def linear_sql(slope: str, penalised: str, weight: str, terms: int, low: str, high: str, rounds: int = 1600) -> str:
    """Tables that find the optimum of a linear model by themselves: accelerated gradient steps over all classes.

    ``slope`` is the derivative of a row's loss by the margin ``m{i}`` of class ``i``, where ``k`` is its class and
    ``w`` its weight.  ``low`` and ``high`` bound the curvature along terms and intercepts, by the number of rows
    ``n``.  ``best`` holds the coefficients ``w{i}`` by feature, the intercepts at -1.
    """
    step = f"(CASE WHEN s.f < 0 THEN 1 / ({high}) ELSE 1 / ({low}) END)"
    momentum = f"(sqrt({low}) - 1) / (sqrt({low}) + 1)"
    return f"""WITH RECURSIVE {SPLIT_SQL}, train AS (SELECT * FROM parts WHERE part = 'train'), test AS (SELECT * FROM parts WHERE part = 'test'),
{vocab_sql(grams_sql('train'), terms, 'train')}, {WEIGHTS_SQL},
kw AS (SELECT lang, count(*) AS n_train, sum(count(*)) OVER () / (count(*) OVER () * count(*)) * {weight} AS w FROM train GROUP BY lang),
lab AS MATERIALIZED (SELECT doc_id, list_position({list(CLASSES)}, lang) - 1 AS k, w FROM train JOIN kw USING (lang)),
size AS (SELECT count(*)::DOUBLE AS n FROM lab),
x AS MATERIALIZED (SELECT doc_id, feature_idx::INT AS f, weight AS v FROM weights UNION ALL SELECT doc_id, -1, 1.0 FROM lab),
state AS (SELECT 0 AS round, f, {_classes('0::DOUBLE AS w{i}, 0::DOUBLE AS y{i}')} FROM (SELECT feature_idx::INT AS f FROM vocab UNION ALL SELECT -1)
  UNION ALL SELECT round, f, {_classes(f'nw{{i}}, nw{{i}} + {momentum} * (nw{{i}} - w{{i}})')} FROM (
    SELECT s.round + 1 AS round, s.f, n, {_classes('s.w{i}')}, {_classes(f's.y{{i}} - {step} * ({penalised} + g.g{{i}}) AS nw{{i}}')}
    FROM state s JOIN (SELECT x.f, {_classes('sum(x.v * r.s{i}) AS g{i}')} FROM x JOIN (
      SELECT doc_id, {_classes(slope + ' AS s{i}')} FROM (
        SELECT x.doc_id, {_classes('sum(x.v * t.y{i}) AS m{i}')} FROM x JOIN state t USING (f) GROUP BY x.doc_id) JOIN lab USING (doc_id)) r
      USING (doc_id) GROUP BY x.f) g USING (f), size WHERE s.round < {rounds})),
best AS (SELECT f, {_classes('w{i}')} FROM state WHERE round = {rounds})"""


PREDICTED_SQL = f""",
tt AS (SELECT doc_id, term, (1.0::DOUBLE + ln(count(*)::DOUBLE)) AS tf FROM ({grams_sql('test')}) GROUP BY doc_id, term),
tw AS (SELECT doc_id, feature_idx, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS v FROM tt JOIN vocab USING (term)),
tm AS (SELECT doc_id, {_classes('sum(v * w{i}) AS m{i}')} FROM tw JOIN best ON best.f = tw.feature_idx GROUP BY doc_id),
margins AS (SELECT t.doc_id, lang AS truth, [{_classes('coalesce(m{i}, 0) + b.w{i}')}] AS m FROM test t LEFT JOIN tm USING (doc_id), (SELECT * FROM best WHERE f = -1) b)
SELECT doc_id, truth, {list(CLASSES)}[list_position(m, list_max(m))] AS predicted_label,
  round(1 / list_sum(list_transform(m, lambda z: exp(z - list_max(m)))), 3) AS confidence FROM margins"""

#: Multinomial logistic loss with free intercepts, and the squared hinge of one class against the rest.
LOGISTIC_SQL = linear_sql("w * exp(m{i}) / (" + _classes("exp(m{i})", " + ") + ") - CASE WHEN k = {i} THEN w ELSE 0 END",
                          "CASE WHEN s.f < 0 THEN 0 ELSE s.y{i} END", "CASE lang WHEN 'fr' THEN 0.7::DOUBLE ELSE 1.0 END", TERMS, "1 + n / 8", "n / 2")
HINGE_SQL = linear_sql("-2 * CASE WHEN k = {i} THEN w * greatest(1 - m{i}, 0) ELSE -greatest(1 + m{i}, 0) END", "s.y{i}", "1", TERMS, "1 + n / 2", "10 * n")


def _confident(predicted):
    return predicted.withColumn("confidence", F.round("confidence", 3))


def _train_features(spark, sf):
    train, test = split_documents(spark, sf)
    return models.build_features(train, "doc_id", "text", "lang", TERMS, stop_words=STOP), test


@query(LOGISTIC_SQL + PREDICTED_SQL)
def train_logreg(spark, sf):
    """Held-out predictions; the SQL finds the same optimum by steps of its own."""
    feats, test = _train_features(spark, sf)
    fitted = models.fit_path(feats, "lang", [models.Spec("logreg", factors={"fr": 0.7})], tol=1e-5)[0]
    return _confident(_predicted(test, fitted, 6))


@query(HINGE_SQL + PREDICTED_SQL)
def train_ovr_svm(spark, sf):
    feats, test = _train_features(spark, sf)
    return _confident(_predicted(test, models.fit_ovr_svm(feats, "lang", tol=1e-5), 6))


# Objective and squared norm at the optimum, and how many slopes of the objective vanish there: one for each term and the intercept.
@query(HINGE_SQL + f""", cast_out AS (SELECT unnest({list(CLASSES)}) AS lang, unnest(range({len(CLASSES)})) AS i),
rows AS (SELECT lab.k, lab.w, {_classes('m{i}')} FROM lab JOIN (SELECT doc_id, {_classes('sum(v * w{i}) AS m{i}')} FROM x JOIN best USING (f) GROUP BY doc_id) USING (doc_id)),
loss AS (SELECT [{_classes('sum(CASE WHEN k = {i} THEN w * greatest(1 - m{i}, 0) ** 2 ELSE greatest(1 + m{i}, 0) ** 2 END)')}] AS l FROM rows),
norm AS (SELECT [{_classes('sum(w{i} * w{i})')}] AS q, count(*) AS n FROM best)
SELECT lang, n_train, round(q[i + 1] / 2 + l[i + 1], 4) AS objective, round(q[i + 1], 4) AS squared_norm, n AS n_flat FROM cast_out JOIN kw USING (lang), loss, norm""")
def svm_objective(spark, sf):
    """Objective, norm and slopes of each class, from its exported coefficients and the long table of weights."""
    feats, _ = _train_features(spark, sf)
    fitted = models.fit_ovr_svm(feats, "lang", tol=1e-5)
    return models.hinge_slopes(feats, "lang", fitted.params).select(
        "lang", F.col("n_c").alias("n_train"), F.round("objective", 4).alias("objective"), F.round("squared_norm", 4).alias("squared_norm"), "n_flat")


@query()
def tune_variants(spark, sf):
    train, test = split_documents(spark, sf)
    metrics = models.run_variants(train, test, "doc_id", "text", "lang", GRID, STOP, TRACKED)
    return models.summary_table(metrics)
