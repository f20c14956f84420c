import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelforge.sources import files, params, payloads
from labelforge.operators.score import LinearParams, parity, probability_map, score

SCHEMA = T.StructType().add("title", "string").add("text", "string").add("n", "integer")


def test_csv_quirks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('extra,text,title\n1,"two\nlines, ""quoted""",NA\n2,বাংলা বই,\n3, x ,nan\n', encoding="utf-8")
    got = files.read_items(spark, str(path), SCHEMA).collect()
    assert [tuple(r) for r in got] == [(None, 'two\nlines, "quoted"', None), (None, "বাংলা বই", None), (None, " x ", None)]


def test_write_and_append_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "y"\nz', 1)], SCHEMA)
    files.write_items(df, str(tmp_path / "o"), fmt="csv")
    files.write_items(df, str(tmp_path / "o"), "append", "csv")
    assert [tuple(r) for r in files.read_items(spark, str(tmp_path / "o"), SCHEMA).collect()] == [("a", 'x "y"\nz', 1)] * 2
    files.write_items(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1


def test_required_and_optional(spark, tmp_path):
    (tmp_path / "b.csv").write_text("title,text\nt,x\n")
    specs = {"a": (str(tmp_path / "none.csv"), SCHEMA), "b": (str(tmp_path / "b.csv"), SCHEMA)}
    assert files.read_optional(spark, specs).select("title", "source_rank").collect() == [("t", 0)]
    assert files.read_optional(spark, {"a": specs["a"]}) is None
    with pytest.raises(FileNotFoundError, match="merge first"):
        files.read_required(spark, *specs["a"], hint="merge first")
    df = spark.createDataFrame([("x",)], "text string")
    assert files.with_default_column(df, "title").first()["title"] == ""
    with pytest.raises(ValueError, match="title"):
        files.require_columns(df, ["text", "title"])


LONG = "s" * 50


def items(spark, docs):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "page int, payload string")


def test_flat_items_to_records(spark):
    flat = [
        {"data": [
            {"title": "First One", "title_english": None, "synopsis": LONG + " (Source: X)"},
            {"title": "Zweiter", "title_english": "Second", "synopsis": "s" * 49},
            {"title": "First  one", "title_english": "Other", "synopsis": LONG},
        ]},
        {"data": [
            {"title": "Known Title", "title_english": "", "synopsis": LONG},
            {"title": "short", "title_english": "Fresh", "synopsis": LONG},
            {"title": "late", "title_english": "Late", "synopsis": LONG},
        ]},
        {"data": []},
    ]
    parsed = payloads.parse_json_items(items(spark, flat), "payload", payloads.FLAT_ITEM, ["page"])
    assert parsed.count() == 6
    known = spark.createDataFrame([("aknowntitlehere",), ("xshorty",)], "sig string")
    got = payloads.items_to_records(parsed, known, "sig", ["page", "item_no"], "comic", notes=[r"\(Source: [^)]+\)"]).orderBy("page", "item_no")
    assert [tuple(r) for r in got.collect()] == [
        (0, 0, f"First One. {LONG}", "comic"), (1, 1, f"Fresh. {LONG}", "comic"), (1, 2, f"Late. {LONG}", "comic")
    ]
    two = payloads.items_to_records(parsed, known, "sig", ["page", "item_no"], "comic", target=2)
    assert sorted(r["item_no"] for r in two.collect()) == [0, 1]


def test_nested_items(spark):
    nested = [{"data": [
        {"attributes": {"canonicalTitle": "C", "titles": {"en": "", "en_jp": "J"}, "synopsis": "s"}},
        {"attributes": {"canonicalTitle": "D", "titles": None, "synopsis": None}},
        {"attributes": {"canonicalTitle": "E", "titles": {"en": "English"}}},
    ]}]
    parsed = payloads.parse_json_items(items(spark, nested), "payload", payloads.NESTED_ITEM)
    got = payloads.nested_titles(parsed).orderBy("item_no").select("title", "title_english", "synopsis").collect()
    assert [tuple(r) for r in got] == [("C", "J", "s"), ("D", "D", None), ("E", "English", None)]


def test_feed_entries(spark, tmp_path):
    feed = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>head</title>
    <entry><title>Line\n  break</title><summary>{a}</summary></entry>
    <entry><title>Fifty</title><summary>{b}</summary></entry>
    <entry><title>None</title></entry>
    <entry><title>Line break</title><summary>{c}</summary></entry></feed>""".format(a="a" * 51, b="b" * 50, c="c" * 60)
    (tmp_path / "f.xml").write_text(feed)
    entries = payloads.read_xml_entries(spark, str(tmp_path / "f.xml"))
    assert entries.count() == 4
    column = spark.createDataFrame([(0, feed)], "page int, xml string")
    parsed = payloads.parse_xml_entries(column, "xml", keep=["page"])
    got = payloads.entries_to_records(parsed, ["page", "item_no"], "reference", "feed").collect()
    assert [(r["title"], r["text"], r["label"], r["source"]) for r in got] == [
        ("Line break", "Line break " + "a" * 51, "reference", "feed")
    ]


@pytest.fixture(scope="module")
def tiny(spark):
    terms = spark.createDataFrame(
        [("moon", 0, 1.5, [1.0, -1.0, 0.0]), ("dark moon", 1, 2.0, [0.5, 0.0, 2.0]), ("sun", 2, 1.0, [-1.0, 1.0, 0.0]),
         ("tie", 3, 1.0, [1.0, 1.0, 0.0])],
        "term string, feature_idx int, idf double, coef array<double>",
    )
    return LinearParams(["A", "B", "C"], [0.0, 0.0, 0.1], terms, 4)


def model(text, ngrams, terms, intercept):
    """The scorer's arithmetic for one text, in plain Python."""
    import math

    words = text.lower().split()
    grams = [" ".join(words[i:i + n]) for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]
    vec = {t: (1 + math.log(grams.count(t))) * idf for t, (idf, _) in terms.items() if t in grams}
    norm = math.sqrt(sum(v * v for v in vec.values())) or 1.0
    s = [b + sum(v / norm * terms[t][1][c] for t, v in vec.items()) for c, b in enumerate(intercept)]
    e = [math.exp(x - max(s)) for x in s]
    return [x / sum(e) for x in e]


def test_scores(spark, tiny):
    texts = ["Dark moon, dark moon!", "nothing here", "", None, "sun sun moon", "tie"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r for r in score(df, tiny, "id", "text").collect()}
    terms = {r["term"]: (r["idf"], r["coef"]) for r in tiny.terms.collect()}
    for i, text in enumerate(texts):
        want = model((text or "").replace(",", "").replace("!", ""), 2, terms, tiny.intercept)
        assert got[i]["probs"] == pytest.approx(want, abs=1e-12)
        assert got[i]["confidence"] == pytest.approx(max(want))
    assert got[1]["predicted_label"] == "C"
    assert got[5]["predicted_label"] == "A"  # A and B tie


def test_params_round_trip(spark, tiny, tmp_path):
    path = str(tmp_path / "export")
    params.export_params(tiny, path, max_features=4)
    doc = json.loads(next((tmp_path / "export" / "model").glob("*.json")).read_text())
    assert doc["vocabulary"] == {"moon": 0, "dark moon": 1, "sun": 2, "tie": 3}
    assert doc["coef"][2] == [0.0, 2.0, 0.0, 0.0] and doc["ngram_range"] == [1, 2] and doc["sublinear_tf"] is True
    vocab = json.loads(next((tmp_path / "export" / "vocabulary").glob("*.json")).read_text())
    assert vocab["max_features"] == 4 and vocab["stop_words"] == "[]" and "coef" not in vocab
    loaded = params.load_params(spark, path + "/model")
    df = spark.createDataFrame([(1, "dark moon and sun"), (2, "sun")], "id int, text string")
    a, b = (score(df, p, "id", "text") for p in (tiny, loaded))
    assert parity(a, b, "id").first()["max_abs_diff"] == 0.0
    as_map = probability_map(a, tiny).where("id = 2").first()["probabilities"]
    assert set(as_map) == {"A", "B", "C"} and sum(as_map.values()) == pytest.approx(1.0)


def test_sublinear_flag_defaults_to_true(spark, tmp_path):
    doc = {"classes": ["A", "B"], "vocabulary": {"x": 0}, "idf": [1.0], "coef": [[1.0], [0.0]], "intercept": [0.0, 0.0]}
    (tmp_path / "m.json").write_text(json.dumps(doc))
    loaded = params.load_params(spark, str(tmp_path / "m.json"))
    assert loaded.sublinear_tf is True and loaded.ngram_range == (1, 2)
