"""Normalisers against Python's own string methods."""

import re

import pytest
from pyspark.sql import functions as F

from labelforge.functions import text as X
from labelforge.functions import tokens as K

SAMPLES = [
    "\n  A title (Hardcover)", "In (a) middle (b) ", "[x] Name [y](z)", "রহস্য গল্প (১ম)", "?!", "", " tab\tand　wide ",
    "Line one\nline  two\r\n", "Name (x)\n", "MiXeD 123 [Source: somewhere] text", "ends more", "a_b c1 É é", "x" * 120 + " tail",
]


def rows(spark, values, *cols):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def test_strip_and_collapse(spark):
    got = rows(spark, SAMPLES, X.strip_ws("t"), X.collapse_ws("t"))
    assert got == [(s.strip(), re.sub(r"\s+", " ", s).strip()) for s in SAMPLES]


def test_all_python_white_space_is_known(spark):
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    assert sorted(spaces) == sorted(X.WS_CHARS)
    assert rows(spark, [spaces + "a" + spaces + "b" + spaces], X.strip_ws("t"), X.collapse_ws("t")) == [
        (("a" + spaces + "b"), "a b")
    ]


def test_signature(spark):
    def model(s, n=None):
        s = s.strip()[:n] if n else s
        return re.sub(r"[^a-z0-9]", "", s.lower())

    got = rows(spark, SAMPLES + [None], X.alnum_signature("t"), X.alnum_signature("t", 100))
    assert got == [(model(s), model(s, 100)) for s in SAMPLES] + [("", "")]


# Title, and what the three styles make of it.
TITLES = [
    ("The Book (2nd ed.)", "the book", "thebook", "thebook2nded"),
    ("A (b) C", "a (b) c", "ac", "abc"),
    ("Box [new] Hardcover", "box [new] hardcover", "box", "boxnewhardcover"),
    ("\u09ac\u0987 \u09e7\u09ae (x)", "\u09ac\u0987 \u09e7\u09ae", "\u09ac\u0987", "\u09ac\u0987\u09e7\u09aex"),
    ("?!", "?!", "", ""),
    ("  Two  Words ", "two  words", "twowords", "twowords"),
    ("", "", "", ""),
    (None, "", "", ""),
]


def test_title_styles(spark):
    drop = ("\u09e7\u09ae", "hardcover")
    got = rows(
        spark, [t[0] for t in TITLES],
        X.normalize_title("t"), X.normalize_title("t", "bilingual", drop), X.normalize_title("t", "key"),
    )
    assert got == [t[1:] for t in TITLES]
    with pytest.raises(ValueError):
        X.normalize_title("t", "other")


def test_fallback_key_uses_text_for_blank_titles(spark):
    df = spark.createDataFrame([("(only)", "Some text here"), (None, "Other"), ("Title", "x")], "a string, b string")
    assert [r[0] for r in df.select(X.fallback_key("a", "b", 9)).collect()] == ["sometext", "other", "title"]


def test_patterns_and_prefixes(spark):
    got = rows(
        spark, ["Good book. (743) More *by hand*", "Keep this. Buy NOW at our shop\nnext line", None],
        X.strip_patterns("t", [r"\([0-9]+\)", r"\*[A-Z ]+\*"]), X.strip_patterns("t", ["buy now"], to_line_end=True), X.title_prefix("t"),
    )
    assert got[0][0] == "Good book. More"
    assert got[1][1] == "Keep this. next line"
    assert got[1][2] == "Keep this"
    assert got[2] == ("", "", None)


def test_ui_suffix_url_and_assembly(spark):
    assert rows(spark, ["  plot  Show more ", "Show more plot"], X.strip_ui_suffix("t", "Show more")) == [
        ("plot",), ("Show more plot",)
    ]
    links = ["http://a/b", "/c", "d"]
    assert rows(spark, links, X.absolute_url("t", "https://h"), X.absolute_url("t", "https://h", True)) == [
        ("http://a/b", "http://a/b"), ("https://h/c", "https://h/c"), ("https://hd", "d")
    ]
    df = spark.createDataFrame([(" a ", None), (None, "b\n"), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(X.assemble_text(["x", "y"])).collect()] == ["a", "b", ""]


def test_null_handling(spark):
    assert rows(spark, ["NA", "", "x", None], X.null_if_token("t"), X.as_text("t")) == [
        (None, "NA"), (None, ""), ("x", "x"), (None, "nan")
    ]
    df = spark.createDataFrame([("", "b", "c"), (None, "", ""), ("a", "b", "c")], "x string, y string, z string")
    assert [r[0] for r in df.select(X.first_nonblank("x", "y", "z")).collect()] == ["b", "", "a"]


def test_any_term_and_percent(spark):
    assert rows(spark, ["Has A.B here", "axb", None], X.any_term("t", ["a.b"])) == [(True,), (False,), (False,)]
    df = spark.createDataFrame([(0.5808, 0.0125)], "a double, b double")
    assert tuple(df.select(X.percent("a"), X.percent("b", signed=True)).first()) == ("58.08%", "+1.25%")


def test_tokens(spark):
    texts = ["ভূতের গল্প a_b X1 y é", "", None, "The cat and THE dog"]
    got = rows(spark, texts, K.tokens("t"), K.tokens("t", "export"), K.tokens("t", "marks"), K.tokens("t", stop_words=["the"]))
    assert got[0][0] == ["গল", "a_b", "x1"]
    assert got[0][1] == ["ভ", "ত", "র", "গল", "প", "a", "b", "x1", "y", "é"]
    assert got[0][2] == ["ভূতের", "গল্প", "a_b", "x1"]
    assert got[1] == got[2] == ([], [], [], [])
    assert got[3][3] == ["cat", "and", "dog"]


@pytest.mark.parametrize("lo,hi", [(1, 1), (1, 2), (1, 3), (2, 3)])
def test_ngrams_and_counts(spark, lo, hi):
    texts = ["to be or not to be to be", "one", "", "a a a"]
    words = F.filter(F.split("t", " "), lambda w: w != "")
    got = rows(spark, texts, K.ngrams(words, lo, hi), K.counted(K.ngrams(words, lo, hi)))
    for text, (grams, counts) in zip(texts, got):
        w = text.split()
        want = [" ".join(w[i:i + n]) for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]
        assert grams == want
        assert {c["term"]: c["n"] for c in counts} == {g: want.count(g) for g in want}
