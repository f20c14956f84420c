from pyspark.sql import functions as F

from labelforge.operators import rules

TAGS = [("A", ["x", "y"]), ("B", ["z"])]
TEXT = [("C", rules.word_edges("moon|star")), ("A", rules.word_edges("sun"))]


def test_parse_tag_list(spark):
    cases = {
        "['a', 'b']": ["a", "b"], "['a', \"it's\"]": ["a", "it's"], "[]": [], None: [], "word": [], "('a', 'b')": [],
        "{'a': 1}": [], "['a',]": ["a"], "['x\\xa0y']": ["x y"], "[None]": [], "['None', None, 'b']": ["None", "b"],
        "['War, None, x']": ["War, None, x"], '["a, None", None, "b"]': ["a, None", "b"], "[ None , 'c']": ["c"],
        "['say \"hi\"']": ['say "hi"'], "": [], "['It\\'s']": ["It's"], "['a'": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert [r[0] for r in df.select(rules.parse_tag_list("t")).collect()] == list(cases.values())


def test_labels_follow_priority(spark):
    df = spark.createDataFrame(
        [(1, ["z", "x"], "moon"), (2, ["z"], None), (3, [], "bright Star."), (4, [], "sunny"), (5, None, None),
         (6, ["q"], "the sun and the moon")],
        "id int, tags array<string>, text string",
    )
    out = rules.label_items(df, "tags", "text", TAGS, TEXT).orderBy("id").collect()
    assert [r["label"] for r in out] == ["A", "B", "C", "Miscellaneous", "Miscellaneous", "C"]


def test_rule_table_equals_rule_list(spark):
    df = spark.createDataFrame([(i, [t for b, t in zip(f"{i:03b}", "xyz") if b == "1"]) for i in range(8)], "id int, tags array<string>")
    table = spark.createDataFrame([(p, label, t) for p, (label, ts) in enumerate(TAGS) for t in ts], "priority int, label string, tag string")
    a = rules.label_by_tags(df, "tags", TAGS).where("label is not null").select("id", "label")
    b = rules.label_by_tag_table(df, "id", "tags", table)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_split_category_and_audit(spark):
    df = spark.createDataFrame([("s", True), ("s", False), ("t", True)], "c string, f boolean")
    assert [r[0] for r in df.select(rules.split_category("c", "s", F.col("f"), "yes", "no")).collect()] == ["yes", "no", "t"]
    links = spark.createDataFrame([("classic books", "/x"), ("other", "/novel"), ("other", "/x")], "text string, href string")
    assert rules.keyword_audit(links, "text", "href", ["classic"], ["novel"]).count() == 2


def test_load_rules(spark, tmp_path):
    (tmp_path / "rules.json").write_text('{"tags": [["A", ["x"]]], "patterns": [["B", "y+"]]}')
    assert rules.load_rules(spark, str(tmp_path / "rules.json")) == ([("A", ["x"])], [("B", "y+")])
