import random

import pytest
from pyspark.sql import functions as F

from labelforge.operators import dedup, membership, report, substrings


def test_keep_first_prefers_source_then_row(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (0, 9, "a"), (0, 7, "b"), (0, 8, "b"), (2, 1, None), (1, 1, None), (0, 1, "")],
        "source_rank int, row_id int, text string",
    )
    got = sorted(map(tuple, dedup.keep_first(df, "text").collect()), key=str)
    assert got == sorted([(0, 9, "a"), (0, 7, "b"), (1, 1, None), (0, 1, "")], key=str)
    assert dedup.keep_first(df, "text", drop_blank=True).count() == 2


def test_keep_first_combines_before_the_shuffle(spark):
    """Half of the rows are copies of one text; each task sends one row of it."""
    df = spark.range(20_000).select(
        F.lit(0).alias("source_rank"), F.col("id").alias("row_id"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"),
    )
    out = dedup.keep_first(df, "text")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(_d0") < plan.index("partial_min")
    assert out.count() == 10_001
    assert out.where("text = 'hot'").first()["row_id"] == 0


def test_keep_longest_ties_and_first_seen(spark):
    df = spark.createDataFrame(
        [(0, 1, "k", "aaaaa"), (0, 2, "k", "bbbbbbbbb"), (1, 1, "k", "ccccccccc"), (0, 3, "l", "d"), (0, 4, "m", "")],
        "source_rank int, row_id int, key string, text string",
    )
    got = {r["key"]: (r["text"], tuple(r["first_seen"])) for r in dedup.keep_longest(df, "key", "text").collect()}
    assert got == {"k": ("bbbbbbbbb", (0, 1)), "l": ("d", (0, 3)), "m": ("", (0, 4))}


def greedy(rows, ignore_blank=False):
    seen, kept = set(), []
    for i, a, b in rows:
        keys = {a, b} - ({""} if ignore_blank else set())
        if not keys & seen:
            kept.append(i)
            seen |= keys
    return kept


@pytest.mark.parametrize("blank_keys", ["collide", "ignore"])
@pytest.mark.parametrize("seed,n,alphabet", [(1, 200, 60), (2, 200, 300), (3, 300, 8)])
@pytest.mark.parametrize("batch", [1_000_000, 40, 0])
def test_two_keys_equal_the_sequential_pass(spark, seed, n, alphabet, blank_keys, batch):
    rnd = random.Random(seed)
    key = lambda: "" if rnd.random() < 0.1 else f"k{rnd.randrange(alphabet)}"
    rows = [(i, key(), key()) for i in range(n)]
    # A third of the rows share one key.
    rows = [(i, "hot", b) if i % 3 == 0 else (i, a, b) for i, a, b in rows]
    df = spark.createDataFrame(rows, "id int, a string, b string").repartition(3)
    got = dedup.keep_first_two_keys(df, "a", "b", ["id"], blank_keys, batch)
    assert sorted(r["id"] for r in got.collect()) == greedy(rows, blank_keys == "ignore")


def test_two_keys_chain_and_empty(spark):
    rows = [(i, f"k{i}", f"k{i + 1}") for i in range(7)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    assert sorted(r["id"] for r in dedup.keep_first_two_keys(df, "a", "b", ["id"]).collect()) == [0, 2, 4, 6]
    assert dedup.keep_first_two_keys(df.limit(0), "a", "b", ["id"]).count() == 0
    assert dedup.keep_first_two_keys(df.limit(0), "a", "b", ["id"], "ignore").count() == 0


def jobs(spark, fn):
    """What ``fn`` returns, and how many Spark jobs it ran."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        out = fn()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_two_keys_long_chain_in_few_jobs(spark):
    """Each of 100,000 rows waits for the one before it."""
    df = spark.range(100_000).select("id", F.concat(F.lit("k"), "id").alias("a"), F.concat(F.lit("k"), F.col("id") + 1).alias("b"))
    got, n = jobs(spark, lambda: dedup.keep_first_two_keys(df, "a", "b", ["id"]).agg(F.count("*"), F.sum(F.col("id") % 2)).first())
    assert tuple(got) == (50_000, 0) and n < 20


def test_two_keys_chains_beyond_a_batch(spark):
    """Chains are followed by doubling; they end in rows that wait for two others."""
    df = spark.range(3_000).select("id", F.concat(F.lit("k"), "id").alias("a"), F.concat(F.lit("k"), F.col("id") + 1).alias("b"))
    assert [r["id"] for r in dedup.keep_first_two_keys(df, "a", "b", ["id"], batch=0).orderBy("id").collect()] == list(range(0, 3000, 2))
    rnd = random.Random(9)
    chain = list(range(120))
    for shape in (chain, chain[::-1], rnd.sample(chain, 120), sorted(chain, key=lambda x: x % 7)):
        rows = [(i, f"k{x}", f"k{x + 1}") for i, x in enumerate(shape)]
        got = dedup.keep_first_two_keys(spark.createDataFrame(rows, "id int, a string, b string"), "a", "b", ["id"], batch=5)
        assert sorted(r["id"] for r in got.collect()) == greedy(rows, False)


def test_two_keys_swapped_and_equal_keys(spark):
    rows = [(0, "x", "y"), (1, "y", "x"), (2, "z", "z"), (3, "z", "w"), (4, "w", "v"), (5, None, "u"), (6, "", "t")]
    for batch in (0, 100):
        got = dedup.keep_first_two_keys(spark.createDataFrame(rows, "id int, a string, b string"), "a", "b", ["id"], batch=batch)
        assert sorted(r["id"] for r in got.collect()) == [0, 2, 4, 5]


def test_metrics(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "t string")
    assert tuple(dedup.dedup_metrics(df, "t").first()) == (5, 3, 2)
    assert tuple(dedup.dedup_metrics(df.na.drop(), "t", before=df).first()) == (5, 2, 3)


def test_containment_equals_nested_loop(spark):
    rnd = random.Random(5)
    known = ["".join(rnd.choices("ab", k=rnd.randint(3, 40))) for _ in range(150)]
    # A shared opening makes one gram hot on both sides.
    known += ["aaaaaabbbbbb" + "".join(rnd.choices("ab", k=20)) for _ in range(100)]
    probes = ["".join(rnd.choices("ab", k=rnd.randint(1, 14))) for _ in range(150)]
    probes += ["aaaaaabbbbbb" + "".join(rnd.choices("ab", k=rnd.randint(0, 8))) for _ in range(100)] + ["", "bbbbb"]
    rows = [(i, p, rnd.choice(probes)) for i, p in enumerate(probes)]
    df = spark.createDataFrame(rows, "id int, s1 string, s2 string")
    kn = spark.createDataFrame([(k,) for k in known], "sig string")
    hit = lambda s: len(s) > 5 and any(s in k for k in known)
    want = [i for i, a, b in rows if not (hit(a) or hit(b))]
    got = sorted(r["id"] for r in membership.drop_contained(df, ["s1", "s2"], kn, "sig").collect())
    assert got == want and 0 < len(want) < len(rows)


def test_containment_plan_has_no_pairs(spark):
    df = spark.createDataFrame([("abcdef",)], "sig string")
    plan = membership.contained_signatures(df, df, "sig")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_containment_moves_hits_only(spark):
    """Probes of many lengths that open alike: of 30 hosts with the opening, only what is a probe is cut out."""
    hosts = [f"{i}abcdefgh{'xyz'[i % 3] * (i % 7)}ü{i}" for i in range(30)] + [None, "", "abc"]
    probes = ["abcdefgh" + "q" * i for i in range(40)] + ["abcdefghü28", "abcdefgü", "efghyü", None, "hyyyyü", "ghzzzzzü5"]
    kn, pr = spark.createDataFrame([(h,) for h in hosts], "h string"), spark.createDataFrame([(p,) for p in probes], "p string")
    hits = {p for p in probes if p and any(p in h for h in hosts if h)}
    moved = {r.h for r in substrings.likely_substrings(kn, pr.where("length(p) >= 6"), 6).collect()}
    assert hits <= moved and len(moved) < len(hits) + 5 and len(hits) == 5
    got = membership.contained_signatures(pr.withColumnRenamed("p", "sig"), kn.withColumnRenamed("h", "sig"), "sig")
    assert {r.sig for r in got.collect()} == hits
    assert substrings.likely_substrings(kn, pr.limit(0), 6).count() == 0 == substrings.likely_substrings(kn.limit(0), pr, 6).count()


def test_membership(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("x",), ("x",)], "k string")
    assert sorted(map(str, (r["k"] for r in membership.drop_known(a, b, "k").collect()))) == ["None", "y"]
    assert membership.overlap_count(a, b, "k").first()["overlap"] == 2
    assert membership.overlap_count(a, b.withColumnRenamed("k", "z"), "k").first()["overlap"] == 0


def test_union_keeps_rank_and_missing_columns(spark):
    a = spark.createDataFrame([("t", "l")], "text string, label string")
    b = spark.createDataFrame([("t2", "u")], "text string, url string")
    out = dedup.union_sources({"a": a, "b": b})
    assert sorted(map(tuple, out.select("text", "label", "url", "source_rank").collect())) == [
        ("t", "l", None, 0), ("t2", None, "u", 1)
    ]


def test_funnel_stops_at_the_target(spark):
    rows = [("s", i, o) for i, o in enumerate(["kept", "short", "kept", "short", "kept"])] + [("t", 0, "kept")]
    df = spark.createDataFrame(rows, "source string, row int, o string")
    got = {(r[0], r[1]): r[2] for r in report.funnel(df, "source", F.col("o"), 2, ["row"]).collect()}
    assert got == {("s", "kept"): 2, ("s", "short"): 1, ("t", "kept"): 1}


def test_small_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "c string, n int")
    assert [tuple(r) for r in report.distribution(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert report.nunique(df, "c").first()[0] == 2
    assert sorted(map(tuple, report.counts_zero_filled(df, "c", ["a", "z"]).collect())) == [("a", 2), ("z", 0)]
    assert sorted(r["n"] for r in report.cap_per_group(df, "c", ["n"], 1).collect()) == [1, 3, 4]
    assert report.failover(df, df.limit(1), 4).count() == 4 and report.failover(df, df.limit(1), 5).count() == 1
    arr = spark.createDataFrame([(["a", "bb", "cc"],), ([],)], "x array<string>")
    assert [r[0] for r in arr.select(report.longest("x")).collect()] == ["bb", ""]


def test_first_batch_keeps_its_own_repeats(spark):
    table = [(1, 2, "a"), (2, 1, "a"), (3, 1, "a"), (4, 3, "a"), (5, 2, ""), (6, 1, None), (7, 2, None), (8, None, "b"), (9, 1, "b"), (None, 9, "c")]
    df = spark.createDataFrame(table, "id int, page int, key string")
    ids = lambda out: sorted(r.id or 0 for r in out.collect())
    assert ids(dedup.keep_first_batch(df, "key", "page", ["id"])) == [0, 2, 3, 5, 6, 8]
    assert ids(dedup.keep_first_batch(df, "key", "page", ["id"], drop_blank=True)) == [0, 2, 3, 8]
    assert dedup.keep_first_batch(df.limit(0), "key", "page", ["id"]).count() == 0


def test_first_batch_of_random_rows(spark):
    rng = random.Random(4)
    table = [(i, rng.randrange(6), f"k{min(rng.randrange(80), 40)}") for i in range(600)]
    first = {}
    for _, page, key in table:
        first[key] = min(page, first.get(key, page))
    out = dedup.keep_first_batch(spark.createDataFrame(table, "id int, page int, key string"), "key", "page", ["id"]).collect()
    assert sorted(map(tuple, out)) == [r for r in table if r[1] == first[r[2]]]
