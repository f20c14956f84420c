"""Plans that have to hold when one key has a third of the rows."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from labelforge.operators import common, dedup, features, membership, report, score


@contextmanager
def settings(spark, **conf):
    names = {k: f"spark.sql.{k.replace('__', '.')}" for k in conf}
    before = {k: spark.conf.get(n, None) for k, n in names.items()}
    for k, v in conf.items():
        spark.conf.set(names[k], v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(names[k]) if v is None else spark.conf.set(names[k], v)


def final_plan(df):
    df.collect()  # adaptive execution fixes the plan while it runs
    return df._jdf.queryExecution().executedPlan().toString()


def test_anti_join_splits_a_hot_key(spark):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    known = spark.range(0, 200_000, 7, 4).select(F.col("id").cast("string").alias("k"))
    with settings(
        spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="8",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB", adaptive__advisoryPartitionSizeInBytes="1MB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        out = membership.drop_known(rows, known, "k").agg(F.max("payload"), F.count("*").alias("n"))
        assert "skew=true" in final_plan(out)


def test_two_key_rounds_split_a_hot_key(spark, tmp_path):
    """The join of a round: open rows, a third with one key, against the keys used."""
    rows = spark.range(0, 200_000, 1, 8).select(
        F.struct("id").alias("o"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
        F.sha2(F.col("id").cast("string"), 512).alias("b"),
    )
    spark.range(0, 200_000, 7, 4).select(F.array(F.col("id").cast("string")).alias("ks")).write.parquet(f"{tmp_path}/kept")
    with settings(
        spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="8",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB", adaptive__advisoryPartitionSizeInBytes="1MB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        out = dedup.without_used_keys(rows, spark.read.parquet(f"{tmp_path}/kept"))
        assert "skew=true" in final_plan(out.agg(F.max("b"), F.count("*").alias("n")))


def test_lookup_join_leaves_the_choice_to_the_session(spark):
    big, small = spark.range(1000).withColumnRenamed("id", "k"), spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert "BroadcastHashJoin" in final_plan(common.lookup_join(big, small, "k"))
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1"):
        assert "BroadcastHashJoin" not in final_plan(common.lookup_join(big, small, "k"))


@pytest.mark.parametrize("k", [1, 3, 2500, 10**6])
def test_caps_per_group_of_any_size(spark, k):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("g"), "id")
    rows = rows.withColumn("g", F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("g")))
    got = report.cap_per_group(rows, "g", ["id"], k).groupBy("g").agg(F.count("*"), F.max("id")).collect()
    want: dict = {}
    for r in rows.orderBy("id").collect():
        want.setdefault(r.g, []).append(r.id)
    assert {r[0]: tuple(r)[1:] for r in got} == {g: (len(v[:k]), max(v[:k])) for g, v in want.items()}


@pytest.mark.parametrize("fn", [lambda d: dedup.keep_first(d, "key"), lambda d: dedup.keep_longest(d, "key", "key")])
def test_winners_are_found_without_texts(spark, fn):
    """No sort and no shuffle under the winners' aggregate carries the text."""
    df = spark.range(100).select(F.lit(0).alias("source_rank"), F.col("id").alias("row_id"), F.repeat(F.col("id").cast("string"), 50).alias("key"))
    plan = fn(df)._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in plan and "partial_min" in plan


def test_scoring_shuffles_sums_only(spark):
    terms = spark.createDataFrame([("a", 0, 1.0, [1.0, 0.0])], "term string, feature_idx int, idf double, coef array<double>")
    params = score.LinearParams(["x", "y"], [0.0, 0.0], terms, 1)
    df = spark.createDataFrame([(1, "a b")], "id long, text string")
    plan = score.score(df, params, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan and "BroadcastHashJoin" in plan


def test_term_counts_need_no_shuffle_and_scan_two_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = features.term_counts(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_stages_go_to_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert common.shared_dir(spark, "x").startswith(base)
    stage = common.stored(spark.range(3))
    assert stage.count() == 3 and all(base in f for f in stage.inputFiles())
