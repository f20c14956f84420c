import pytest
from pyspark.sql import functions as F

from labelforge.plans import stream_queries
from labelforge.streaming import ingest, progress
from labelforge.streaming.seen import Seen

SCHEMA = "id long, url string, title string"


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return ingest.landed(spark, f"{folder}/*", schema, max_files=1)


BATCHES = {
    "a": [(1, "u1", "t1"), (2, "u2", "t2"), (3, "u1", "t3")],
    "b": [(4, "u2", "t4"), (5, "u5", "t1"), (6, "u6", "t6")],
    "c": [(7, "u7", "t6"), (8, "u8", "t8"), (9, "u1", "t8")],
}


def test_first_rows_across_restarts(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for name, rows in BATCHES.items():
        land(spark, folder, name, rows)
        ingest.append_first(stream(spark, folder), ["url", "title"], ["id"], out, state)
    ingest.append_first(stream(spark, folder), ["url", "title"], ["id"], out, state)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 6, 8]


def test_any_split_into_batches_gives_the_rows_of_one(spark, tmp_path):
    every = [r for rows in BATCHES.values() for r in rows] + [(10, "u0", "t1"), (11, "v", "t1"), (12, "v", "t12")]
    got = []
    for n, size in enumerate((1, 4, len(every))):
        folder, out, state = (str(tmp_path / f"{x}{n}") for x in ("in", "out", "state"))
        for i in range(0, len(every), size):
            land(spark, folder, f"{i:03d}", every[i : i + size])
            ingest.append_first(stream(spark, folder), ["url", "title"], ["id"], out, state)
        got.append(sorted(r["id"] for r in spark.read.parquet(out).collect()))
    assert got[0] == got[1] == got[2] and 12 not in got[0]


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "k string")


def test_history_is_not_moved(spark, tmp_path):
    """The only exchange is that of the batch, which is dealt to the history's buckets."""
    seen = Seen(spark, str(tmp_path / "seen"), buckets=4)
    for i in range(3):
        seen.add(keys(spark, *(f"k{j}" for j in range(i * 10, i * 10 + 10))), "k", i)
    new = seen.unseen(keys(spark, "k3", "k29", "k30", None), "k", 9)
    rows = {r.k for r in new.collect()}
    plan = new._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert rows == {"k30", None} and final.count("Exchange") == 1 and "BroadcastExchange" not in plan
    history = final[final.index("FileScan"):]
    assert "SelectedBucketsCount: 4 out of 4" in history and "Bucketed: true" in history


def test_a_repeated_batch_replaces_its_keys(spark, tmp_path):
    seen = Seen(spark, str(tmp_path / "seen"), buckets=2)
    seen.add(keys(spark, "a"), "k", 0)
    seen.add(keys(spark, "b", "c"), "k", 1)  # failed after this
    assert {r.k for r in seen.unseen(keys(spark, "a", "b", "c"), "k", 1).collect()} == {"b", "c"}
    seen.add(keys(spark, "b"), "k", 1)
    again = Seen(spark, str(tmp_path / "seen"), buckets=2)
    assert {r.k for r in again.unseen(keys(spark, "a", "b", "c"), "k", 2).collect()} == {"c"}


def test_partitions_are_merged(spark, tmp_path):
    seen = Seen(spark, str(tmp_path / "seen"), buckets=2, merge=3)
    for i in range(7):
        seen.merged(i)
        assert len(seen.batches()) <= 3
        seen.add(keys(spark, f"k{i}", None), "k", i)
    spark.sql(f"DROP TABLE {seen.name}")  # as for a new session; the files stay
    back = Seen(spark, str(tmp_path / "seen"), buckets=2, merge=3)
    assert {r.k for r in back.unseen(keys(spark, *(f"k{i}" for i in range(8)), None), "k", 7).collect()} == {"k7"}


def test_append_and_distinct_match_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    for name in ("a", "b"):
        land(spark, folder, name, BATCHES[name])
    for _ in range(2):  # the second run finds nothing new
        ingest.append(stream(spark, folder), lambda d: d.withColumn("n", F.length("url")), str(tmp_path / "o1"), str(tmp_path / "s1"))
        ingest.append_distinct(stream(spark, folder), ["url"], str(tmp_path / "o2"), str(tmp_path / "s2"))
        ingest.running_counts(stream(spark, folder), "url", str(tmp_path / "o3"), str(tmp_path / "s3"))
    land(spark, folder, "c", BATCHES["c"])
    ingest.append(stream(spark, folder), lambda d: d.withColumn("n", F.length("url")), str(tmp_path / "o1"), str(tmp_path / "s1"))
    ingest.append_distinct(stream(spark, folder), ["url"], str(tmp_path / "o2"), str(tmp_path / "s2"))
    ingest.running_counts(stream(spark, folder), "url", str(tmp_path / "o3"), str(tmp_path / "s3"))
    every = [r for rows in BATCHES.values() for r in rows]
    assert spark.read.parquet(str(tmp_path / "o1")).count() == len(every)
    assert sorted(r["url"] for r in spark.read.parquet(str(tmp_path / "o2")).collect()) == sorted({r[1] for r in every})
    counts = {r["url"]: r["n"] for r in spark.read.parquet(str(tmp_path / "o3")).collect()}
    assert counts["u1"] == 3 and counts["u2"] == 2 and sum(counts.values()) == 9


def test_bounded_state_forgets(spark, tmp_path):
    """Keys inside the bound are dropped, across restarts; later ones come through again, and the state stays small."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    schema = "hour int, k string"
    for hour in range(12):
        rows = [(hour, "each"), (hour, f"own{hour}"), *([(hour, "rare")] if hour in (0, 1, 11) else [])]
        df = spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds(F.col("hour") * 3600 + 1_700_000_000))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2):  # the second run finds nothing new
            stream = ingest.landed(spark, str(tmp_path / "in"), df.schema)
            ingest.append_distinct_within(stream, ["k"], "at", "90 minutes", str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("k").agg(F.sort_array(F.collect_list("hour")).alias("hours")).collect()
    hours = {r.k: r.hours for r in got}
    assert hours["each"] == [0, 4, 8] and hours["rare"] == [0, 11] and all(hours[f"own{h}"] == [h] for h in range(12))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


PAGES = [("a", 1, False), ("b", 2, False), ("a", 3, False), ("c", 9, True), ("a", 2, False), ("b", 1, True), ("c", 10, False)]


@pytest.mark.parametrize("size", [1, 3, 7])
def test_progress_of_any_split_into_batches(spark, tmp_path, size):
    """Each start goes on from the last; the old progress is read by the first alone."""
    schema = "category string, page long, completed boolean"
    old = spark.createDataFrame([("a", 2, False), ("old", 5, True), ("c", 40, False)], "category string, next_page long, completed boolean")
    for i in range(0, len(PAGES), size):
        spark.createDataFrame(PAGES[i : i + size], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = ingest.landed(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        ingest.append_changes(progress.track(stream, old), str(tmp_path / "out"), str(tmp_path / "state"))
    got = progress.latest(spark.read.parquet(str(tmp_path / "out")), old).collect()
    assert {tuple(r) for r in got} == {("a", 4, False), ("b", 3, True), ("c", 40, True), ("old", 5, True)}


def test_progress(spark):
    pages = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "cat string, page int")
    done = spark.createDataFrame([("b",)], "cat string")
    assert [tuple(r) for r in progress.resume_points(pages, "cat", "page", done).collect()] == [("a", 4)]
    cats = spark.createDataFrame([("a", "/a", 1), ("b", "/b", 3)], "cat string, url string, first int")
    got = progress.page_worklist(cats, "cat", "url", "first", 2, "%s?page=%d").orderBy("cat", "page").collect()
    assert [r["page_url"] for r in got] == ["/a", "/a?page=2", "/b?page=3", "/b?page=4"]
    targets = spark.createDataFrame([("x", 120), ("y", 50), ("z", 0)], "name string, n long")
    got = progress.chunk_worklist(targets, "name", "n").orderBy("name", "chunk_no").collect()
    assert [tuple(r) for r in got] == [("x", 0, 0, 50), ("x", 1, 50, 50), ("x", 2, 100, 20), ("y", 0, 0, 50)]


@pytest.mark.parametrize("one_file", [False, True])
def test_counts_of_a_table_in_one_file_or_a_folder_of_files(spark, tmp_path, one_file):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "x"), (4, None, None)], "doc_id long, text string, source string")
    if one_file:
        rows.toPandas().to_parquet(tmp_path / "documents.parquet")
    else:
        rows.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = stream_queries.stream_counts(spark, str(tmp_path)).collect()
    assert {r.source: r.n for r in got} == {"x": 2, "y": 1, None: 1}


def test_ingest_of_a_table_in_a_folder_of_files(spark, tmp_path):
    page = "<html><h1>Title {}</h1><p>" + "some words of a paragraph " * 5 + "</p></html>"
    rows = [(i, f"https://h.example/en/{i}", page.format(i)) for i in range(5)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    got = stream_queries.stream_ingest(spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.title) for r in got) == [(i, f"Title {i}") for i in range(5)]


def test_ingest_of_a_table_in_partitions(spark, tmp_path):
    """The subfolders' column is no column of the files."""
    page = "<html><h1>Title {}</h1><p>" + "some words of a paragraph " * 5 + "</p></html>"
    rows = [(i, f"https://h.example/en/{i}", page.format(i), i % 2) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, part int")
    pages.write.partitionBy("part").parquet(str(tmp_path / "pages.parquet"))
    got = stream_queries.stream_ingest(spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.title) for r in got) == [(i, f"Title {i}") for i in range(5)]
