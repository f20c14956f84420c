"""Incremental ingest over the table files as landed files, and crawl progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.common import forget_at_exit, shared_dir, stored
from ..streaming import ingest, progress
from . import sqltext as S
from .page_queries import RECORDS_SQL, records
from .registry import query, table
from .text_queries import documents


def landed(spark, sf, name):
    """A table's files as landed ones; the pattern takes a table that is one file and one that is a folder of files or of partitions."""
    return ingest.landed(spark, f"{sf}/{{{name}}}.parquet", table(spark, sf, name).schema, base=sf)


@query(RECORDS_SQL)
def stream_ingest(spark, sf):
    work = shared_dir(spark, "stream-ingest")
    forget_at_exit(spark, work)
    ingest.append(landed(spark, sf, "pages"), records, f"{work}/out", f"{work}/progress")
    return spark.read.parquet(f"{work}/out")


URL, TITLE = S.alnum(f"substr({S.strip('text')}, 1, 100)"), S.title_key(S.DOC_TITLE)
LANDINGS = 4


def landings(spark, sf, work, *columns):
    """The documents land in several goes, by ascending id; a stream over what is there after each."""
    rows = table(spark, sf, "documents").select("doc_id", *columns)
    lo, hi = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    go = F.floor((F.col("doc_id") - lo) * LANDINGS / (hi - lo + 1))
    for i in range(LANDINGS):
        rows.where(go == i).write.mode("append").parquet(f"{work}/landed")
        forget_at_exit(spark, work)
        yield ingest.landed(spark, f"{work}/landed", rows.schema)


@query(f"""WITH k AS (SELECT doc_id, {URL} AS url, {TITLE} AS title FROM documents),
u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1)
SELECT doc_id, url, title FROM u QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id) = 1""")
def stream_dedup(spark, sf):
    work = shared_dir(spark, "stream-dedup")
    url, title = X.alnum_signature("text", 100).alias("url"), X.normalize_title(X.title_prefix("text"), "key").alias("title")
    for stream in landings(spark, sf, work, url, title):
        ingest.append_first(stream, ["url", "title"], ["doc_id"], f"{work}/out", f"{work}/progress", buckets=8)
    return spark.read.parquet(f"{work}/out").drop("batch")


@query(f"SELECT DISTINCT {URL} AS url FROM documents")
def stream_dedup_state(spark, sf):
    work = shared_dir(spark, "stream-distinct")
    for stream in landings(spark, sf, work, X.alnum_signature("text", 100).alias("url")):
        ingest.append_distinct(stream.select("url"), ["url"], f"{work}/out", f"{work}/progress")
    return spark.read.parquet(f"{work}/out")


# Events land in goes an hour apart, and keys are remembered for 90 minutes: state that was made in one go is gone before the
# fourth after it, when the watermark, 90 minutes behind the third, has reached the end of the key's 90 minutes.
GOES, MEMORY = 9, 4


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT user_id, event_id * {GOES} // (SELECT max(event_id) + 1 FROM events) AS go FROM events),
a AS (SELECT user_id, min(go) AS go FROM e GROUP BY user_id
    UNION ALL SELECT a.user_id, min(e.go) FROM a JOIN e ON e.user_id = a.user_id AND e.go >= a.go + {MEMORY} GROUP BY a.user_id)
SELECT user_id, go FROM a""")
def stream_dedup_bounded(spark, sf):
    """Users with events, each again only when the bounded state has forgotten it."""
    work = shared_dir(spark, "stream-bounded")
    forget_at_exit(spark, work)
    events = table(spark, sf, "events").select("user_id", "event_id")
    last = events.agg(F.max("event_id")).first()[0] or 0
    rows = events.select("user_id", F.floor(F.col("event_id") * GOES / (last + 1)).alias("go"))
    rows = rows.withColumn("landed", F.timestamp_seconds(F.col("go") * 3600 + 1_700_000_000))
    for i in range(GOES):
        rows.where(F.col("go") == i).write.mode("append").parquet(f"{work}/landed")
        stream = ingest.landed(spark, f"{work}/landed", rows.schema)
        ingest.append_distinct_within(stream, ["user_id"], "landed", "90 minutes", f"{work}/out", f"{work}/progress")
    return spark.read.parquet(f"{work}/out").select("user_id", "go")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def stream_counts(spark, sf):
    work = shared_dir(spark, "stream-counts")
    forget_at_exit(spark, work)
    ingest.running_counts(landed(spark, sf, "documents"), "source", f"{work}/out", f"{work}/progress")
    return spark.read.parquet(f"{work}/out")


@query("""SELECT conv_id, max(turn) + 1 AS next_page FROM conversations
    WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'system') GROUP BY conv_id""")
def resume_points(spark, sf):
    c = table(spark, sf, "conversations")
    completed = c.where("role = 'system'").select("conv_id").distinct()
    return progress.resume_points(c, "conv_id", "turn", completed)


@query("""SELECT conv_id, max(turn) + 1 AS next_page, bool_or(role = 'system') AS completed FROM conversations GROUP BY conv_id""")
def stream_progress(spark, sf):
    """Pages land in three goes, out of order; the first go's progress is taken over from a table of an earlier run."""
    work = shared_dir(spark, "stream-progress")
    forget_at_exit(spark, work)
    pages = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("category"), F.col("turn").alias("page"), (F.col("role") == "system").alias("completed"),
        F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)).alias("go"))
    rows = pages.drop("go")
    old = stored(pages.where("go = 0").groupBy("category").agg((F.max("page") + 1).alias("next_page"), F.bool_or("completed").alias("completed")), "old")
    for i in (1, 2):
        pages.where(F.col("go") == i).drop("go").write.mode("append").parquet(f"{work}/landed")
        stream = ingest.landed(spark, f"{work}/landed", rows.schema)
        ingest.append_changes(progress.track(stream, old), f"{work}/out", f"{work}/progress")
    found = progress.latest(spark.read.parquet(f"{work}/out"), old)
    return found.select(F.col("category").cast("long").alias("conv_id"), "next_page", "completed")


@query("""WITH t AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
SELECT source, c AS chunk_no, c * 20 AS start, least(20, n - c * 20) AS max_results
FROM (SELECT source, n, unnest(range(0, (n + 19) // 20)) AS c FROM t)""")
def crawl_worklist(spark, sf):
    targets = documents(spark, sf).groupBy("source").agg(F.count("*").alias("n"))
    return progress.chunk_worklist(targets, "source", "n", 20).withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


@query("""WITH p AS (SELECT conv_id, max(turn) AS first FROM conversations GROUP BY conv_id)
SELECT conv_id, first + k AS page, CASE WHEN first + k > 1 THEN '/c/' || conv_id || '?page=' || (first + k) ELSE '/c/' || conv_id END AS page_url
FROM p, (SELECT unnest(range(0, 8)) AS k)""")
def page_worklist(spark, sf):
    points = progress.resume_points(table(spark, sf, "conversations"), "conv_id", "turn")
    categories = points.select(
        "conv_id", F.concat(F.lit("/c/"), F.col("conv_id").cast("string")).alias("url"), (F.col("next_page") - 1).alias("first")
    )
    return progress.page_worklist(categories, "conv_id", "url", "first", 8, "%s?page=%d")
