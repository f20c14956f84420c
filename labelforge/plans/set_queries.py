"""De-duplication and membership queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedup, membership, report
from . import sqltext as S
from .registry import query, table
from .text_queries import texts

RANKED = "CAST(substr(source, 4) AS INT)"


def ranked(spark, sf):
    """Documents as a union of their sources: rank is the source's number."""
    return texts(spark, sf).select(
        F.expr("CAST(substr(source, 4) AS INT)").alias("source_rank"), F.col("doc_id").alias("row_id"),
        "text", "lang", "source",
    )


@query(f"""SELECT doc_id AS row_id, {RANKED} AS source_rank, lang FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY {RANKED}, doc_id) = 1""")
def dedup_exact_first(spark, sf):
    return dedup.keep_first(ranked(spark, sf), "text").select("row_id", "source_rank", "lang")


@query("""SELECT doc_id, title FROM (SELECT doc_id, string_split(text, '. ')[1] AS title FROM documents)
    QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id) = 1""")
def dedup_title_first(spark, sf):
    d = texts(spark, sf).select("doc_id", X.title_prefix("text").alias("title"))
    return dedup.keep_first(d, "title", ["doc_id"])


LONG_KEY = f"""coalesce(nullif({S.title_bilingual(S.DOC_TITLE)}, ''), {S.title_bilingual('substr(text, 1, 40)')})"""


@query(f"""WITH k AS (SELECT doc_id AS row_id, {RANKED} AS source_rank, text, {LONG_KEY} AS key FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY length(text) DESC, source_rank, row_id) AS rn,
    first_value(row_id) OVER (PARTITION BY key ORDER BY source_rank, row_id) AS first_row FROM k)
SELECT key, row_id, source_rank, length(text) AS n, first_row FROM r WHERE rn = 1""")
def dedup_keep_longest(spark, sf):
    d = ranked(spark, sf).select("source_rank", "row_id", "text", X.fallback_key(X.title_prefix("text"), "text").alias("key"))
    return dedup.keep_longest(d, "key", "text").select(
        "key", "row_id", "source_rank", F.length("text").cast("bigint").alias("n"),
        F.col("first_seen.row_id").alias("first_row"),
    )


KEY = S.title_key(S.DOC_TITLE)


@query(f"""SELECT doc_id, key FROM (SELECT doc_id, {KEY} AS key FROM documents) WHERE key <> ''
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1""")
def dedup_key_nonblank(spark, sf):
    d = texts(spark, sf).select("doc_id", X.normalize_title(X.title_prefix("text"), "key").alias("key"))
    return dedup.keep_first(d, "key", ["doc_id"], drop_blank=True)


@query(f"""SELECT doc_id, page, key FROM (SELECT doc_id, {RANKED} AS page, {KEY} AS key FROM documents) WHERE key <> ''
    QUALIFY page = min(page) OVER (PARTITION BY key)""")
def dedup_key_first_page(spark, sf):
    """Each source is a page of the crawl: keys of earlier pages go, repeats inside a page stay."""
    d = ranked(spark, sf).select(
        F.col("row_id").alias("doc_id"), F.col("source_rank").alias("page"), X.normalize_title(X.title_prefix("text"), "key").alias("key"))
    return dedup.keep_first_batch(d, "key", "page", ["doc_id"], drop_blank=True)


TWO_KEYS_SQL = f"""
WITH RECURSIVE keyed AS (
    SELECT doc_id AS id, {S.alnum(S.DOC_TITLE)} AS a, {S.alnum("string_split(text, '. ')[2]")} AS b FROM documents),
pairs AS (SELECT min(id) AS id, coalesce(a, '') AS a, coalesce(b, '') AS b FROM keyed GROUP BY ALL),
step AS (
    SELECT 0 AS it, id, a, b, 0 AS state FROM pairs
    UNION ALL
    SELECT it + 1, id, a, b, CASE WHEN state <> 0 THEN state
        WHEN id = ma AND id = mb THEN 1
        WHEN a IN (SELECT k FROM won) OR b IN (SELECT k FROM won) THEN 2 ELSE 0 END
    FROM (
        WITH cur AS (SELECT * FROM step WHERE EXISTS (SELECT 1 FROM step WHERE state = 0)),
        mins AS (SELECT k, min(id) AS m FROM (
            SELECT a AS k, id FROM cur WHERE state = 0 UNION ALL SELECT b, id FROM cur WHERE state = 0) GROUP BY k),
        best AS (SELECT cur.*, x.m AS ma, y.m AS mb FROM cur LEFT JOIN mins x ON cur.a = x.k LEFT JOIN mins y ON cur.b = y.k),
        won AS (SELECT a AS k FROM best WHERE state = 0 AND id = ma AND id = mb
            UNION SELECT b FROM best WHERE state = 0 AND id = ma AND id = mb)
        SELECT best.it, best.id, best.a, best.b, best.state, best.ma, best.mb,
            best.a IN (SELECT k FROM won) OR best.b IN (SELECT k FROM won) AS hit FROM best))
SELECT id AS doc_id FROM step WHERE state = 1 GROUP BY id"""
TWO_KEYS_SQL = TWO_KEYS_SQL.replace(
    "WHEN a IN (SELECT k FROM won) OR b IN (SELECT k FROM won) THEN 2", "WHEN hit THEN 2"
)


@query(TWO_KEYS_SQL)
def dedup_two_key(spark, sf):
    """Keys are the signatures of the first and second sentence."""
    words = F.split("text", "[.] ")
    d = texts(spark, sf).select(
        "doc_id",
        X.alnum_signature(F.try_element_at(words, F.lit(1))).alias("a"),
        X.alnum_signature(F.try_element_at(words, F.lit(2))).alias("b"),
    )
    return dedup.keep_first_two_keys(d, "a", "b", ["doc_id"]).select("doc_id")


@query(f"""SELECT category, url FROM (
    SELECT {RANKED} AS category, {KEY} AS url, doc_id FROM documents)
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY category, doc_id) = 1""")
def first_category_wins(spark, sf):
    d = ranked(spark, sf).select(
        F.col("source_rank").alias("category"), "row_id",
        X.normalize_title(X.title_prefix("text"), "key").alias("url"),
    )
    return dedup.keep_first(d, "url", ["category", "row_id"]).select("category", "url")


@query("""SELECT count(*) AS rows_before, count(DISTINCT text) AS rows_after,
    count(*) - count(DISTINCT text) AS rows_dropped FROM documents""")
def dedup_metrics(spark, sf):
    return dedup.dedup_metrics(texts(spark, sf).select("text"), "text")


DOC_SIG = S.alnum(f"substr({S.strip('text')}, 1, 100)")


@query(f"""SELECT DISTINCT sig FROM (SELECT {DOC_SIG} AS sig FROM documents
    UNION ALL SELECT {DOC_SIG} FROM benchmark UNION ALL SELECT {DOC_SIG} FROM conversations) WHERE sig <> ''""")
def signature_set(spark, sf):
    tables = [table(spark, sf, t).select("text") for t in ("documents", "benchmark", "conversations")]
    return membership.signature_set(tables, "text", lambda c: X.alnum_signature(c, 100))


TITLE = S.title_suffix("string_split(text, '. ')[1]")


@query(f"""SELECT conv_id, turn, title FROM (SELECT conv_id, turn, {TITLE} AS title FROM conversations)
    WHERE title NOT IN (SELECT {TITLE} FROM documents)""")
def anti_join_titles(spark, sf):
    def title(c):
        return X.normalize_title(X.title_prefix(c), "suffix")

    known = membership.signature_set([texts(spark, sf).select("text")], "text", title, "title", drop_blank=False)
    new = table(spark, sf, "conversations").select("conv_id", "turn", title(F.col("text")).alias("title"))
    return membership.drop_known(new, known, "title")


@query("""SELECT page_id, url FROM pages WHERE NOT EXISTS
    (SELECT 1 FROM labels WHERE labels.doc_id = page_id AND quality = 1)""")
def anti_join_urls(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    done = table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("page_id"))
    seen = pages.join(done, "page_id").select("url")
    return membership.drop_known(pages, seen, "url")


TITLE_SIG, SECOND_SIG = S.alnum(S.DOC_TITLE), S.alnum("string_split(text, '. ')[2]")


@query(f"""WITH known AS (SELECT DISTINCT {DOC_SIG} AS sig FROM documents),
cand AS (SELECT conv_id, turn, {TITLE_SIG} AS sig_a, coalesce({SECOND_SIG}, '') AS sig_b FROM conversations),
probes AS (SELECT sig_a AS sig FROM cand UNION SELECT sig_b FROM cand),
hit AS (SELECT p.sig FROM probes p WHERE length(p.sig) > 5 AND EXISTS (SELECT 1 FROM known k WHERE contains(k.sig, p.sig)))
SELECT conv_id, turn, sig_a, sig_b FROM cand
WHERE sig_a NOT IN (SELECT sig FROM hit) AND sig_b NOT IN (SELECT sig FROM hit)""")
def containment_anti_join(spark, sf):
    known = texts(spark, sf).select(X.alnum_signature("text", 100).alias("sig"))
    cand = table(spark, sf, "conversations").select(
        "conv_id", "turn",
        X.alnum_signature(X.title_prefix("text")).alias("sig_a"),
        X.alnum_signature(F.try_element_at(F.split("text", "[.] "), F.lit(2))).alias("sig_b"),
    )
    return membership.drop_contained(cand, ["sig_a", "sig_b"], known, "sig").select("conv_id", "turn", "sig_a", "sig_b")


@query(f"""SELECT count(*) AS overlap FROM (SELECT {S.title_bilingual(S.DOC_TITLE)} AS title FROM conversations)
    WHERE title IN (SELECT {S.title_bilingual(S.DOC_TITLE)} FROM documents)""")
def semi_join_overlap(spark, sf):
    def keyed(name):
        return table(spark, sf, name).select(X.normalize_title(X.title_prefix("text"), "bilingual").alias("title"))

    return membership.overlap_count(keyed("conversations"), keyed("documents"), "title")


@query("""WITH p AS (SELECT doc_id FROM documents WHERE n_chars > 20000), n AS (SELECT count(*) AS n FROM p)
SELECT doc_id FROM p, n WHERE n.n >= 50 UNION ALL
SELECT doc_id FROM documents, n WHERE n.n < 50 AND n_chars > 2000""")
def source_failover(spark, sf):
    d = texts(spark, sf)
    return report.failover(
        d.where("n_chars > 20000").select("doc_id"), d.where("n_chars > 2000").select("doc_id"), 50
    )
