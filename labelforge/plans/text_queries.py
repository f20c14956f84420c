"""Text normalisers, filters, rules and labels over ``documents``, ``part`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedup, report, rules
from ..sources.files import null_tokens as null_out
from . import sqltext as S
from .registry import query, table

TAG_RULES = (
    ("warm", ("red", "hot")),
    ("metal", ("bolt", "gear", "ring")),
    ("cool", ("blue", "cold", "green")),
    ("small", ("small",)),
)
TEXT_RULES = (
    ("legal", rules.word_edges("license|copyright")),
    ("contact", r"[a-z0-9]@[a-z0-9]"),
    ("english", rules.word_edges("the|and")),
    ("german", rules.word_edges("der|die|und")),
    ("french", rules.word_edges("le|les|des")),
)
EXTRA_NA = ("src3", "fr")
NOTES = (r"\([0-9]+\)", r"\*[^*\n]+\*")
PHRASES = ("of the", "de la", "in der")
TAIL_PHRASES = ("and the", "en el")
MARKERS = ("tion", "ung", "ment")
DROP_WORDS = ("ing", "ung")


def documents(spark, sf):
    return table(spark, sf, "documents")


def texts(spark, sf):
    """Documents over all cores, for queries that work on every word."""
    return documents(spark, sf)


@query(f"""SELECT doc_id, n_chars,
    CASE WHEN lang IN {S.in_list(X.NA_TOKENS + EXTRA_NA)} THEN NULL ELSE lang END AS lang,
    CASE WHEN source IN {S.in_list(X.NA_TOKENS + EXTRA_NA)} THEN NULL ELSE source END AS source
    FROM documents""")
def null_tokens(spark, sf):
    d = documents(spark, sf).select("doc_id", "n_chars", "lang", "source")
    return null_out(d, ["lang", "source"], X.NA_TOKENS + EXTRA_NA)


@query(f"""SELECT doc_id,
    {S.strip(f"coalesce({S.strip('source')}, '') || ' ' || coalesce({S.strip('text')}, '')")} AS with_space,
    {S.strip(f"coalesce({S.strip('source')}, '') || '. ' || coalesce({S.strip('text')}, '')")} AS with_stop
    FROM documents""")
def assemble_text(spark, sf):
    return texts(spark, sf).select(
        "doc_id",
        X.assemble_text(["source", "text"]).alias("with_space"),
        X.assemble_text(["source", "text"], ". ").alias("with_stop"),
    )


@query(f"SELECT doc_id, length(text) AS n FROM documents WHERE length({S.strip('text')}) > 0")
def filter_nonempty(spark, sf):
    return texts(spark, sf).where(F.length(X.strip_ws("text")) > 0).select(
        "doc_id", F.length("text").cast("bigint").alias("n")
    )


@query(f"SELECT doc_id, length({S.collapse('text')}) AS n FROM documents WHERE length({S.collapse('text')}) >= 500")
def filter_min_length(spark, sf):
    d = texts(spark, sf).select("doc_id", F.length(X.collapse_ws("text")).cast("bigint").alias("n"))
    return d.where("n >= 500")


@query("SELECT p_partkey, length(text) AS n FROM part LEFT JOIN documents ON p_partkey = doc_id WHERE text IS NOT NULL")
def drop_null_text(spark, sf):
    """Parts with the document of their number; those without one have no text."""
    joined = table(spark, sf, "part").join(texts(spark, sf), F.col("p_partkey") == F.col("doc_id"), "left")
    return joined.na.drop(subset=["text"]).select("p_partkey", F.length("text").cast("bigint").alias("n"))


@query("""SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'ECONOMY' ELSE p_type END AS p_type FROM part""")
def label_remap(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_type").replace({"PROMO": "ECONOMY"}, subset=["p_type"])


@query("""SELECT doc_id, coalesce(nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, ''),
    nullif(CASE WHEN n_chars > 1000 THEN source END, ''), '') AS picked FROM documents""")
def coalesce_nonblank(spark, sf):
    d = documents(spark, sf).select(
        "doc_id",
        F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("a"),
        F.when(F.col("n_chars") > 1000, F.col("source")).alias("b"),
    )
    return d.select("doc_id", X.first_nonblank("a", "b", F.lit("")).alias("picked"))


def _text_query(name, column, expression, source="documents", key="doc_id"):
    """Register one normaliser over every row of a table."""
    @query(f"SELECT {key}, {expression} AS out FROM {source}", name)
    def run(spark, sf):
        return table(spark, sf, source).select(key, column().alias("out"))


_text_query("strip_ws", lambda: X.strip_ws("text"), S.strip("text"))
_text_query("collapse_ws", lambda: X.collapse_ws("text"), S.collapse("text"))
_text_query("alnum_signature", lambda: X.alnum_signature("text"), S.alnum("text"))
_text_query("title_norm_suffix", lambda: X.normalize_title("text", "suffix"), S.title_suffix("text"))
_text_query("title_norm_bilingual", lambda: X.normalize_title("text", "bilingual", DROP_WORDS), S.title_bilingual("text", DROP_WORDS))
_text_query("title_key_bilingual", lambda: X.normalize_title("text", "key"), S.title_key("text"))
_text_query(
    "fallback_key",
    lambda: X.fallback_key(F.when(F.col("lang") != "fr", X.title_prefix("text")).otherwise(F.lit("!")), "text", 40),
    f"""coalesce(nullif({S.title_bilingual("CASE WHEN lang <> 'fr' THEN string_split(text, '. ')[1] ELSE '!' END")}, ''),
        {S.title_bilingual('substr(text, 1, 40)')})""",
)
_text_query("strip_notes", lambda: X.strip_patterns("text", NOTES), S.collapse(S.sub(S.sub("text", "(?i)" + NOTES[0]), "(?i)" + NOTES[1])))
_text_query(
    "strip_phrases", lambda: X.strip_patterns("text", PHRASES),
    S.collapse(S.sub(S.sub(S.sub("text", "(?i)" + PHRASES[0]), "(?i)" + PHRASES[1]), "(?i)" + PHRASES[2])),
)
_text_query(
    "strip_tail_boilerplate", lambda: X.strip_patterns("text", TAIL_PHRASES, to_line_end=True),
    S.collapse(S.sub(S.sub("text", f"(?i){TAIL_PHRASES[0]}[^\\n]*"), f"(?i){TAIL_PHRASES[1]}[^\\n]*")),
)
_text_query("title_prefix", lambda: X.title_prefix("text"), "string_split(text, '. ')[1]")
_text_query(
    "strip_ui_suffix", lambda: X.strip_ui_suffix("text", "."),
    f"""CASE WHEN ends_with({S.strip('text')}, '.')
        THEN {S.strip(f"left({S.strip('text')}, length({S.strip('text')}) - 1)")} ELSE {S.strip('text')} END""",
)


@query(f"""SELECT doc_id, {S.alnum(f"substr({S.strip('text')}, 1, 100)")} AS sig FROM documents
    WHERE {S.alnum(f"substr({S.strip('text')}, 1, 100)")} <> ''""")
def prefix_signature(spark, sf):
    return texts(spark, sf).select("doc_id", X.alnum_signature("text", 100).alias("sig")).where("sig <> ''")


def tags(spark, sf):
    """Part names as list literals, the form tags arrive in, parsed back to arrays."""
    literal = F.concat(F.lit("['"), F.replace("p_name", F.lit(" "), F.lit("', '")), F.lit("']"))
    return table(spark, sf, "part").select(
        "p_partkey", "p_name", "p_type", rules.parse_tag_list(literal).alias("tags")
    )


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part")
def split_tags(spark, sf):
    return tags(spark, sf).select("p_partkey", F.explode("tags").alias("tag"))


def _case_tags() -> str:
    whens = " ".join(
        f"WHEN list_has_any(string_split(p_name, ' '), [{', '.join(S.lit(t) for t in names)}]) THEN {S.lit(label)}"
        for label, names in TAG_RULES
    )
    return f"CASE {whens} END"


@query(f"SELECT p_partkey, {_case_tags()} AS label FROM part")
def priority_tag_label(spark, sf):
    return rules.label_by_tags(tags(spark, sf), "tags", TAG_RULES).select("p_partkey", "label")


@query(f"SELECT p_partkey, {_case_tags()} AS label FROM part WHERE {_case_tags()} IS NOT NULL")
def tag_table_label(spark, sf):
    rows = [(i, label, tag) for i, (label, names) in enumerate(TAG_RULES) for tag in names]
    rule_table = spark.createDataFrame(rows, "priority int, label string, tag string")
    return rules.label_by_tag_table(tags(spark, sf), "p_partkey", "tags", rule_table)


@query(f"SELECT doc_id, {S.case_patterns('text', TEXT_RULES, 'NULL')} AS label FROM documents")
def regex_fallback_label(spark, sf):
    return rules.label_by_patterns(texts(spark, sf), "text", TEXT_RULES).select("doc_id", "label")


LABEL_ITEMS_SQL = f"""
WITH items AS (
    SELECT doc_id, {S.strip("coalesce(source, '') || ' ' || coalesce(" + S.strip('text') + ", '')")} AS text,
        string_split(p_name, ' ') AS tags, p_name
    FROM documents LEFT JOIN part ON doc_id * 2 = p_partkey),
labelled AS (
    SELECT doc_id, text, coalesce({_case_tags()}, {S.case_patterns('text', TEXT_RULES, "'Miscellaneous'")}) AS label
    FROM items WHERE length(text) > 0),
firsts AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM labelled)
SELECT label, count(*) AS n, sum(length(text))::BIGINT AS chars FROM firsts WHERE rn = 1 GROUP BY label"""


@query(LABEL_ITEMS_SQL)
def label_items(spark, sf):
    """Assemble, label by tags and then patterns, drop exact copies, count per label."""
    d = texts(spark, sf)
    parts = tags(spark, sf).select((F.col("p_partkey") / 2).alias("half"), "tags").where("half = floor(half)")
    items = d.join(parts, F.col("doc_id") == F.col("half").cast("bigint"), "left").select(
        "doc_id", "tags", X.assemble_text(["source", "text"]).alias("text")
    ).where(F.length("text") > 0)
    labelled = rules.label_items(items, "tags", "text", TAG_RULES, TEXT_RULES)
    firsts = dedup.keep_first(labelled.select("doc_id", "text", "label"), "text", ["doc_id"])
    return firsts.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).cast("bigint").alias("chars")
    )


@query(f"SELECT doc_id, regexp_matches(lower(source || ' ' || text), '{'|'.join(MARKERS)}') AS flag FROM documents")
def any_term_flag(spark, sf):
    return texts(spark, sf).select("doc_id", X.any_term(F.concat_ws(" ", "source", "text"), MARKERS).alias("flag"))


@query("""SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN
    CASE WHEN regexp_matches(lower(p_name), 'red|blue') THEN 'PROMO COLOUR' ELSE 'PROMO PLAIN' END
    ELSE p_type END AS category FROM part""")
def split_category(spark, sf):
    flag = X.any_term("p_name", ("red", "blue"))
    return table(spark, sf, "part").select(
        "p_partkey", rules.split_category("p_type", "PROMO", flag, "PROMO COLOUR", "PROMO PLAIN").alias("category")
    )


@query("""SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def label_distribution(spark, sf):
    return report.distribution(documents(spark, sf), "lang")


@query("SELECT count(DISTINCT lang) AS n_labels FROM documents")
def label_nunique(spark, sf):
    return report.nunique(documents(spark, sf), "lang")


@query("SELECT DISTINCT source FROM documents")
def sorted_labels(spark, sf):
    return report.sorted_values(documents(spark, sf), "source")


KNOWN_TYPES = ("click", "view", "refund", "signup")


@query(f"""SELECT event_type, count(events.event_id) AS n FROM {S.values_table(KNOWN_TYPES, 'event_type')}
    LEFT JOIN events USING (event_type) GROUP BY event_type""")
def counts_zero_filled(spark, sf):
    return report.counts_zero_filled(table(spark, sf, "events"), "event_type", KNOWN_TYPES)


KEPT, SHORT, KNOWN = "kept", "short", "cross_dup"


@query(f"""WITH tagged AS (
    SELECT doc_id, lang, CASE WHEN length({S.collapse('text')}) < 500 THEN 'short' WHEN doc_id IN
        (SELECT doc_id FROM labels WHERE quality = 0) THEN 'cross_dup' ELSE 'kept' END AS outcome FROM documents),
numbered AS (
    SELECT *, sum((outcome = 'kept')::INT) OVER (PARTITION BY lang ORDER BY doc_id) AS upto FROM tagged)
SELECT lang, outcome, count(*) AS n FROM numbered
WHERE upto < 90 OR (upto = 90 AND outcome = 'kept') GROUP BY lang, outcome""")
def ingest_funnel(spark, sf):
    bad = table(spark, sf, "labels").where("quality = 0").select("doc_id", F.lit(True).alias("bad"))
    d = texts(spark, sf).select("doc_id", "lang", F.length(X.collapse_ws("text")).alias("n_clean"))
    outcome = F.when(F.col("n_clean") < 500, SHORT).when(F.col("bad"), KNOWN).otherwise(KEPT)
    return report.funnel(d.join(bad, "doc_id", "left"), "lang", outcome, until_kept=90, order=["doc_id"])


@query("SELECT doc_id, source FROM documents WHERE n_chars >= 1000 ORDER BY source, doc_id LIMIT 210")
def take_first_n(spark, sf):
    long = documents(spark, sf).where("n_chars >= 1000").select("doc_id", "source")
    return report.take_first(long, ["source", "doc_id"], 210)


@query("""SELECT conv_id, turn, role FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 3""")
def cap_per_category(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return report.cap_per_group(c, "conv_id", ["turn"], 3)


@query("""SELECT doc_id, (list_sort(list_transform(list_zip(range(1, len(s) + 1), s),
        lambda z: {'k': -length(z[2]), 'i': z[1], 's': z[2]}))[1]).s AS longest
    FROM (SELECT doc_id, string_split(text, '. ') AS s FROM documents)""")
def longest_candidate(spark, sf):
    sentences = F.split(F.col("text"), r"\. ")
    return texts(spark, sf).select("doc_id", report.longest(sentences).alias("longest"))


@query("""SELECT source, avg_chars, round(avg_chars - first_value(avg_chars) OVER (ORDER BY source), 6) AS delta
    FROM (SELECT source, round(avg(n_chars), 6) AS avg_chars FROM documents GROUP BY source)""")
def delta_vs_baseline(spark, sf):
    from ..operators.evaluate import with_delta

    per_source = documents(spark, sf).groupBy("source").agg(F.round(F.avg("n_chars"), 6).alias("avg_chars"))
    return with_delta(per_source, "source", "avg_chars").withColumn("delta", F.round("delta", 6))


@query("""SELECT lang, printf('%.2f%%', share * 100) AS acc, printf('%+.2f%%', (share - 0.25) * 100) AS delta, round(share, 4) AS share4
    FROM (SELECT lang, count(*) / sum(count(*)) OVER () AS share FROM documents GROUP BY lang)""")
def format_metrics(spark, sf):
    from pyspark.sql import Window

    n = documents(spark, sf).groupBy("lang").agg(F.count("*").alias("n"))
    share = n.select("lang", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias("share"))
    return share.select(
        "lang", X.percent("share").alias("acc"), X.percent(F.col("share") - 0.25, signed=True).alias("delta"),
        F.round("share", 4).alias("share4"),
    )


@query(f"""SELECT doc_id, p_partkey, text, lang, p_type, source_rank FROM (
    SELECT doc_id, NULL AS p_partkey, text, lang, NULL AS p_type, 0 AS source_rank FROM documents UNION ALL
    SELECT NULL, p_partkey, p_name, NULL, p_type, 1 FROM part UNION ALL
    SELECT NULL, NULL, text, 'bench', NULL, 2 FROM benchmark)""")
def union_by_name(spark, sf):
    return dedup.union_sources({
        "documents": documents(spark, sf).select("doc_id", "text", "lang"),
        "parts": table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("text"), "p_type"),
        "bench": table(spark, sf, "benchmark").select("text", F.lit("bench").alias("lang")),
    }).select("doc_id", "p_partkey", "text", "lang", "p_type", "source_rank")
