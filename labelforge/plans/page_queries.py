"""Extraction over landed pages, payloads and feeds."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions import text as X
from ..operators import extract
from ..operators.rules import keyword_audit
from ..sources import payloads
from . import sqltext as S
from .registry import query, table
from .set_queries import DOC_SIG, TWO_KEYS_SQL
from .text_queries import NOTES, texts

BASE = "https://pages.example.org"
LINK = "^/[A-Za-z]"
NAV = ("nav", "header", "footer")
AD = ("div", "class", "ad", True)
SIDE = ("div", "id", "summary", False)
ARTICLE = ("article", None, None, False)
PARAGRAPH = ("p",)
SUFFIX = r"\.$"


def pages(spark, sf):
    return table(spark, sf, "pages")


def visible(spark, sf):
    return extract.visible_pages(pages(spark, sf), "html")


HREF = r"""(?i)<a\s(?:[^>]*\s)?href\s*=\s*["']([^"']*)["']"""
ANCHOR = r"""(?is)<a\s(?:[^>]*\s)?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
NO_NAV = S.sub("html", r"(?is)<(nav|header|footer)(\s[^>]*)?>.*?</(nav|header|footer)>")
LINKS_SQL = f"""hrefs AS (SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) AS i
    FROM (SELECT page_id, regexp_extract_all(html, {S.lit(HREF)}, 1) AS h FROM pages)),
links AS (SELECT page_id, CASE WHEN starts_with(href, 'http') THEN href ELSE '{BASE}' || href END AS link, min(i) AS i
    FROM hrefs WHERE regexp_matches(href, '{LINK}') GROUP BY ALL)"""


@query(f"WITH {LINKS_SQL} SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos, link FROM links")
def page_links(spark, sf):
    links = extract.page_links(pages(spark, sf), "html", LINK, BASE, ["page_id"])
    return links.withColumn("pos", F.col("pos").cast("bigint"))


@query(f"WITH {LINKS_SQL} SELECT page_id, count(*) AS n_links, string_agg(link, ' ' ORDER BY i) AS links FROM links GROUP BY page_id")
def array_distinct_links(spark, sf):
    wanted = F.filter(H.hrefs("html"), lambda h: h.rlike(LINK))
    links = F.array_distinct(F.transform(wanted, lambda h: X.absolute_url(h, BASE)))
    return pages(spark, sf).select("page_id", links.alias("a")).where(F.size("a") > 0).select(
        "page_id", F.size("a").cast("bigint").alias("n_links"), F.array_join("a", " ").alias("links")
    )


@query(f"""SELECT page_id, len(regexp_extract_all(html, {S.lit(HREF)}, 1)) AS n_links,
    len(regexp_extract_all({NO_NAV}, {S.lit(HREF)}, 1)) AS n_outside FROM pages""")
def page_links_no_nav(spark, sf):
    counts = extract.page_link_counts(pages(spark, sf), "html", ["page_id"], NAV)
    return counts.select("page_id", *[F.col(c).cast("bigint").alias(c) for c in ("n_links", "n_outside")])


WORDS = ("promo", "menu")


@query(f"""WITH h AS (SELECT page_id, regexp_extract_all(html, {S.lit(HREF)}, 1) AS h FROM pages WHERE page_id % 4 <> 0),
    l AS (SELECT page_id, unnest(h) AS link, generate_subscripts(h, 1) AS i FROM h),
    f AS (SELECT page_id, link, min(i) AS i FROM l WHERE NOT regexp_matches(link, '^/[a-mA-M]') GROUP BY ALL)
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos, link FROM f""")
def page_links_outside_words(spark, sf):
    """Links that no element with an excluded class or id word is around.

    The pages have no such element around a link, so some list items get a class, with an element left
    open inside, and the navigation of every fourth page an id.
    """
    item = F.regexp_replace("html", '<li>(<a href="/[a-mA-M])', '<li class="Promo box"><span>$1')
    nav = F.when(F.col("page_id") % 4 == 0, F.replace(item, F.lit("<nav>"), F.lit('<nav id="Side-Menu">'))).otherwise(item)
    parts = extract.page_parts_exact(pages(spark, sf).select("page_id", nav.alias("html")), "page_id", "html", exclude_words=WORDS)
    return parts.where("kind = 'link'").select("page_id", F.col("pos").cast("bigint").alias("pos"), F.col("value").alias("link"))


ANCHORS_SQL = f"""anchors AS (SELECT page_id, unnest(h) AS href, unnest(m) AS m FROM (
    SELECT page_id, regexp_extract_all({S.visible('html')}, {S.lit(ANCHOR)}, 1) AS h,
        regexp_extract_all({S.visible('html')}, {S.lit(ANCHOR)}, 2) AS m FROM pages))"""
TEXT_WORDS, HREF_WORDS = ("ing", "lich"), ("tion", "ment")


@query(f"""WITH {ANCHORS_SQL}, t AS (SELECT page_id, href, {S.markup_text('m')} AS text FROM anchors)
    SELECT page_id, href, text FROM t WHERE regexp_matches(text, 'ing|lich') OR regexp_matches(href, 'tion|ment')""")
def link_keyword_audit(spark, sf):
    anchors = extract.page_anchors(visible(spark, sf), "html", ["page_id"])
    return keyword_audit(anchors, "text", "href", TEXT_WORDS, HREF_WORDS).select("page_id", "href", "text")


# Texts of the paragraphs, some of which stay open until the article ends: a paragraph's text is that of
# the stretches between its tag and the token that brings the depth back.
TOKEN = S.lit(r"(?i)</?p(?:\s[^>]*)?>|</article>")
PARAGRAPHS_SQL = f"""v AS (SELECT *, {S.visible('html')} AS v FROM pages),
tk AS (SELECT *, regexp_extract_all(v, {TOKEN}) AS toks,
    list_transform(regexp_split_to_array(v, {TOKEN}), lambda s: {S.markup_text('s')}) AS segs FROM v),
sg AS (SELECT *, list_transform(toks, lambda x: CASE WHEN starts_with(x, '</') THEN -1 ELSE 1 END) AS signs FROM tk),
pp AS (SELECT *, list_transform(list_filter(range(1, len(toks) + 1), lambda t: signs[t] = 1), lambda t: array_to_string(
    segs[t + 1:coalesce(list_min(list_filter(range(t + 1, len(toks) + 1),
        lambda j: toks[j] = '</article>' OR list_sum(signs[t:j]) <= 0)), len(toks) + 1)], '')) AS p FROM sg)"""


@query(f"""WITH {PARAGRAPHS_SQL} SELECT page_id, len(p) AS items,
    len(list_filter(p, lambda x: regexp_matches(lower(x), 'ing|lich'))) AS matching FROM pp""")
def page_keyword_counts(spark, sf):
    items, matching = extract.block_keyword_counts("html", PARAGRAPH, TEXT_WORDS)
    return visible(spark, sf).select(
        "page_id", items.cast("bigint").alias("items"), matching.cast("bigint").alias("matching")
    )


@query(f"SELECT page_id, {S.strip(S.sub(S.title_of('html'), SUFFIX))} AS title FROM pages")
def page_titles(spark, sf):
    return visible(spark, sf).select("page_id", extract.title_of("html", SUFFIX).alias("title"))


@query(f"SELECT page_id, {S.markup_text(S.visible('html'))} AS text FROM pages")
def page_text(spark, sf):
    return visible(spark, sf).select("page_id", extract.page_text("html").alias("text"))


def _first_text(*selector) -> str:
    return f"({S.element_texts('html', *selector)})[1]"


FALLBACK_SQL = f"""CASE WHEN length({_first_text(*SIDE)}) > 60 THEN {_first_text(*SIDE)}
    WHEN length({_first_text(*AD)}) > 60 THEN {_first_text(*AD)}
    WHEN length(p[1]) > 60 THEN p[1]
    ELSE {S.markup_text(S.visible('html'))} END"""


@query(f"WITH {PARAGRAPHS_SQL} SELECT page_id, {FALLBACK_SQL} AS body FROM pp")
def page_body_fallback(spark, sf):
    body = extract.first_block("html", (SIDE, AD, PARAGRAPH), min_len=60)
    return visible(spark, sf).select("page_id", body.alias("body"))


@query(f"""WITH {PARAGRAPHS_SQL} SELECT page_id, CASE WHEN len(t) = 0 OR list_max(list_transform(t, lambda x: length(x))) = 0
        THEN substr({S.markup_text(S.visible('html'))}, 1, 500)
        ELSE list_filter(t, lambda x: length(x) = list_max(list_transform(t, lambda y: length(y))))[1] END AS body
    FROM (SELECT page_id, html, p AS t FROM pp)""")
def page_longest_block(spark, sf):
    return visible(spark, sf).select("page_id", extract.longest_block("html", PARAGRAPH).alias("body"))


@query(r"""SELECT page_id, CASE WHEN n > 0 THEN n ELSE m END AS blocks FROM (SELECT page_id,
    len(regexp_extract_all(html, '(?i)<div\s(?:[^>]*\s)?class="[^"]*card[^"]*"')) AS n,
    len(regexp_extract_all(html, '(?i)<div\s(?:[^>]*\s)?class="[^"]*ad[^"]*"')) AS m FROM pages)""")
def page_block_counts(spark, sf):
    openings = (extract.opening("div", "class", "card"), extract.opening("div", "class", "ad"))
    return pages(spark, sf).select("page_id", extract.block_count("html", openings).cast("bigint").alias("blocks"))


CATEGORY = r"/([a-z][a-z])/"
PHRASES = ("of the", "nicht")
MARKERS = ("tion", "ment")
RECORDS_SQL = f"""WITH {PARAGRAPHS_SQL},
t AS (SELECT page_id, url, regexp_extract(url, '{CATEGORY}', 1) AS cat,
    {S.strip(S.sub(S.title_of('html'), SUFFIX))} AS title, {FALLBACK_SQL} AS body FROM pp),
c AS (SELECT page_id, url, cat, title, {S.collapse(S.sub(S.sub('body', '(?i)of the'), '(?i)nicht'))} AS body FROM t)
SELECT page_id, url, title, title || '. ' || body AS text,
    CASE WHEN cat = 'en' THEN CASE WHEN regexp_matches(lower(title || ' ' || body), 'tion|ment') THEN 'en-marked' ELSE 'en-plain' END ELSE cat END AS label
FROM c WHERE {S.title_key('title')} <> '' AND length(body) >= 30"""


def records(landed):
    """Pages to labelled records; also the transform of the incremental ingest."""
    with_category = landed.withColumn("category", F.regexp_extract("url", CATEGORY, 1))
    body = extract.first_block("html", (SIDE, AD, PARAGRAPH), min_len=60)
    return extract.pages_to_records(
        with_category, "html", body, "category", ["page_id", "url"], SUFFIX, PHRASES,
        split=("en", MARKERS, "en-marked", "en-plain"),
    )


@query(RECORDS_SQL)
def pages_to_records(spark, sf):
    return records(pages(spark, sf))


@query(f"""WITH {ANCHORS_SQL} SELECT page_id, {S.strip(S.markup_text('m'))} AS raw_title, href FROM anchors
    WHERE {S.strip(S.markup_text('m'))} <> '' AND href <> ''""")
def page_cards(spark, sf):
    link = r"""(?is)<a\s(?:[^>]*\s)?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
    return extract.page_cards(visible(spark, sf), "html", ["page_id"], [r"(?i)<section[^>]*>", r"(?i)<li[^>]*>"], link)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_items(spark, sf):
    """Event properties wrapped as a payload of one item each."""
    payload = F.concat(F.lit('{"data":['), "props", F.lit("]}"))
    events = table(spark, sf, "events").select("event_id", payload.alias("payload"))
    item = T.StructType().add("k", "long")
    return payloads.parse_json_items(events, "payload", item, ["event_id"]).select("event_id", "k")


def feed(spark, sf):
    """Documents as feed files of one entry each, written as XML text."""
    entry = F.struct(X.title_prefix("text").alias("title"), F.col("text").alias("summary"))
    xml = F.to_xml(F.struct(F.array(entry).alias("entry")), {"rowTag": "feed"})
    return texts(spark, sf).select("doc_id", xml.alias("xml"))


@query(f"SELECT doc_id, {S.collapse(S.DOC_TITLE)} AS title, {S.collapse('text')} AS summary FROM documents")
def xml_entries(spark, sf):
    entries = payloads.parse_xml_entries(feed(spark, sf), "xml", keep=["doc_id"])
    return entries.select(
        "doc_id", X.collapse_ws("title").alias("title"), X.collapse_ws("summary").alias("summary")
    )


@query(f"""WITH e AS (SELECT doc_id, {S.collapse(S.DOC_TITLE)} AS title, {S.collapse('text')} AS details FROM documents)
    SELECT doc_id, title, details, title || ' ' || details AS text, 'reference' AS label, 'feed' AS source FROM e
    WHERE title <> '' AND length(details) > 50 QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id) = 1""")
def entries_to_records(spark, sf):
    entries = payloads.parse_xml_entries(feed(spark, sf), "xml", keep=["doc_id"])
    return payloads.entries_to_records(entries, ["doc_id"], "reference", "feed")


WORD1, WORD2 = "string_split(text, '. ')[1]", "string_split(text, '. ')[2]"
ENGLISH = f"CASE WHEN doc_id % 4 = 0 THEN '' ELSE {WORD2} END"
CLEAN = S.collapse(S.sub(S.sub("text", "(?i)" + NOTES[0]), "(?i)" + NOTES[1]))
ITEMS_SQL = f"""
good AS (SELECT doc_id, coalesce(nullif({ENGLISH}, ''), {WORD1}, '') AS shown, {CLEAN} AS clean,
    {S.alnum(WORD1)} AS a, coalesce({S.alnum(f"coalesce(nullif({ENGLISH}, ''), {WORD1})")}, '') AS b
    FROM documents WHERE length({CLEAN}) >= 50),
known AS (SELECT DISTINCT {DOC_SIG} AS sig FROM benchmark),
probes AS (SELECT a AS sig FROM good UNION SELECT b FROM good),
hit AS (SELECT sig FROM probes WHERE length(sig) > 5 AND EXISTS (SELECT 1 FROM known k WHERE contains(k.sig, probes.sig))),
fresh AS (SELECT * FROM good WHERE a NOT IN (SELECT sig FROM hit) AND b NOT IN (SELECT sig FROM hit)),
keyed AS (SELECT doc_id AS id, a, b FROM fresh),"""


@query(TWO_KEYS_SQL.replace(TWO_KEYS_SQL[TWO_KEYS_SQL.index("keyed AS"):TWO_KEYS_SQL.index("pairs AS")], ITEMS_SQL.lstrip() + "\n")
       .replace("SELECT id AS doc_id FROM step WHERE state = 1 GROUP BY id",
                "SELECT doc_id, shown || '. ' || clean AS text, 'items' AS label FROM fresh "
                "WHERE doc_id IN (SELECT id FROM step WHERE state = 1) ORDER BY doc_id LIMIT 490"))
def items_to_records(spark, sf):
    """Documents as nested payload items: titles, synopsis, then cleaning and de-duplication."""
    words = F.split("text", "[.] ")
    first, second = F.try_element_at(words, F.lit(1)), F.try_element_at(words, F.lit(2))
    english = F.when(F.col("doc_id") % 4 == 0, "").otherwise(second)
    attributes = F.struct(
        first.alias("canonicalTitle"),
        F.create_map(F.lit("en"), english).alias("titles"),
        F.col("text").alias("synopsis"),
    )
    payload = F.to_json(F.struct(F.array(F.struct(attributes.alias("attributes"))).alias("data")))
    landed = texts(spark, sf).select("doc_id", payload.alias("payload"))
    items = payloads.nested_titles(payloads.parse_json_items(landed, "payload", payloads.NESTED_ITEM, ["doc_id"]))
    known = table(spark, sf, "benchmark").select(X.alnum_signature("text", 100).alias("sig"))
    return payloads.items_to_records(items, known, "sig", ["doc_id"], "items", target=490, notes=NOTES)
