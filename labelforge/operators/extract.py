"""Links, titles, blocks and records from landed HTML pages.

Those that read text expect :func:`visible_pages`, so that scripts and comments are cut out once
per page.  Elements follow the nesting.  :func:`page_parts_exact` also knows the ancestors of
each link, from the standard library's parser in Arrow batches of pages.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import (
    absolute_url, any_term, normalize_title, strip_patterns, strip_ws,
)
from .report import longest
from .rules import split_category

Selector = tuple  # (tag, attr or None, value or None, contains)


def visible_pages(pages: DataFrame, html: str) -> DataFrame:
    """Replace each page by its markup without scripts, styles, templates and comments."""
    return pages.withColumn(html, H.visible(html))


def page_links(
    pages: DataFrame, html: str, pattern: str, base: str | Column, keep: Sequence[str],
    exclude_tags: Sequence[str] = (),
) -> DataFrame:
    """``(*keep, pos, link)``: distinct absolute links of each page in page order."""
    markup = H.without_blocks(html, exclude_tags) if exclude_tags else F.col(html)
    wanted = F.filter(H.hrefs(markup), lambda h: h.rlike(pattern))
    base = F.lit(base) if isinstance(base, str) else base
    links = F.array_distinct(F.transform(wanted, lambda h: absolute_url(h, base)))
    return pages.select(*keep, F.posexplode(links).alias("pos", "link"))


def page_link_counts(pages: DataFrame, html: str, keep: Sequence[str], exclude_tags: Sequence[str]) -> DataFrame:
    """Links per page, with and without those inside the given elements."""
    return pages.select(
        *keep,
        F.size(H.hrefs(html)).alias("n_links"),
        F.size(H.hrefs(H.without_blocks(html, exclude_tags))).alias("n_outside"),
    )


def page_anchors(pages: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """``(*keep, pos, href, text)``: every link of each page with its text."""
    anchor = r"""(?is)<a\s(?:[^>]*\s)?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
    found = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(anchor), F.lit(1)).alias("href"),
        F.regexp_extract_all(html, F.lit(anchor), F.lit(2)).alias("markup"),
    )
    return pages.select(*keep, F.posexplode(found).alias("pos", "a")).select(
        *keep, "pos", "a.href", H.markup_text("a.markup").alias("text")
    )


def block_keyword_counts(html: Column | str, selector: Selector, terms: Sequence[str]) -> tuple[Column, Column]:
    """How many elements a selector matches, and how many of their texts hold a keyword."""
    texts = selector_texts(html, selector)
    return F.size(texts), F.size(F.filter(texts, lambda t: any_term(t, terms)))


def title_of(html: Column | str, site_suffix: str | None = None, h1_only: bool = False) -> Column:
    """Text of ``<h1>``, or of ``<title>`` where there is no ``<h1>``, without the site's name.

    With ``h1_only`` a page without ``<h1>`` has an empty title.
    """
    picks = [F.try_element_at(H.selected(html, "h1"), F.lit(1))]
    if not h1_only:
        picks.append(F.try_element_at(H.selected(html, "title"), F.lit(1)))
    text = H.markup_text(F.coalesce(*picks, F.lit("")))
    return strip_ws(F.regexp_replace(text, site_suffix, "")) if site_suffix else text


def page_text(html: Column | str) -> Column:
    """Text of the whole page, each text node stripped."""
    return H.markup_text(F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit("")))


def selector_texts(html: Column | str, selector: Selector) -> Column:
    """Texts of all elements that a ``(tag, attr, value, how)`` selector matches."""
    return H.markup_texts(H.selected(html, *selector))


def first_block(html: Column | str, selectors: Sequence[Selector], min_len: int | None = None,
                or_page: bool = True) -> Column:
    """Text of the first selector that matches, in selector order.

    With ``min_len`` a match must be longer than that.  Without any, the page text or ``""``.
    """
    picks = []
    for s in selectors:
        text = F.try_element_at(selector_texts(html, s), F.lit(1))
        picks.append(text if min_len is None else F.when(F.length(text) > min_len, text))
    return F.coalesce(*picks, page_text(html) if or_page else F.lit(""))


def longest_block(html: Column | str, selector: Selector, fallback_chars: int = 500) -> Column:
    """The longest matching block, else the opening of the page text."""
    best = longest(selector_texts(html, selector))
    # The page's own text is read only where it is taken.
    page = F.when(best == "", F.col(html) if isinstance(html, str) else html)
    return F.when(best != "", best).otherwise(F.substring(page_text(page), 1, fallback_chars))


def block_count(html: Column | str, openings: Sequence[str]) -> Column:
    """How often the first opening pattern that occurs at all does occur."""
    sizes = [F.size(F.regexp_extract_all(F.col(html) if isinstance(html, str) else html, F.lit(p), F.lit(0))) for p in openings]
    return F.coalesce(*[F.when(n > 0, n) for n in sizes], F.lit(0))


def opening(tag: str, attr: str, value: str) -> str:
    """Pattern of an opening tag whose attribute holds a value."""
    return rf'(?i)<{tag}\s(?:[^>]*\s)?{attr}="[^"]*{value}[^"]*"'


def page_cards(
    pages: DataFrame, html: str, keep: Sequence[str], containers: Sequence[str], title_link: str,
) -> DataFrame:
    """``(*keep, raw_title, href)``: one row per listing card with a title and a target.

    ``containers`` are opening-tag patterns; the first that occurs on a page cuts it into
    cards.  ``title_link`` is a pattern with the target as group 1 and the title as group 2.
    """
    page = F.col(html)
    cut = F.coalesce(*[F.when(page.rlike(c), F.split(page, c)) for c in containers], F.array(page))
    cards = pages.select(*keep, F.explode(F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0)))).alias("card"))
    return cards.select(
        *keep,
        strip_ws(H.markup_text(F.regexp_extract("card", title_link, 2))).alias("raw_title"),
        F.regexp_extract("card", title_link, 1).alias("href"),
    ).where((F.col("raw_title") != "") & (F.col("href") != ""))


def pages_to_records(
    pages: DataFrame, html: str, body: Column, category: str, keep: Sequence[str] = (),
    site_suffix: str | None = None, boilerplate: Sequence[str] = (), to_line_end: bool = False,
    min_len: int = 30, split: tuple[str, Sequence[str], str, str] | None = None,
) -> DataFrame:
    """``(*keep, title, text, label)`` for the pages with a title key and enough text.

    ``body`` is an expression over the visible markup in the ``html`` column.  ``split`` is
    ``(category, marker terms, label with a marker, label without)``.
    """
    # A generator's output is computed once, where filters and later columns would
    # otherwise each repeat the extraction.
    parts = F.struct(
        title_of(html, site_suffix).alias("title"), strip_patterns(body, boilerplate, to_line_end).alias("body")
    )
    found = visible_pages(pages, html).select(
        *keep, F.col(category).alias("label"), F.inline(F.array(parts))
    ).where((normalize_title("title", "key") != "") & (F.length("body") >= min_len))
    if split is not None:
        target, terms, yes, no = split
        marked = any_term(F.concat_ws(" ", "title", "body"), terms)
        found = found.withColumn("label", split_category("label", target, marked, yes, no))
    return found.select(*keep, "title", F.concat("title", F.lit(". "), "body").alias("text"), "label")


class _Parts(HTMLParser):
    """Links with their ancestors' class and id words, and texts of selected elements."""

    def __init__(self, selectors: Sequence[Selector]):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.open: list[tuple[str, str, list[int]]] = []
        self.links: list[tuple[str, str]] = []
        self.blocks: list[tuple[int, list[str]]] = []

    def handle_starttag(self, tag, attrs):
        values = {k: v or "" for k, v in attrs}
        if tag == "a" and "href" in values:
            self.links.append((values["href"], " ".join(words for _, words, _ in self.open)))
        mine = []
        for i, (want, attr, value, contains) in enumerate(self.selectors):
            got = None if attr is None else values.get(attr)
            if want == tag and (attr is None or (got is not None and (value in got if contains else value == got))):
                mine.append(len(self.blocks))
                self.blocks.append((i, []))
        if tag not in H.VOID:
            words = f"{values.get('class', '')} {values.get('id', '')}".lower()
            self.open.append((tag, words, mine))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                break

    def handle_data(self, data):
        text = data.strip()
        if text and not any(tag in ("script", "style", "template") for tag, _, _ in self.open):
            for _, _, mine in self.open:
                for b in mine:
                    self.blocks[b][1].append(text)


def page_parts_exact(
    pages: DataFrame, page_id: str, html: str, selectors: Sequence[Selector] = (),
    exclude_words: Sequence[str] = (),
) -> DataFrame:
    """``(page_id, kind, selector, pos, value)``: links and blocks that follow the nesting.

    A link is left out if the class or id of an element around it holds an excluded
    word.  A block's value is its text; ``selector`` is the selector's place in the list.
    """
    id_type = pages.schema[page_id].dataType.simpleString()
    selectors, exclude_words = tuple(selectors), tuple(w.lower() for w in exclude_words)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for pid, page in zip(batch[page_id], batch[html]):
                parser = _Parts(selectors)
                parser.feed(page or "")
                parser.close()
                kept = [h for h, around in parser.links if not any(w in around for w in exclude_words)]
                out += [(pid, "link", None, i, h) for i, h in enumerate(dict.fromkeys(kept))]
                out += [(pid, "block", s, i, "".join(t)) for i, (s, t) in enumerate(parser.blocks)]
            yield pd.DataFrame(out, columns=["page_id", "kind", "selector", "pos", "value"]).astype({"selector": "Int64"})

    return pages.select(page_id, html).mapInPandas(
        parse, f"page_id {id_type}, kind string, selector int, pos int, value string"
    )
