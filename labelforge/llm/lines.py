"""Line de-duplication by site-relative frequency, with built-in functions only.

A line is boilerplate of a site if it is on more than a given share of the site's pages.  A site has
at most ``lines per page / share`` such lines, so its list stays small however large the site is;
lists are written, and Spark broadcasts them if the written size allows, else it joins by site and
splits skewed sites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stored


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_dedup(docs: DataFrame, site_col: str = "source", text_col: str = "text", percent: int = 8, min_pages: int = 5,
               distinct: bool = False) -> DataFrame:
    """``docs`` without the boilerplate lines, and ``n_lines`` and ``n_removed``.

    A line goes if it is on ``min_pages`` pages or more and on more than ``percent`` in a hundred of
    the site's pages, compared as it stands.  Each row is a page; a line counts once a page.  Blank
    lines stay and never count.  Rows without a site form one site.  A null text stays null and has no
    lines; an empty text is one blank line.  Repeated rows are pages of their own, or with ``distinct``
    rows of a site with equal text are one page, so that many copies of a page do not make its lines
    boilerplate.  Columns of the input named ``n_lines`` or ``n_removed`` are replaced.
    """
    marks = F.transform(F.filter(_lines(F.col(text_col)), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x))
    found = docs.select(F.col(site_col).alias("site"), F.xxhash64(text_col).alias("page"), F.array_distinct(marks).alias("marks"))
    if distinct:
        found = stored(found.dropDuplicates(["site", "page"]), "pages")
    seen = found.select("site", F.explode("marks").alias("line"))
    often = seen.groupBy("site", "line").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= min_pages)
    pages = found.groupBy(F.col("site").alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    cut = often.join(pages, often["site"].eqNullSafe(pages["host"])).where(100 * F.col("c") > percent * F.col("pages"))
    lists = stored(cut.groupBy("site").agg(F.collect_set("line").alias("lines")), "boilerplate")

    own = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    site, text = F.col("doc").getField(site_col), F.col("doc").getField(text_col)
    joined = docs.select(own).join(lists, site.eqNullSafe(F.col("site")), "left")
    kept = F.filter(_lines(text), lambda x: (F.trim(x) == "") | ~F.array_contains("lines", F.xxhash64(x)))
    kept = F.when(F.col("lines").isNull(), _lines(text)).otherwise(kept)
    out = joined.select("doc", F.when(text.isNotNull(), F.size(_lines(text))).otherwise(0).cast("long").alias("n"), kept.alias("kept"))
    columns = [
        (F.array_join("kept", "\n") if c == text_col else F.col("doc").getField(c)).alias(c)
        for c in docs.columns if c not in ("n_lines", "n_removed")
    ]
    return out.select(*columns, F.col("n").alias("n_lines"),
                      F.when(F.col("kept").isNotNull(), F.col("n") - F.size("kept")).otherwise(0).cast("long").alias("n_removed"))
