"""Labels from ordered tag rules and ordered text patterns.

Rules are arguments: tag rules as ``[(label, [tag, ...]), ...]`` and text rules as
``[(label, regex), ...]``, both in order of priority.  :func:`load_rules` reads both from a file.
"""

from __future__ import annotations

from collections.abc import Sequence
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.text import any_of
from .common import lookup_join

TagRules = Sequence[tuple[str, Sequence[str]]]
TextRules = Sequence[tuple[str, str]]

# A short example set, to show the shape.
EXAMPLE_TAG_RULES: TagRules = (
    ("Adventure", ("Quest", "Sea Stories")),
    ("Science", ("Physics", "Astronomy")),
)
EXAMPLE_TEXT_RULES: TextRules = (("Science", r"(?iu)\b(telescope|particle physics)\b"),)


def load_rules(spark: SparkSession, path: str) -> tuple[TagRules, TextRules]:
    """Read ``{"tags": [[label, [tag, ...]], ...], "patterns": [[label, regex], ...]}``."""
    doc = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return [(label, tags) for label, tags in doc["tags"]], [tuple(p) for p in doc["patterns"]]


def word_edges(body: str) -> str:
    """Pattern for ``body`` between word edges, any case, the same in Java and RE2."""
    return rf"(?i)(^|[^\p{{L}}\p{{N}}_])(?:{body})([^\p{{L}}\p{{N}}_]|$)"


def parse_tag_list(c: Column | str) -> Column:
    """Array from a list literal in a text cell; anything else gives an empty array."""
    c = F.col(c) if isinstance(c, str) else c
    # Rewrite what a Python list literal allows and lenient JSON does not.
    text = F.regexp_replace(c, r",\s*\]\s*\z", "]")
    # From one match to the next only brackets, commas and whole quoted elements are passed.
    passed = r"""\G((?:\s*+(?:\[|,|'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"))*+\s*+)None(?=\s*[,\]])"""
    text = F.regexp_replace(text, passed, "$1null")
    text = F.regexp_replace(text, r"\\x([0-9A-Fa-f]{2})", r"\\u00$1")
    parsed = F.from_json(
        text, "array<string>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )
    is_list = F.ltrim(c).startswith("[")
    return F.coalesce(F.when(is_list, F.array_compact(parsed)), F.array().cast("array<string>"))


def tag_label(tags: Column | str, rules: TagRules) -> Column:
    """Label of the first rule that shares a tag with the item, else NULL."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    return let(
        tags,
        lambda t: F.coalesce(
            *[F.when(F.arrays_overlap(t, F.array(*map(F.lit, names))), F.lit(label)) for label, names in rules],
            F.lit(None).cast("string"),
        ),
    )


def pattern_label(text: Column | str, rules: TextRules) -> Column:
    """Label of the first pattern found in the text, else NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        *[F.when(text.rlike(pattern), F.lit(label)) for label, pattern in rules],
        F.lit(None).cast("string"),
    )


def label_by_tags(df: DataFrame, tags: str, rules: TagRules, out: str = "label") -> DataFrame:
    return df.withColumn(out, tag_label(tags, rules))


def label_by_patterns(df: DataFrame, text: str, rules: TextRules, out: str = "label") -> DataFrame:
    return df.withColumn(out, pattern_label(text, rules))


def label_items(
    df: DataFrame, tags: str | None, text: str, tag_rules: TagRules, text_rules: TextRules,
    default: str = "Miscellaneous", out: str = "label",
) -> DataFrame:
    """Tag rules first, text patterns only where those find nothing, else the default."""
    found = [pattern_label(text, text_rules), F.lit(default)]
    if tags is not None:
        found.insert(0, tag_label(tags, tag_rules))
    return df.withColumn(out, F.coalesce(*found))


def label_by_tag_table(df: DataFrame, item: str, tags: str, rules: DataFrame, out: str = "label") -> DataFrame:
    """As :func:`label_by_tags` for a rule table ``(priority, label, tag)`` of any size.

    Returns ``(item, label)`` for the items that match.  The best match per item is an
    aggregate with a partial step, so an item never gathers all its matches.
    """
    exploded = df.select(item, F.explode(F.array_distinct(tags)).alias("tag"))
    matched = lookup_join(exploded, rules.select("priority", "label", "tag"), "tag")
    return matched.groupBy(item).agg(F.min_by("label", "priority").alias(out))


def split_category(category: Column | str, target: str, flag: Column, yes: str, no: str) -> Column:
    """Replace one category by two, on a flag; other categories stay."""
    category = F.col(category) if isinstance(category, str) else category
    return F.when(category == target, F.when(flag, yes).otherwise(no)).otherwise(category)


def keyword_audit(links: DataFrame, text: str, href: str, text_terms: Sequence[str], href_terms: Sequence[str]) -> DataFrame:
    """Links whose text or target holds a keyword (case counts)."""
    return links.where(F.col(text).rlike(any_of(text_terms)) | F.col(href).rlike(any_of(href_terms)))
