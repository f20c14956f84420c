"""Items from landed JSON payloads and XML feeds, and their cleaning into records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (
    alnum_signature, assemble_text, collapse_ws, first_nonblank, strip_patterns,
)
from ..operators.common import stored
from ..operators.dedup import keep_first, keep_first_two_keys
from ..operators.membership import drop_contained
from ..operators.report import take_first

FLAT_ITEM = T.StructType().add("title", "string").add("title_english", "string").add("synopsis", "string")
NESTED_ITEM = T.StructType().add(
    "attributes",
    T.StructType()
    .add("canonicalTitle", "string")
    .add("titles", T.MapType(T.StringType(), T.StringType()))
    .add("synopsis", "string"),
)
ENTRY = T.StructType().add("title", "string").add("summary", "string")


def parse_json_items(
    df: DataFrame, col: str, item: T.StructType, keep: Sequence[str] = (), path: str = "data"
) -> DataFrame:
    """``(*keep, item_no, *item fields)``: one row per item of each payload's array."""
    schema = T.StructType([T.StructField(path, T.ArrayType(item))])
    items = F.from_json(col, schema)[path]
    return df.select(*keep, F.posexplode(items).alias("item_no", "item")).select(*keep, "item_no", "item.*")


def nested_titles(items: DataFrame, languages: Sequence[str] = ("en", "en_jp")) -> DataFrame:
    """Flatten nested items to the flat item's columns."""
    a = F.col("attributes")
    english = first_nonblank(*[a["titles"][k] for k in languages], a["canonicalTitle"])
    return items.select(
        *[c for c in items.columns if c != "attributes"],
        F.coalesce(a["canonicalTitle"], F.lit("")).alias("title"),
        english.alias("title_english"),
        a["synopsis"].alias("synopsis"),
    )


def read_xml_entries(spark: SparkSession, path: str, fields: T.StructType = ENTRY, row_tag: str = "entry") -> DataFrame:
    """One row per entry element of the files at ``path``; a missing child is NULL."""
    return spark.read.schema(fields).format("xml").option("rowTag", row_tag).load(path)


def parse_xml_entries(
    df: DataFrame, col: str, fields: T.StructType = ENTRY, keep: Sequence[str] = (), row_tag: str = "entry"
) -> DataFrame:
    """``(*keep, item_no, *fields)``: one row per entry of each landed feed document."""
    schema = T.StructType([T.StructField(row_tag, T.ArrayType(fields))])
    entries = F.from_xml(col, schema)[row_tag]
    return df.select(*keep, F.posexplode(entries).alias("item_no", "e")).select(*keep, "item_no", "e.*")


def clean_items(items: DataFrame, notes: Sequence[str] = ()) -> DataFrame:
    """Add the chosen title, both signatures and the synopsis without editorial notes."""
    return items.withColumns({
        "shown_title": first_nonblank("title_english", F.coalesce("title", F.lit(""))),
        "clean": strip_patterns("synopsis", notes),
        "sig_a": alnum_signature("title"),
        "sig_b": alnum_signature(first_nonblank("title_english", "title")),
    })


def items_to_records(
    items: DataFrame, known: DataFrame, known_sig: str, order: Sequence[str], label: str,
    min_len: int = 50, target: int | None = None, notes: Sequence[str] = (),
) -> DataFrame:
    """``(*order, text, label)`` for items that are long enough and new.

    An item goes if a signature of it lies inside a known one, or if an earlier kept
    item has one of its signatures.  ``target`` takes the first rows in order.
    """
    good = clean_items(items, notes).where(F.length("clean") >= min_len)
    # Decide on narrow rows of signatures; the texts are read again for the kept items only.
    keys = stored(good.select(*order, "sig_a", "sig_b"), "signatures")
    fresh = drop_contained(keys, ["sig_a", "sig_b"], known, known_sig)
    kept = keep_first_two_keys(stored(fresh, "fresh"), "sig_a", "sig_b", order).select(*order)
    if target is not None:
        kept = take_first(kept, order, target)
    return good.join(kept, list(order), "left_semi").select(
        *order, F.concat("shown_title", F.lit(". "), "clean").alias("text"), F.lit(label).alias("label")
    )


def entries_to_records(
    entries: DataFrame, order: Sequence[str], label: str, source: str, longer_than: int = 50
) -> DataFrame:
    """``(*order, title, details, text, label, source)``, the first record of each title."""
    cleaned = entries.select(
        *order,
        F.coalesce(collapse_ws("title"), F.lit("")).alias("title"),
        F.coalesce(collapse_ws("summary"), F.lit("")).alias("details"),
    ).where((F.col("title") != "") & (F.length("details") > longer_than))
    records = cleaned.select(
        "*", assemble_text(["title", "details"]).alias("text"),
        F.lit(label).alias("label"), F.lit(source).alias("source"),
    )
    return keep_first(records, "title", order)
