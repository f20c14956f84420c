"""Key-set membership: signature sets, semi and anti joins, exact containment."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .substrings import likely_substrings


def signature_set(
    tables: Sequence[DataFrame], col: str, fn: Callable[[Column], Column], out: str = "sig",
    drop_blank: bool = True,
) -> DataFrame:
    """Distinct signatures of one column over several tables."""
    parts = [t.where(F.col(col).isNotNull()).select(fn(F.col(col)).alias(out)) for t in tables]
    sigs = reduce(DataFrame.unionByName, parts)
    return (sigs.where(F.col(out) != "") if drop_blank else sigs).distinct()


def drop_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``known``.

    The keys need not be distinct: without an aggregate inside the join, adaptive execution
    can split a hot key of ``df``.
    """
    return df.join(known.select(key), key, "left_anti")


def overlap_count(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """One row ``overlap``: how many rows have their key in ``other``; 0 without that column."""
    if key not in other.columns:
        return df.agg(F.lit(0).cast("bigint").alias("overlap"))
    return df.join(other.select(key), key, "left_semi").agg(F.count("*").alias("overlap"))


def contained_signatures(probes: DataFrame, known: DataFrame, sig: str, min_len: int = 6) -> DataFrame:
    """Distinct ``sig`` values of ``probes`` that occur inside some ``sig`` of ``known``.

    The known signatures are cut where they are read, at the places and lengths where a filter of
    bounded size has the substring; whole substrings meet whole probes in an equality join.  The
    work is linear in the known signatures whatever their number per gram, since no pair
    of a probe and a known signature is ever formed, and only substrings that the filter has move.
    """
    wanted = probes.select(sig).where(F.length(sig) >= min_len)
    cut = likely_substrings(known.select(sig), wanted, min_len)
    return wanted.distinct().join(cut.distinct(), sig, "left_semi")


def drop_contained(
    df: DataFrame, sig_cols: Sequence[str], known: DataFrame, known_sig: str, min_len: int = 6
) -> DataFrame:
    """Rows of which no signature of ``min_len`` or more characters lies inside a known one.

    The distinct signatures and the hits among them are written, since several joins
    read them and making them may be costly.
    """
    known = known.select(F.col(known_sig).alias("sig"))
    each = df.select(F.explode(F.array(*sig_cols)).alias("sig")).where(F.length("sig") >= min_len)
    hits = stored(contained_signatures(stored(each.distinct(), "probes"), known, "sig", min_len), "hits")
    for c in sig_cols:
        df = df.join(hits.select(F.col("sig").alias(c)), c, "left_anti")
    return df
