"""Word tokens, n-grams and in-row term counts as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# What counts as a word when training, when scoring exported parameters,
# and when combining marks (vowel signs) should stay inside a word.
WORD_PATTERNS = {
    "train": r"[\p{L}\p{N}_]{2,}",
    "export": r"[\p{L}\p{N}]+",
    "marks": r"[\p{L}\p{M}\p{N}_]{2,}",
}


def tokens(c: Column | str, mode: str = "train", stop_words: Sequence[str] = ()) -> Column:
    """Lowercased words of the whole text, in order, without stop words."""
    c = F.col(c) if isinstance(c, str) else c
    words = F.regexp_extract_all(
        F.lower(F.coalesce(c, F.lit(""))), F.lit(WORD_PATTERNS[mode]), F.lit(0)
    )
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(*stop_words))
    return words


def ngrams(words: Column | str, lo: int = 1, hi: int = 2) -> Column:
    """Space-joined runs of ``lo`` to ``hi`` words, shorter runs first."""
    words = F.col(words) if isinstance(words, str) else words

    def grams(w: Column, n: int) -> Column:
        out = w
        for k in range(1, n):
            # Pair the grams so far with the words k places on; both sides lose the tail.
            keep = F.greatest(F.size(w) - k, F.lit(0))
            out = F.zip_with(
                F.slice(out, F.lit(1), keep), F.slice(w, F.lit(k + 1), keep),
                lambda a, b: F.concat_ws(" ", a, b),
            )
        return out

    return let(words, lambda w: F.concat(*[grams(w, n) for n in range(lo, hi + 1)]))


def counted(terms: Column | str) -> Column:
    """Count equal terms inside the row: ``array<struct<term, n>>``.

    Sorting puts equal terms side by side, and each run's length is its count.  A
    document is one row, so counting there needs no shuffle.
    """
    terms = F.col(terms) if isinstance(terms, str) else terms

    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(0), n), lambda i: (i == 0) | (i == n) | (s[i] != s[i - 1])
        )
        return let(
            starts,
            lambda b: F.transform(
                F.slice(b, F.lit(1), F.size(b) - 1),
                lambda p, j: F.struct(s[p].alias("term"), (b[j + 1] - p).alias("n")),
            ),
        )

    return let(F.sort_array(terms), runs)
