"""Text normalisers and text assembly as native column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as white space in str.strip and in \s.
WS = (
    r"[\x{0009}-\x{000D}\x{001C}-\x{0020}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# The same characters as a string.
WS_CHARS = "".join(
    chr(c)
    for lo, hi in ((0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                   (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
    for c in range(lo, hi + 1)
)

# Letters a bilingual title key keeps (ASCII letters, digits, Bengali block).
KEY_CHARS = r"a-z0-9\x{0980}-\x{09FF}"

# The cell texts pandas reads as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove surrounding white space of any kind; plain ``trim`` would take spaces only.

    Trimming looks at the ends alone, where a pattern would search the whole text.
    """
    return F.btrim(_col(c), F.lit(WS_CHARS))


def collapse_ws(c: Column | str) -> Column:
    """Turn each run of white space into one space and strip the ends."""
    spaces = F.translate(_col(c), WS_CHARS, " " * len(WS_CHARS))
    return F.btrim(F.regexp_replace(spaces, " {2,}", " "), F.lit(" "))


def alnum_signature(c: Column | str, prefix: int | None = None) -> Column:
    """Lowercase ``a-z0-9`` signature, of the first ``prefix`` characters if given.

    A prefix is taken after stripping, as the signature of a stored text is.
    """
    c = _col(c)
    if prefix is not None:
        c = F.substring(strip_ws(c), 1, prefix)
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")


def normalize_title(c: Column | str, style: str = "suffix", drop_words: Sequence[str] = ()) -> Column:
    """Title key for matching.

    ``suffix`` drops one closing ``(...)``, lowercases and strips.  ``bilingual`` drops
    every ``(...)`` and ``[...]`` and the given edition words, then keeps
    :data:`KEY_CHARS`.  ``key`` only keeps :data:`KEY_CHARS`.
    """
    c = F.coalesce(_col(c), F.lit(""))
    if style == "suffix":
        return strip_ws(F.lower(F.regexp_replace(c, rf"{WS}*\([^)]*\)\n?\z", "")))
    c = F.lower(c)
    if style == "bilingual":
        c = F.regexp_replace(F.regexp_replace(c, r"\([^\n]*?\)", ""), r"\[[^\n]*?\]", "")
        if drop_words:
            c = F.regexp_replace(c, any_of(drop_words), "")
    elif style != "key":
        raise ValueError(f"unknown title style {style!r}")
    return F.regexp_replace(c, f"[^{KEY_CHARS}]+", "")


def fallback_key(title: Column | str, text: Column | str, n: int = 40, drop_words: Sequence[str] = ()) -> Column:
    """Bilingual key of the title, or of the first ``n`` characters of the text if blank."""
    return F.coalesce(
        F.nullif(normalize_title(title, "bilingual", drop_words), F.lit("")),
        normalize_title(F.substring(_col(text), 1, n), "bilingual", drop_words),
    )


def any_of(terms: Iterable[str]) -> str:
    """Regex alternation of literal terms."""
    return "|".join(re.escape(t) for t in terms)


def strip_patterns(c: Column | str, patterns: Sequence[str], to_line_end: bool = False) -> Column:
    """Remove every match of each pattern, any case, then collapse white space.

    With ``to_line_end`` a match takes the rest of its line too.  NULL becomes ``""``.
    """
    tail = r"[^\n]*" if to_line_end else ""
    cleaned = reduce(
        lambda acc, p: F.regexp_replace(acc, f"(?iu)(?:{p}){tail}", ""),
        patterns,
        F.coalesce(_col(c), F.lit("")),
    )
    return collapse_ws(cleaned)


def title_prefix(c: Column | str, sep: str = ". ") -> Column:
    """The part before the first separator, or the whole text."""
    return F.substring_index(_col(c), sep, 1)


def strip_ui_suffix(c: Column | str, label: str) -> Column:
    """Strip, drop a closing interface label such as a "more" button, strip again."""
    c = strip_ws(c)
    without = F.substring(c, F.lit(1), F.length(c) - F.lit(len(label)))
    return F.when(c.endswith(label), strip_ws(without)).otherwise(c)


def absolute_url(href: Column | str, base: str | Column, only_rooted: bool = False) -> Column:
    """Prefix ``base`` unless the link starts with ``http``; or only if it starts with ``/``."""
    href = _col(href)
    base = F.lit(base) if isinstance(base, str) else base
    relative = href.startswith("/") if only_rooted else ~href.startswith("http")
    return F.when(relative, F.concat(base, href)).otherwise(href)


def assemble_text(parts: Sequence[Column | str], sep: str = " ") -> Column:
    """Join stripped parts, NULL as ``""``, keeping every separator; strip the result."""
    clean = [F.coalesce(strip_ws(p), F.lit("")) for p in parts]
    joined = [clean[0]]
    for part in clean[1:]:
        joined += [F.lit(sep), part]
    return strip_ws(F.concat(*joined))


def first_nonblank(*cols: Column | str) -> Column:
    """First value that is neither NULL nor ``""``; the last is taken as it is."""
    *heads, last = [_col(c) for c in cols]
    return F.coalesce(*[F.nullif(h, F.lit("")) for h in heads], last)


def null_if_token(c: Column | str, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """NULL for a cell that holds a missing-value token."""
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


def as_text(c: Column | str, pandas_compat: bool = True) -> Column:
    """Cast to string; in compatibility mode NULL becomes the word ``nan``."""
    c = _col(c).cast("string")
    return F.coalesce(c, F.lit("nan")) if pandas_compat else c


def any_term(c: Column | str, terms: Sequence[str]) -> Column:
    """True if the lowercased text holds any term as a substring."""
    return F.coalesce(F.lower(_col(c)).rlike(any_of(terms)), F.lit(False))


def percent(c: Column | str, digits: int = 2, signed: bool = False) -> Column:
    """A share as percent text, such as ``58.08%`` or ``+1.25%``."""
    return F.format_string(f"%{'+' if signed else ''}.{digits}f%%", _col(c) * 100)
