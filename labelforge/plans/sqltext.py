"""Pieces of SQL that several counterparts share, in the dialect of the checking engine."""

from __future__ import annotations

from collections.abc import Sequence

# Written from the specification; nothing is shared with the code under test.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
KEY_CHARS = r"0-9a-z\x{0980}-\x{09FF}"
WORDS = {"train": r"(?:\p{L}|\p{N}|_){2,}", "export": r"(?:\p{L}|\p{N})+", "marks": r"(?:\p{L}|\p{M}|\p{N}|_){2,}"}
TAG = "<[^<>]*>"
# The character references that the pages hold, the ampersand last.
REFERENCES = {
    "&copy;": "\u00a9", "&middot;": "\u00b7", "&nbsp;": "\u00a0", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&",
}

SUFFIX = WS + r"*\([^)]*\)\n?\z"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def strip(x: str) -> str:
    return sub(x, rf"^{WS}+|{WS}+\z")


def collapse(x: str) -> str:
    return strip(sub(x, rf"{WS}+", " "))


def alnum(x: str) -> str:
    return sub(f"lower({x})", "[^a-z0-9]")


def title_key(x: str) -> str:
    return sub(f"lower({x})", f"[^{KEY_CHARS}]")


def title_bilingual(x: str, drop_words: Sequence[str] = ()) -> str:
    y = sub(sub(f"lower({x})", r"\([^\n]*?\)"), r"\[[^\n]*?\]")
    if drop_words:
        y = sub(y, "|".join(drop_words))
    return sub(y, f"[^{KEY_CHARS}]")


def title_suffix(x: str) -> str:
    return strip(f"lower({sub(x, SUFFIX)})")


def words(x: str, mode: str = "train") -> str:
    return f"regexp_extract_all(lower({x}), {lit(WORDS[mode])})"


def case_patterns(x: str, rules, default: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({x}, {lit(p)}) THEN {lit(label)}" for label, p in rules)
    return f"CASE {whens} ELSE {default} END"


def in_list(values: Sequence[str]) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def values_table(values: Sequence[str], name: str) -> str:
    return f"(VALUES {', '.join(f'({lit(v)})' for v in values)}) AS v({name})"


def visible(x: str) -> str:
    for tag in ("script", "style", "template"):
        x = sub(x, f"(?is)<{tag}\\b.*?</{tag}>")
    return sub(x, "(?s)<!--.*?-->")


def element_pattern(tag: str, attr: str | None = None, value: str | None = None, contains: bool = False) -> str:
    """Inner markup, as group 1, of elements that hold none of their own kind, as on the test pages."""
    inside = "" if attr is None else rf'[^>]*?\s{attr}="' + (f'[^"]*{value}[^"]*"' if contains else f'{value}"')
    return rf"(?is)<{tag}\b{inside}[^>]*>(.*?)</{tag}>"


def markup_text(x: str) -> str:
    node = "n"
    for name, char in REFERENCES.items():
        node = f"replace({node}, {lit(name)}, {lit(char)})"
    return f"array_to_string(list_transform(regexp_split_to_array({x}, {lit(TAG)}), lambda n: {strip(node)}), '')"


def element_texts(x: str, *selector) -> str:
    found = f"regexp_extract_all({visible(x)}, {lit(element_pattern(*selector))}, 1)"
    return f"list_transform({found}, lambda m: {markup_text('m')})"


def title_of(x: str) -> str:
    h1, title = element_pattern("h1"), element_pattern("title")
    y = visible(x)
    return (
        f"CASE WHEN regexp_matches({y}, {lit(h1)}) THEN {markup_text(f'regexp_extract({y}, {lit(h1)}, 1)')} "
        f"ELSE {markup_text(f'regexp_extract({y}, {lit(title)}, 1)')} END"
    )

DOC_TITLE = "string_split(text, '. ')[1]"
