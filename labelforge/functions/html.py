"""Fragments of landed HTML as native column expressions.

Links and opening tags are read with regular expressions inside the JVM.  Elements, which may
nest, and character references, of which there are thousands, are read in Arrow batches,
and only for cells that hold one.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .binding import cuts
from .text import strip_ws

INVISIBLE = r"(?is)" + "|".join(rf"<{t}[^>]*>.*?</{t}>" for t in ("script", "style", "template")) + "|<!--.*?-->"
TAG = r"<[^>]+>"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def unescape_references(text: str) -> str:
    return _html.unescape(text)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def visible(html: Column | str) -> Column:
    """Markup without scripts, styles, templates and comments."""
    return F.regexp_replace(_col(html), INVISIBLE, "")


#: Bytes of a batch that are Python strings at a time.
BYTES = 1_000_000


def _by_parts(fn: Callable, kind: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    """``fn`` of each text of a batch; only a part of the texts and results are Python objects at a time, and freed memory is given back."""
    def run(texts: pa.Array) -> pa.Array:
        ends = np.cumsum([0, *pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)])
        parts = [pa.array([None if t is None else fn(t) for t in texts.slice(lo, hi - lo).to_pylist()], kind) for lo, hi in cuts(ends, BYTES)]
        pa.default_memory_pool().release_unused()
        return pa.concat_arrays(parts) if parts else pa.array([], kind)
    return run


@F.arrow_udf(T.StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    return _by_parts(unescape_references, pa.string())(texts)


def unescape(c: Column | str) -> Column:
    """Text with its character references decoded, named and numeric ones."""
    c = _col(c)
    some = F.contains(c, F.lit("&"))
    # Only texts with a reference are sent to the workers.
    return F.when(some, _unescape(F.when(some, c))).otherwise(c)


_NODE, _ELEMENT = "\x00", "\x01"


def markup_text(markup: Column | str) -> Column:
    """Text nodes, each stripped, joined without a separator."""
    return F.array_join(F.transform(F.split(_decoded(_col(markup)), _NODE), lambda node: strip_ws(node)), "")


def markup_texts(markups: Column) -> Column:
    """:func:`markup_text` of every element of an array."""
    parts = F.split(_decoded(F.array_join(markups, _ELEMENT)), _ELEMENT)
    texts = F.transform(parts, lambda m: F.array_join(F.transform(F.split(m, _NODE), lambda node: strip_ws(node)), ""))
    return F.when(F.size(markups) > 0, texts).otherwise(F.array().cast("array<string>"))


def _decoded(markup: Column) -> Column:
    """Tags replaced by a mark that no text holds, then references decoded."""
    return unescape(F.regexp_replace(markup, rf"(?:{TAG})+", _NODE))


_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


_TAGS = re.compile(r"""<(/?)([a-zA-Z][\w:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")


def _matches(attributes: str, attr: str | None, value: str | None, how: str) -> bool:
    if attr is None:
        return True
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() == attr:
            got = next((g for g in m.groups()[1:] if g is not None), "")
            return value in got if how == "contains" else got.startswith(value) if how == "prefix" else got == value
    return False


def balanced(markup: str, tag: str | None, attr: str | None = None, value: str | None = None, how: str = "equals") -> list[str]:
    """Inner markup of the matching elements in page order.

    An element ends at its own closing tag, or with an element around it that is closed, or with
    the page.  A closing tag without an open element is passed over.
    """
    out: list[str] = []
    stack: list[tuple[str, int | None, int]] = []
    for m in _TAGS.finditer(markup):
        name = m[2].lower()
        if m[1]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                for _, i, start in stack[at:]:
                    if i is not None:
                        out[i] = markup[start : m.start()]
                del stack[at:]
        elif name not in VOID and not m[3].rstrip().endswith("/"):
            hit = (tag is None or name == tag) and _matches(m[3], attr, value, how)
            stack.append((name, len(out) if hit else None, m.end()))
            if hit:
                out.append("")
    for _, i, start in stack:
        if i is not None:
            out[i] = markup[start:]
    return out


def selected(markup: Column | str, tag: str | None, attr: str | None = None, value: str | None = None, how: str | bool = "equals") -> Column:
    """Inner markup of every element that a selector matches, nested ones included.

    ``tag`` may be None for any tag; ``how`` is ``equals``, ``prefix`` or ``contains``.
    """
    how = {True: "contains", False: "equals"}.get(how, how)
    opening = f"(?i)<{tag}[\\s>/]" if tag else f"(?i){attr}"
    run = _by_parts(lambda page: balanced(page, tag, attr, value, how), pa.list_(pa.string()))
    cut = F.arrow_udf(lambda pages: run(pages), "array<string>")
    page = _col(markup)
    some = page.rlike(opening)
    return F.when(some, cut(F.when(some, page))).otherwise(F.array().cast("array<string>"))


def hrefs(markup: Column | str) -> Column:
    """Link targets in page order."""
    return F.regexp_extract_all(
        _col(markup), F.lit(r"""(?i)<a\s(?:[^>]*\s)?href\s*=\s*["']([^"']*)["']"""), F.lit(1)
    )


def without_blocks(markup: Column | str, tags: Sequence[str]) -> Column:
    """Markup with whole elements of the given tags cut out."""
    names = "|".join(tags)
    return F.regexp_replace(_col(markup), rf"(?is)<({names})(\s[^>]*)?>.*?</({names})>", "")
