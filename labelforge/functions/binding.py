"""Bind an expression once so that several lambdas can use its value; cut batches into parts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Return ``body(value)`` with ``value`` computed once per row.

    Sub-expression elimination does not reach into lambdas, so an expensive input
    that a lambda mentions would be computed again for every element.  A lambda
    variable over a one-element array holds the value instead.
    """
    return F.transform(F.array(value), body)[0]


def cuts(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with ``most`` entries at most, one row at least; row ``i`` has the entries ``ends[i]`` to ``ends[i + 1]``."""
    lo = 0
    while lo < len(ends) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi
