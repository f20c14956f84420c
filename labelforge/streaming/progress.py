"""Crawl progress: resume points, page caps and work lists."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

_STATE = "category string, next_page long, completed boolean"


class Progress(StatefulProcessor):
    """Per category the page after the last one seen, and whether it is completed.

    Both only ever grow, so pages may come in any order and any split into batches, and a batch that is
    repeated changes nothing.  Each change is put out; see :func:`latest`.
    """

    def init(self, handle) -> None:
        self.state = handle.getValueState("progress", "next_page long, completed boolean")

    def _grow(self, key, next_page: int, completed: bool):
        before = tuple(self.state.get()) if self.state.exists() else (None, False)
        now = (next_page if before[0] is None else max(before[0], next_page), bool(before[1]) or completed)
        if now != before:
            self.state.update(now)
            yield pd.DataFrame({"category": [key[0]], "next_page": [now[0]], "completed": [now[1]]})

    def handleInputRows(self, key, rows, timerValues):
        last, completed = None, False
        for part in rows:
            last = max([int(part["page"].max()), *([] if last is None else [last])])
            completed = completed or bool(part["completed"].any())
        yield from self._grow(key, last + 1, completed)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((int(initialState["next_page"].max()), bool(initialState["completed"].any())))

    def close(self) -> None:
        pass


def track(pages: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Changes of progress ``(category string, next_page, completed)`` from a stream ``(category string, page long, completed boolean)``.

    ``before`` is the progress of earlier runs, in the columns of the output, and is read when the stream first starts.
    The stream needs the RocksDB state store, see :func:`.ingest.append_changes`.
    """
    start = None if before is None else before.groupBy("category")
    return pages.groupBy("category").transformWithStateInPandas(Progress(), _STATE, "Update", "None", start)


def latest(changes: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``(category, next_page, completed)`` from all changes so far, and categories that did not change."""
    every = changes.select("category", "next_page", "completed")
    every = every if before is None else every.unionByName(before)
    return every.groupBy("category").agg(F.max("next_page").alias("next_page"), F.bool_or("completed").alias("completed"))


def resume_points(
    pages: DataFrame, category: str, page: str, completed: DataFrame | None = None
) -> DataFrame:
    """``(category, next_page)``: one past the last page of each category not completed."""
    points = pages.groupBy(category).agg((F.max(page) + 1).alias("next_page"))
    return points if completed is None else points.join(completed.select(category), category, "left_anti")


def page_worklist(categories: DataFrame, category: str, url: str, first: str, n_pages: int, template: str) -> DataFrame:
    """``(category, page, page_url)``: ``n_pages`` pages from ``first`` on; page 1 is the bare URL."""
    pages = categories.select(
        category, url, F.explode(F.sequence(F.col(first), F.col(first) + (n_pages - 1))).alias("page")
    )
    numbered = F.format_string(template, F.col(url), F.col("page"))
    return pages.select(category, "page", F.when(F.col("page") > 1, numbered).otherwise(F.col(url)).alias("page_url"))


def chunk_worklist(targets: DataFrame, name: str, total: str, chunk: int = 50) -> DataFrame:
    """``(name, chunk_no, start, max_results)``: chunks that cover each target count."""
    n = F.ceil(F.col(total) / chunk).cast("int")
    chunks = targets.where(F.col(total) > 0).select(name, total, F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_no"))
    start = F.col("chunk_no").cast("bigint") * chunk
    return chunks.select(
        name, "chunk_no", start.alias("start"), F.least(F.lit(chunk), F.col(total) - start).alias("max_results")
    )
