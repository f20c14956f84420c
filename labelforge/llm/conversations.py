"""Conversation structure repair by a streamed dynamic programme.

Rows are repartitioned by conversation and sorted by turn, and ``mapInPandas`` reads them once.  What it
carries from row to row, and so from one Arrow batch to the next, is the cheapest cost of each of four
states of the role pattern ``(s?(ua)+)?`` and the order of their edit strings; both are relative, so that
there are few combinations and each step is looked up.

A conversation that outgrows a block is spilled block by block: a record holds the rows and, for each
state at the block's end, the state at its beginning and the edits between, one byte a row.  Only those
states are followed back afterwards, by a second stream over the blocks in descending order; the blocks
are then written out independently of each other.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import deal, stored

#: Rows and characters of a block, and bytes of a partition.
BLOCK_ROWS, BLOCK_CHARS, PARTITION = 20_000, 4_000_000, 8_000_000
SPACES = " \t\n\x0b\x0c\r"
#: Faults, the first that fits counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5

_NAMES = {"u": "user", "a": "assistant"}
# States: nothing yet, after s, after u, after a.  The role that may follow, other than s, and the state it leads to.
_WANTED, _AFTER = "uuau", (2, 2, 3, 2)
_ACCEPTING = (0, 3)
_START = ((0, 0), None, None, None)
_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_STREAM = f"conv string, block int, blocks int, {_COUNTS}, audit string, repaired string, roles array<string>, texts array<string>, origins array<int>, edits array<string>, final int"


def _advance(state: int, initial: str) -> int | None:
    if state == 0 and initial == "s":
        return 1
    return _AFTER[state] if _WANTED[state] == initial else None


def _choices(before: int, initial: str, fault: int):
    """``(state, cost, edits)`` of each way to take one row from the state ``before``."""
    state = before
    for n in range(3):
        cost, edits = n * INSERT, "I" * n
        yield state, cost + DELETE, edits + "D"
        if fault in (SOUND, TRUNCATED):
            cost += CUT_OFF if fault == TRUNCATED else 0
            kept = _advance(state, initial)
            if kept is not None:
                yield kept, cost + KEEP, edits + "K"
            if _WANTED[state] != initial:
                yield _AFTER[state], cost + REROLE, edits + "R"
        state = _AFTER[state]


@lru_cache(None)
def _step(states: tuple, code: int) -> tuple[tuple, int, tuple]:
    """The states after a row, what their least cost grew by, and ``(state before, edits)`` of each.

    ``states`` holds for each state its cost above the least and the rank of its edit string.  No string
    of one state begins a string of another, as each ends with the same row, so ranks decide whatever follows.
    """
    best: list = [None] * 4
    for before, known in enumerate(states):
        if known is not None:
            for state, cost, edits in _choices(before, "suax"[code // 4], code % 4):
                key = (known[0] + cost, known[1], edits, before)
                if best[state] is None or key < best[state]:
                    best[state] = key
    least = min(b[0] for b in best if b)
    order = sorted(b[1:3] for b in best if b)
    after = tuple(b and (b[0] - least, order.index(b[1:3])) for b in best)
    return after, least, tuple(b and (b[3], b[2]) for b in best)


def _finish(states: tuple) -> tuple[int, int, str]:
    """Cheapest end: cost above the least, state and the edits that complete it."""
    ends = []
    for state, known in enumerate(states):
        if known is not None:
            n, at = 0, state
            while at not in _ACCEPTING:
                n, at = n + 1, _AFTER[at]
            ends.append((known[0] + n * INSERT, known[1], "I" * n, state))
    cost, _, edits, state = min(ends)
    return cost, state, edits


def _follow(moves: list, state: int) -> tuple[int, str]:
    """State before the block and its edits, if ``state`` is the one at its end."""
    edits = []
    for move in reversed(moves):
        state, edit = move[state]
        edits.append(edit)
    return state, "".join(reversed(edits))


def _write(state: int, edits: str, roles, texts) -> str:
    """The repaired rows as ``role:text`` lines; ``state`` is the one before them."""
    rows, out = zip(roles, texts), []
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = _advance(state, role[:1])
        else:
            role, state = _NAMES[_WANTED[state]], _AFTER[state]
        out.append(f"{role}:{text}")
    return "\n".join(out)


class _Conversation:
    """What is carried of the conversation that is being read."""

    def __init__(self, conv):
        self.conv, self.states, self.cost, self.block = conv, _START, 0, 0
        self.faults, self.illegal, self.last = [0] * 4, 0, ""
        self.turn = self.low = None
        self.turns = 0
        self._clear()

    def _clear(self) -> None:
        self.roles, self.texts, self.moves, self.size = [], [], [], 0

    def add(self, turn, role: str, text: str, code: int) -> None:
        if turn is not None and turn != self.turn:
            self.low = turn if self.turn is None else self.low
            self.turn = turn
            self.turns += 1
        initial = "suax"[code // 4]
        self.illegal += bool(self.last) and self.last + initial not in ("su", "ua", "au")
        self.last = initial
        self.faults[code % 4] += 1
        self.states, grown, moves = _step(self.states, code)
        self.cost += grown
        self.roles.append(role)
        self.texts.append(text)
        self.moves.append(moves)
        self.size += len(text)

    def spill(self) -> tuple:
        paths = [_follow(self.moves, s) if known else (None, None) for s, known in enumerate(self.states)]
        row = (self.conv, self.block, None, *[None] * 8, self.roles, self.texts, [p for p, _ in paths], [e for _, e in paths], None)
        self.block += 1
        self._clear()
        return row

    def close(self) -> tuple:
        more, final, tail = _finish(self.states)
        gaps = int(self.turn) - int(self.low) + 1 - self.turns if self.turns else 0
        counts = (gaps, *self.faults[1:], self.illegal, self.cost + more)
        before, edits = _follow(self.moves, final)
        if not self.block:
            return (self.conv, 0, 1, *counts, edits + tail, _write(before, edits + tail, self.roles, self.texts), *[None] * 5)
        return (self.conv, self.block, self.block + 1, *counts, None, None, self.roles, self.texts,
                [before if s == final else None for s in range(4)], [edits + tail if s == final else None for s in range(4)], final)


_STREAM_NAMES = [f.split()[0] for f in _STREAM.split(", ")]


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(_STREAM_NAMES, zip(*rows))})


def _stream(block_rows: int, block_chars: int):
    def run(batches):
        now, out, size = None, [], 0
        for batch in batches:
            for conv, turn, role, text, code in zip(*(batch[c].tolist() for c in ("conv", "turn", "role", "text", "code"))):
                if now is None or conv != now.conv:
                    if now is not None:
                        size += now.size
                        out.append(now.close())
                    now = _Conversation(conv)
                if code >= 0:
                    if len(now.roles) >= block_rows or now.size >= block_chars:
                        size += now.size
                        out.append(now.spill())
                    now.add(turn, role, text, code)
                if size >= block_chars:
                    yield _frame(out)
                    out, size = [], 0
        if now is not None:
            out.append(now.close())
        if out:
            yield _frame(out)
    return run


def _followed_back(batches):
    """Blocks of a conversation, the last first: the state at the end of each."""
    conv, state, seen = None, None, False
    for batch in batches:
        ends = []
        for c, final, origins in zip(batch["conv"], batch["final"], batch["origins"]):
            if not seen or c != conv:
                conv, state, seen = c, int(final), True
            ends.append(state)
            state = int(origins[state])
        yield pd.DataFrame({"conv": batch["conv"], "block": batch["block"], "end": ends})


def _written(batches):
    for batch in batches:
        rows = list(zip(batch["end"], batch["origins"], batch["edits"], batch["roles"], batch["texts"]))
        yield batch[["conv", "block"]].assign(
            audit=[edits[e] for e, _, edits, _, _ in rows],
            repaired=[_write(int(origins[e]), edits[e], roles, texts) for e, origins, edits, roles, texts in rows])


def faults(role: Column, text: Column, repeated: Column) -> Column:
    """``4 * role + fault`` of a row, the role being the place of its initial in ``sua``, or 3."""
    end = F.rtrim(text, F.lit(SPACES))
    fault = (F.when(end == "", BLANK).when(repeated, DUPLICATE).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND))
    place = F.coalesce(*[F.when(F.substring(role, 1, 1) == x, i) for i, x in enumerate("sua")], F.lit(3))
    return (place * 4 + fault).cast("int")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           dropped: Column | None = None, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The cheapest edits that give each conversation the role pattern ``(s?(ua)+)?``.

    Keeping a row costs 0, another role (user or assistant) 1, deleting it 2, inserting an empty row of
    user or assistant 5, and leaving a truncated row in 5.  Blank rows and repeats must go.  Of equally cheap edits
    the ASCII-least string of initials (``D I K R``) is taken.

    Returns ``conv, block, blocks, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired``, one row
    per conversation; a giant one has a row per block, and ``blocks`` and the counts on its last alone.  Its
    ``audit`` pieces are joined as they are, its non-empty ``repaired`` pieces by a newline.

    Rows are taken by turn, nulls first, equal turns by role and text.  A null role or text is one space.
    Rows for which ``dropped`` holds only make their conversation known.  Rows with a null conversation are
    one conversation.  Repeated rows are repeats.  Without rows that are not dropped, an audit is empty.
    Further columns are ignored.  An empty table gives no rows.
    """
    gone = F.lit(False) if dropped is None else F.coalesce(dropped, F.lit(False))
    narrow = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), gone.alias("gone"),
        F.when(~gone, F.coalesce(role_col, F.lit(" "))).alias("role"), F.when(~gone, F.coalesce(text_col, F.lit(" "))).alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    dealt = deal(narrow, -(-size // PARTITION), "conv")
    # The data are dealt by conversation already, so counting repeats sorts each partition and moves nothing.
    nth = F.expr("row_number() OVER (PARTITION BY conv, role, text, gone ORDER BY turn NULLS FIRST)")
    coded = dealt.withColumn("nth", nth).select("*", F.when(F.col("gone"), -1).otherwise(faults(F.col("role"), F.col("text"), F.col("nth") > 1)).alias("code"))
    ordered = coded.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "nth")
    ready = ordered.select(F.col("conv").cast("string"), F.col("turn").cast("string"), "role", "text", "code")
    out = stored(ready.mapInPandas(_stream(block_rows, block_chars), _STREAM), "repaired")
    names = ["conv", "block", "blocks", *[c.split()[0] for c in _COUNTS.split(", ")]]
    whole = out.where("blocks = 1").select(*names, "audit", "repaired")
    blocks = out.where("blocks IS NULL OR blocks > 1")
    # One record of a few bytes per block: these are what a giant conversation brings together again.
    links = blocks.select("conv", "block", "final", "origins").repartition("conv").sortWithinPartitions("conv", F.col("block").desc())
    ends = links.mapInPandas(_followed_back, "conv string, block int, end int").withColumnRenamed("conv", "c").withColumnRenamed("block", "b")
    found = blocks.join(ends, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    pieces = found.select("conv", "block", "end", "origins", "edits", "roles", "texts").mapInPandas(_written, "conv string, block int, audit string, repaired string")
    pieces = pieces.withColumnRenamed("conv", "c").withColumnRenamed("block", "b")
    giant = blocks.drop("audit", "repaired").join(pieces, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select(*names, "audit", "repaired")
    kind = rows.schema[conv_col].dataType
    return whole.unionByName(giant).withColumn("conv", F.col("conv").cast(kind))


def _digests(batches):
    """Pieces of a conversation in order: SHA-256 of the joined lines, after the last piece."""
    conv, digest, lines = None, None, False
    for batch in batches:
        out = []
        for c, blocks, text in zip(batch["conv"].tolist(), batch["blocks"].tolist(), batch["repaired"].tolist()):
            if digest is None:
                conv, digest, lines = c, hashlib.sha256(), False
            if text:
                digest.update((("\n" if lines else "") + text).encode())
                lines = True
            if not pd.isna(blocks):
                out.append((conv, digest.hexdigest()))
                digest = None
        if out:
            yield pd.DataFrame({"c": pd.Series([c for c, _ in out], dtype=object), "repaired_sha256": [d for _, d in out]})


def joined(pieces: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`, with ``audit`` joined and the digest of the repaired lines."""
    whole = pieces.where("blocks = 1").withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("block", "blocks", "repaired")
    giant = stored(pieces.where("blocks IS NULL OR blocks > 1"), "giant")
    ordered = giant.select(F.col("conv").cast("string"), "block", "blocks", "repaired").repartition("conv").sortWithinPartitions("conv", "block")
    digests = ordered.mapInPandas(_digests, "c string, repaired_sha256 string")
    audits = giant.groupBy("conv").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x.audit), "").alias("audit"))
    audits = audits.withColumnRenamed("conv", "k")
    last = giant.where("blocks > 1").drop("block", "blocks", "audit", "repaired")
    last = last.join(audits, F.col("conv").eqNullSafe(F.col("k"))).drop("k")
    return whole.unionByName(last.join(digests, F.col("conv").cast("string").eqNullSafe(F.col("c"))).drop("c"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with planted faults, and ``dropped`` for those that are lost."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
                       (kind == 0).alias("dropped"), F.explode(times).alias("time")).drop("time")
