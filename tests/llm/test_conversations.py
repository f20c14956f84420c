"""Repair of conversations against a search over all edits."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from labelforge.llm import conversations
from labelforge.llm.conversations import damaged, joined, repair

SCHEMA = "conv_id long, turn long, role string, text string, code int, block string"
SPACES = " \t\n\x0b\x0c\r"


def model(rows):
    """All cheapest edits of ``(turn, role, text)`` rows, tried one by one; the least string of initials."""
    rows = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for t, r, x in rows))
    turns = [t for known, t, _, _ in rows if known]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, _, r, x in rows:
        body = x.rstrip(SPACES)
        faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((r, x))
    initials = [r[:1] for _, _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    best = None
    todo = [(0, "", (), 0)]  # cost, edits, lines, rows taken
    limit = 2 * len(rows) + 5 * sum(f == "truncated" for f in faults)
    while todo:
        cost, edits, lines, i = todo.pop()
        if cost > limit or best and (cost, edits) > best[:2] and cost > best[0]:
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(line[0][:1] or "?" for line in lines)):
            best = min(best or (cost, edits, lines), (cost, edits, lines))
        if edits[-3:] != "III":
            todo += [(cost + 5, edits + "I", lines + ((r, ""),), i) for r in ("user", "assistant")]
        if i < len(rows):
            _, _, r, x = rows[i]
            todo.append((cost + 2, edits + "D", lines, i + 1))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                todo.append((cost + more, edits + "K", lines + ((r, x),), i + 1))
                todo += [(cost + more + 1, edits + "R", lines + ((n, x),), i + 1) for n in ("user", "assistant")]
    text = "\n".join(f"{r}:{x}" for r, x in best[2])
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, best[0], best[1], hashlib.sha256(text.encode()).hexdigest())


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def some_rows(seed, convs, longest):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "s", "Assistant"], ["Yes.", "no", " \t", "", None, "What?\n", "ok! ", "é。", "."]
    return [(c, rng.choice([None, *range(longest)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}" + rng.choice([".", "", "!\n"]))
            for c in [None, *range(convs)] for _ in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("options", [{}, {"block_rows": 1}, {"block_rows": 2}, {"block_chars": 12}])
def test_repair_equals_a_search_of_all_edits(spark, options):
    rows = some_rows(5, 60, 6)
    got = joined(repair(table(spark, rows), **options)).collect()
    want = {c: model([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert len(got) == len(want)
    assert {r.conv: tuple(r[c] for c in COLUMNS) for r in got} == want


def test_long_conversations_in_blocks_and_batches(spark):
    """The same result whatever the blocks and Arrow batches; the pieces hold whole texts."""
    rows = some_rows(6, 2, 400) + [(7, i, "system", f"only {i}.") for i in range(50)] + [(8, 0, "user", "a b. " * 300_000)]
    one = {r.conv: r for r in joined(repair(table(spark, rows))).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        many = {r.conv: r for r in joined(repair(table(spark, rows), block_rows=10)).collect()}
        pieces = repair(table(spark, rows), block_rows=10).where("conv = 1").orderBy("block").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert one == many
    assert len(pieces) > 10 and pieces[-1].blocks == len(pieces) and all(p.blocks is None for p in pieces[:-1])
    text = "\n".join(p.repaired for p in pieces if p.repaired)
    assert hashlib.sha256(text.encode()).hexdigest() == one[1].repaired_sha256 and "".join(p.audit for p in pieces) == one[1].audit
    assert one[7].cost == 50 and one[8].cost == 2


def test_dropped_rows_only_name_their_conversation(spark):
    rows = table(spark, [(1, 0, "user", "a."), (2, 0, "user", "a."), (2, 1, "assistant", "b.")])
    got = {r.conv: r for r in joined(repair(rows, dropped=F.col("conv_id") == 1)).collect()}
    assert tuple(got[1][c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert (got[2].cost, got[2].audit) == (0, "KK")


def test_nothing(spark):
    assert joined(repair(table(spark, []))).count() == 0 and damaged(table(spark, [])).count() == 0


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "a. b! c") for c in (None, *range(12)) for t in (None, *range(12))]
    want = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if k == 1 else "a b c" if k == 2 else x
        want += [(c, t, "user" if k == 4 else r, x, k == 0)] * (2 if k == 3 else 1)
    assert {k for *_, k in want} == {True, False}
    got = [tuple(r) for r in damaged(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_data_move_once(spark):
    """Counting repeats and sorting by turn need no exchange beside the dealing by conversation."""
    seen = []

    def keep(df, name):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    old, conversations.stored = conversations.stored, keep
    try:
        repair(table(spark, some_rows(1, 3, 3)))
    finally:
        conversations.stored = old
    assert seen[0].count("Exchange") == 1
