"""Document fingerprints as invertible Bloom lookup sketches, with built-in functions only.

A text's distinct paragraph digests (non-blank lines, and their sentences and clauses) are hashed into
three tables of cells; a cell keeps a count, the xor of its digests and the xor of their checksums.  Cells of two versions
subtract, and peeling recovers the digests that differ: a cell with one digest gives it up, which may
leave others with one.  What cannot be peeled is tried again with larger sketches.

Texts are shuffled once, to meet the next text in ranges of ids; their digests are written bucketed by range, and from
there cells are rows that stay where their range lies: counting, subtracting, peeling and retries are aggregates without
a shuffle, and what they found comes back as one narrow row a range.  Peeling goes through one of the three tables at a
time, so that no digest is given up twice.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.common import forget_at_exit, shared_dir
from .base import stored

#: Cells of each of the three tables at first, the factor of a retry, and the passes of peeling.
CELLS, GROWTH, PASSES = 16, 8, 9
KEY = ["range", "rid"]
#: Rows that share a range of ids, and ranges with exact bounds.
RANGE_ROWS, BOUNDS = 500, 256
_LEAST = -(2**63)


def with_next(docs: DataFrame, id_col: str, text_col: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``(range, rid, doc_id, text, next_text)`` in ascending order of id, null first, then text; the last row's next is the first.

    Ids are cut into ranges of about ``range_rows`` rows.  The first row of each range is also put at
    the end of the range before, so that no order over all rows is needed.  ``rid`` numbers the rows of a range.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(_LEAST))
    n, bounds = rows.select(key.alias("k")).agg(
        F.count(F.lit(1)), F.percentile_approx("k", [i / BOUNDS for i in range(BOUNDS)], 10_000)).first()
    bounds = sorted(set(bounds or [0]))
    parts = max(1, -(-n // (range_rows * len(bounds))))
    lows = F.array(*[F.lit(b).cast("long") for b in bounds])
    q = F.greatest(F.size(F.filter(lows, lambda b: b <= F.col("key"))) - 1, F.lit(0)).cast("long")
    low, high = F.get(lows, F.col("q").cast("int")).cast("double"), F.get(lows, (F.col("q") + 1).cast("int")).cast("double")
    inner = F.floor((F.col("key").cast("double") - low) / F.greatest(F.coalesce(high, low + 1) - low, F.lit(1.0)) * parts)
    sub = F.least(F.greatest(inner, F.lit(0)), F.lit(parts - 1))
    ranged = lambda df: df.withColumn("key", key).withColumn("q", q).withColumn("range", F.col("q") * parts + sub)

    heads = stored(ranged(rows.select("doc_id")).groupBy("q", "range").agg(F.min("key").alias("key")), "heads")
    ends = heads.groupBy("q").agg(F.max("range").alias("end"))  # at most BOUNDS rows
    ends = ends.select("q", F.lag("end").over(Window.orderBy("q")).alias("before"), F.max("end").over(Window.partitionBy()).alias("last"))
    inside = Window.partitionBy("q").orderBy("range")
    prior = heads.withColumn("prior", F.lag("range").over(inside)).join(F.broadcast(ends), "q")
    prior = stored(prior.select("key", F.coalesce("prior", "before", "last").alias("range")), "prior")
    firsts = (rows.withColumn("key", key).join(prior, "key").groupBy("range", "key")
              .agg(F.min(F.struct("doc_id", "text")).alias("r")))
    guests = firsts.select("range", "r.doc_id", "r.text", "key", F.lit(True).alias("guest"))
    own = ranged(rows).select("range", "doc_id", "text", "key", F.lit(False).alias("guest"))
    order = Window.partitionBy("range").orderBy("guest", "key", "text")
    led = own.unionByName(guests).withColumn("next_text", F.lead("text").over(order)).withColumn("rid", F.row_number().over(order))
    return led.where("not guest").select("range", "rid", "doc_id", "text", "next_text")


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder, bucketed by a key that it is already dealt by, and return the table."""
    spark = df.sparkSession
    path, table = shared_dir(spark, name), f"{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(table)
    forget_at_exit(spark, path)
    return spark.table(table)


def paragraphs(text: Column) -> Column:
    """Distinct digests of the non-blank lines and of their sentences and clauses, by one rule for texts of every length."""
    parts = F.concat(F.split(text, "\n"), F.split(text, r"\n|(?<=[.!?,;]) +"))
    return F.array_distinct(F.transform(F.filter(parts, lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def _cell(key: Column, table: int, size: int) -> Column:
    return (F.pmod(F.xxhash64(key, F.lit(table)), F.lit(size)) + table * size).cast("int")


def cells(digests: DataFrame, size: int, versions: int, keys: list[str] = KEY) -> DataFrame:
    """``(*keys, cell, c0, k0, h0, c1, ...)``: a cell of each of the versions ``v0, v1, ...``; rows without digests have empty cells."""
    def tag(i: int) -> Column:
        return F.transform(f"v{i}", lambda k: F.struct(F.lit(i).alias("v"), k.alias("k")))

    tagged = F.concat(*[tag(i) for i in range(versions)])
    rows = digests.select(*keys, F.explode_outer(tagged).alias("x")).select(*keys, "x.v", "x.k")
    at = F.array(*[_cell(F.col("k"), t, size) for t in range(3)])
    put = rows.select(*keys, "v", "k", _check(F.col("k")).alias("h"), F.explode(at).alias("cell"))
    sums = []
    for i in range(versions):
        mine = lambda x, i=i: F.when(F.col("v") == i, F.col(x))
        sums += [F.count(mine("k")).alias(f"c{i}"), F.coalesce(F.bit_xor(mine("k")), F.lit(0)).alias(f"k{i}"),
                 F.coalesce(F.bit_xor(mine("h")), F.lit(0)).alias(f"h{i}")]
    return put.groupBy(*keys, "cell").agg(*sums)


def peel(rows: DataFrame, size: int, passes: int = PASSES) -> DataFrame:
    """``(range, rid, pair, found, left)`` from differences ``(range, rid, pair, cell, c, k, h)``: digests recovered and cells not emptied."""
    rows = rows.withColumn("found", F.lit(0).cast("long"))
    fields = lambda cell, c, k, h, found: F.struct(
        cell.cast("int").alias("cell"), c.cast("long").alias("c"), k.alias("k"), h.alias("h"), found.cast("long").alias("found"))
    zero = F.lit(0).cast("long")
    for i in range(passes):
        table = i % 3
        mine = (F.col("cell") >= table * size) & (F.col("cell") < (table + 1) * size)
        pure = mine & (F.abs("c") == 1) & (F.col("h") == _check(F.col("k")))
        others = [fields(_cell(F.col("k"), t, size), -F.col("c"), F.col("k"), F.col("h"), zero) for t in range(3) if t != table]
        same = fields(F.col("cell"), F.col("c"), F.col("k"), F.col("h"), F.col("found"))
        done = fields(F.lit(-1), zero, zero, zero, F.col("found") + 1)
        out = rows.select(*KEY, "pair", F.explode(F.when(pure, F.array(done, *others)).otherwise(F.array(same))).alias("x"))
        rows = (out.groupBy(*KEY, "pair", F.col("x.cell").alias("cell"))
                .agg(F.sum("x.c").alias("c"), F.bit_xor("x.k").alias("k"), F.bit_xor("x.h").alias("h"), F.sum("x.found").alias("found"))
                .where("c <> 0 or k <> 0 or h <> 0 or found <> 0"))
    left = F.sum(F.when(F.col("cell") >= 0, 1).otherwise(0))
    return rows.groupBy(*KEY, "pair").agg(F.sum("found").alias("found"), left.alias("left"))


def by_range(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``(range, name)``: a map from ``rid`` to a value, so that a bucketed table takes it back without being moved."""
    return rows.groupBy("range").agg(F.map_from_entries(F.collect_list(F.struct(F.col("rid"), value))).alias(name))


def differing(digests: DataFrame, size: int = CELLS * GROWTH, growth: int = GROWTH, passes: int = PASSES) -> DataFrame:
    """``(range, rid, d1, d2)``: number of differing digests between ``v0`` and ``v1``, and ``v2``; rows without any are missing."""
    done, todo = [], digests
    while True:
        each = cells(todo, size, 3)
        both = F.array(*[F.struct(F.lit(i).alias("pair"), (F.col("c0") - F.col(f"c{i}")).alias("c"), F.col("k0").bitwiseXOR(F.col(f"k{i}")).alias("k"),
                                  F.col("h0").bitwiseXOR(F.col(f"h{i}")).alias("h")) for i in (1, 2)])
        rows = each.select(*KEY, "cell", F.explode(both).alias("x")).select(*KEY, "cell", "x.*").where("c <> 0 or k <> 0 or h <> 0")
        result = stored(peel(rows, size, passes), "peeled")
        done.append(result.where("left = 0").select(*KEY, "pair", "found"))
        failed = result.where("left > 0").select(*KEY).distinct()
        if failed.isEmpty():
            break
        again = stored(by_range(failed, F.lit(True), "failed"), "failed")
        todo, size = digests.join(again, "range").where(F.col("failed")[F.col("rid")]).drop("failed"), size * growth
    each = reduce(DataFrame.unionByName, done).groupBy(*KEY)
    return each.agg(*[F.max(F.when(F.col("pair") == i, F.col("found"))).alias(f"d{i}") for i in (1, 2)])


def sketches(digests: DataFrame, keys: list[str], versions: int = 2, size: int = CELLS) -> DataFrame:
    """``(*keys, f0, f1, ...)``: the sketch of each version as text, its cells in order."""
    rows = cells(digests, size, versions, keys)
    texts = [F.when(F.col(f"c{i}") > 0, F.concat_ws(":", F.hex("cell"), F.hex(f"c{i}"), F.lpad(F.hex(f"k{i}"), 16, "0"), F.lpad(F.hex(f"h{i}"), 16, "0")))
             for i in range(versions)]
    listed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("cell", *[t.alias(f"t{i}") for i, t in enumerate(texts)]))).alias("x"))
    return listed.select(*keys, *[F.array_join(F.col("x").getField(f"t{i}"), ",").alias(f"f{i}") for i in range(versions)])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = CELLS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for each row.

    The edited text has its last half of code points replaced by the first as many of the next text in
    the order of ids.  Likeness is shared over all distinct paragraphs, recovered from the sketches; two
    texts without paragraphs are alike, 1.0.  Null counts as empty.  Rows that repeat an id follow each
    other by text; a null id comes first.  Further columns are ignored.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_next(docs, id_col, text_col, range_rows).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    texts = ("text", "edited", "next_text")
    base = rows.select(*KEY, "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *[paragraphs(F.col(c)).alias(f"v{i}") for i, c in enumerate(texts)])
    base = bucketed(base, "range", "paragraphs")
    found = differing(base.select(*KEY, "v0", "v1", "v2"), size * GROWTH)
    found = stored(by_range(found, F.struct("d1", "d2"), "found"), "found")

    def near(i: int) -> Column:
        total, d = F.size("v0") + F.size(f"v{i}"), F.coalesce(F.col("found")[F.col("rid")][f"d{i}"], F.lit(0))
        return F.when(total == 0, 1.0).otherwise((total - d) / (total + d)).alias(f"near{i}")

    keys = [*KEY, "doc_id", "n_chars", "edited_sha256", "near1", "near2"]
    digests = base.join(found, "range", "left").select(*keys[:-2], near(1), near(2), "v0", "v1")
    return sketches(digests, keys, 2, size).select(
        "doc_id", "n_chars", "edited_sha256", F.col("f0").alias("fingerprint"), F.col("f1").alias("edited_fingerprint"),
        F.col("near1").alias("near_edited"), F.col("near2").alias("near_next"))
