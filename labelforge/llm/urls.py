"""URL rules looked up in a Bloom filter cascade.

Every url has candidate keys: the suffixes of its host with the prefixes of its path that have the
length of a rule's path.  The first level of the cascade encodes the listed keys, with a
false-positive rate of about listed to all keys, so the false positives over the corpus's complete
set of keys number about the listed ones, whatever its size.  The next level encodes those false positives, the one
after it the listed keys that pass, and so on until a level lets nothing wrong through.  Over the
corpus the answer is then exact, and no table is joined.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stored
from .exact import LOWER, UPPER
from .words import mix

#: Levels after which two different keys with equal hashes are assumed.
MOST_LEVELS = 64


class Bloom:
    def __init__(self, keys: np.ndarray, rate: float, seed: int):
        """``keys``: rows of two 64-bit hashes; levels differ by ``seed``."""
        self.seed = np.uint64(seed)
        self.hashes = max(1, round(math.log2(1 / rate)))
        self.size = max(8, math.ceil(len(keys) * self.hashes / math.log(2)))
        self.bits = np.zeros(self.size, bool)
        self.bits[self._at(keys)] = True

    def _at(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = mix(keys[:, :1] + mix(keys[:, 1:] + self.seed) * np.arange(1, self.hashes + 1, dtype=np.uint64))
        return (x % np.uint64(self.size)).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        return self.bits[self._at(keys)].all(1)


class Cascade:
    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Level 0, 2, ... encode listed keys: the answer is the parity of the levels passed."""
        passed, left = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for i, level in enumerate(self.levels):
            left = left[level.has(keys[left])]
            passed[left] = i + 1
        return passed % 2 == 1


def _pairs(a: pa.Array, b: pa.Array) -> np.ndarray:
    return np.stack([x.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for x in (a, b)], 1)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit("second"))


def build(universe: DataFrame, listed: list[str]) -> Cascade:
    """Cascade that answers exactly for every ``key`` of ``universe``; ``listed`` is a list that fits the driver."""
    spark = universe.sparkSession
    rows = spark.createDataFrame([(x,) for x in sorted(set(listed))], "key string")
    own = rows.select(*_hashes(F.col("key"))).collect()
    own = np.array([tuple(r) for r in own], np.int64).reshape(-1, 2).view(np.uint64)
    others = stored(universe.join(rows, "key", "left_anti"), "keys")  # read twice
    n = max(1, others.count())
    first = Bloom(own, min(0.5, math.sqrt(0.5) * max(1, len(own)) / n), 0)
    passes = F.arrow_udf(lambda a, b: pa.array(first.has(_pairs(a, b))), "boolean")
    wrong = others.select(*_hashes(F.col("key"))).toDF("a", "b").where(passes("a", "b")).collect()
    wrong = np.array([tuple(r) for r in wrong], np.int64).reshape(-1, 2).view(np.uint64)
    levels, inside, outside = [first], own, wrong
    while len(outside):
        if len(levels) >= MOST_LEVELS:
            raise ValueError("a listed key and another key have the same hashes")
        level = Bloom(outside, 0.5, len(levels))
        levels.append(level)
        inside, outside = outside, inside[level.has(inside)]
    return Cascade(levels)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; empty without ``://`` or for null."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def candidates(host: Column, path: Column, lengths: list[int], labels: int) -> Column:
    """Keys that a rule for this host and path can have, the longest first, then the longer host.

    ``labels`` is the most that a rule's host has: longer suffixes of a host fit no rule, however many it has.
    """
    last = F.when(F.substring_index(host, ".", -labels) != "", F.split(F.substring_index(host, ".", -labels), "[.]", -1))
    names = F.transform(F.sequence(F.lit(1), F.size(last)), lambda i: F.array_join(F.slice(last, i, F.size(last)), "."))
    keys = F.flatten(F.transform(names, lambda h: F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: F.length(path) >= n),
        lambda n: F.struct((F.length(h) + n).alias("length"), F.length(h).alias("host"), F.concat(h, F.substring(path, F.lit(1), n)).alias("key")))))
    found = F.transform(F.sort_array(F.filter(keys, lambda k: k["host"] > 0), asc=False), lambda k: k["key"])
    return F.coalesce(found, F.array().cast("array<string>"))


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for each row.

    ``rules`` are ``(verdict, host, path)``.  A rule fits its host and all subdomains where the url's
    path starts with the rule's; the longest wins, then the one with the longer host.  Urls that no
    rule fits, such as null and empty ones, have a null rule and the verdict ``default``.  Repeated
    rows and null ids are judged like others; further columns are ignored.
    """
    verdicts = {host + path: verdict for verdict, host, path in rules}
    host, path = parts(F.col("url"))
    split = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    most = max((h.count(".") + 1 for _, h, _ in rules), default=1)
    keyed = split.withColumn("keys", candidates(F.col("host"), F.col("path"), sorted({len(p) for _, _, p in rules}), most))
    cascade = build(keyed.select(F.explode("keys").alias("key")).distinct(), list(verdicts))

    def first_listed(a: pa.Array, b: pa.Array) -> pa.Array:
        n = np.diff(a.offsets.to_numpy())
        listed = cascade.has(_pairs(a.flatten(), b.flatten()))
        owner = np.repeat(np.arange(len(n)), n)
        where = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        best = np.full(len(n), -1, np.int32)
        np.maximum.at(best, owner[listed], -1 - where[listed].astype(np.int32) + (1 << 30))
        return pa.array(np.where(best < 0, -1, (1 << 30) - 1 - best).astype(np.int32))

    pick = F.arrow_udf(first_listed, "int")
    found = keyed.withColumn("at", pick(F.transform("keys", lambda k: _hashes(k)[0]), F.transform("keys", lambda k: _hashes(k)[1])))
    rule = F.when(F.col("at") >= 0, F.get("keys", F.col("at")))
    by_rule = F.create_map(*[F.lit(x) for kv in verdicts.items() for x in kv])
    return found.withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", F.coalesce(F.element_at(by_rule, F.col("rule")), F.lit(default)).alias("verdict"))
