"""URL filters by a cascade of Bloom filters, in DataFrame functions only.

A rule is a host and a path prefix. The keys of a url are its host's label suffixes, each with each rule
path length's prefix of the url's path. Two cascades, one for the block rules and one for the allow rules,
answer which keys are listed. Level 0 of a cascade encodes the listed keys, level 1 those other keys of the
corpus that pass level 0, level 2 the listed keys that pass level 1, and so on until nothing passes: for
every key of the corpus the answer is then exact, and a url is judged with hashes and bit tests, no join.

Size: level 0 has a false-positive rate of about listed / other keys, so that level 1 is no larger than
level 0 and a cascade takes O(listed * log(other / listed)) bits; what is broadcast doesn't grow with the corpus but for
that logarithm. A level's bits are one literal of the plan, an array of 64-bit words. The key universe stays a table, which is
made distinct once; each level reads what the one before it has left. A list of more than max_listed rules is cut into
shards by a hash of the key: each shard has cascades of its own, which judge its keys in a pass over the urls.

Nulls and odd rows: a null url and one without :// have an empty host and path, fit no rule and get the
method's verdict, allow. Repeated rows give repeated results. Columns named like the results are replaced.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, removed, written


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_keys(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The keys that could be a rule: array<string>, longest first. Bounded by the rules' label counts and path lengths."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    keys = []
    for depth in sorted({r.host.count(".") + 1 for r in rules}):
        suffix = F.array_join(F.slice(labels, F.greatest(n - depth + 1, F.lit(1)), depth), ".")
        for length in sorted({len(r.path) for r in rules}):
            fits = (n >= depth) & (F.length(path) >= length)
            keys.append(F.when(fits, F.concat(suffix, F.substring(path, 1, length))))
    found = F.array_compact(F.array(*keys))
    longest = F.transform(found, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("k")))
    return F.transform(F.array_sort(longest), lambda s: s["k"])


def _positions(key: Column, level: int, k: int, m: int) -> list[Column]:
    """k bit positions in 0..m-1, from two halves of one hash."""
    h = F.xxhash64(key, F.lit(level))
    first, step = F.shiftrightunsigned(h, 33), h.bitwiseAND(F.lit((1 << 31) - 1)).bitwiseOR(F.lit(1).cast("bigint"))
    return [F.pmod(first + j * step, F.lit(m)) for j in range(k)]


@dataclass(frozen=True)
class Level:
    number: int
    k: int
    m: int
    words: str  # 64-bit words in decimal, joined by commas: one literal, which the optimizer turns into an array once

    def passes(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")
        out = F.lit(True)
        for p in _positions(key, self.number, self.k, self.m):
            word = F.get(words, F.shiftright(p, 6).cast("int"))
            out = out & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
        return out


def _level(keys: DataFrame, n: int, rate: float, number: int, max_bits: int) -> Level:
    k = max(1, round(-math.log2(rate)))
    m = 64 * math.ceil(max(64, 1.4427 * max(n, 1) * k) / 64)
    if m > max_bits:
        raise ValueError(f"a filter level needs {m} bits; max_bits is {max_bits}")
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), number, k, m))).alias("p"))
    bit = F.expr("shiftleft(1L, cast(pmod(p, 64) as int))")
    rows = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(bit).alias("b")).toPandas()  # at most m / 64 rows
    words = [0] * (m // 64)
    for w, b in zip(rows["w"].tolist(), rows["b"].tolist(), strict=True):
        words[w] = b
    return Level(number, k, m, ",".join(map(str, words)))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed; exact for those keys."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(~level.passes(key), F.lit(level.number % 2 == 1)).otherwise(out)
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, max_listed: int = 1_000_000, max_bits: int = 1 << 26) -> Cascade:
    """listed and universe have a string column key; universe may hold listed keys. Jobs: two or three a level."""
    listed = written(listed.select("key").distinct(), "url-listed")
    r = listed.count()
    if r > max_listed:
        raise ValueError(f"more than {max_listed} listed keys")
    if not r:
        return Cascade(())
    others = written(universe.select("key").distinct().join(F.broadcast(listed), "key", "left_anti"), "url-others")
    s = others.count()
    inside, outside, levels = listed, others, []
    rate = min(0.5, max(r, 1) * math.sqrt(0.5) / max(s, 1))
    n = r
    while n:
        level = _level(inside, n, rate, len(levels), max_bits)
        levels.append(level)
        passed = written(outside.filter(level.passes(F.col("key"))), "url-passed")
        removed(outside.sparkSession, outside)
        n, rate = passed.count(), 0.5
        inside, outside = passed, inside
        if len(levels) > 64:
            raise RuntimeError("the cascade doesn't end; are keys listed twice with different spelling?")
    removed(inside.sparkSession, inside)
    removed(outside.sparkSession, outside)
    return Cascade(tuple(levels))


def url_filter(pages: DataFrame, rules: list[Rule], url_col: str = "url", otherwise: str = "allow", max_listed: int = 1_000_000) -> DataFrame:
    """pages with host, path, rule (the longest that fits, else null) and verdict (block or allow)."""
    spark = pages.sparkSession
    pages = pages.drop("_verdicts", "_hit")
    split = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    keys = url_keys(F.col("host"), F.col("path"), rules)
    universe = written(split.select(F.explode(keys).alias("key")).distinct(), "url-keys")
    shards = max(1, math.ceil(len(rules) / max_listed))
    shard = lambda key: F.pmod(F.crc32(key.cast("binary")), F.lit(shards))
    for s in range(shards):
        cascades = {}
        for action in ("block", "allow"):
            mine = [(r.key,) for r in rules if r.action == action and zlib.crc32(r.key.encode()) % shards == s]
            there = universe if shards == 1 else universe.filter(shard(F.col("key")) == s)
            cascades[action] = build_cascade(spark.createDataFrame(mine, "key string"), there, max_listed=len(mine) or 1)
        verdict = lambda k: F.when(cascades["block"].listed(k), "block").when(cascades["allow"].listed(k), "allow")  # noqa: B023, E731
        if shards == 1:
            split = split.withColumn("_verdicts", F.transform(keys, verdict))
            break
        before = F.col("_verdicts") if s else F.array().cast("array<string>")
        judged = F.transform(keys, lambda k, i: F.when(shard(k) == s, verdict(k)).otherwise(F.get(before, i)))  # noqa: B023
        split = written(split.withColumn("_verdicts", judged), "url-judged")
    removed(spark, universe)
    hit = F.get(F.filter(F.zip_with(keys, "_verdicts", lambda k, v: F.struct(k.alias("key"), v.alias("verdict"))), lambda x: x["verdict"].isNotNull()), F.lit(0))
    return (
        split.withColumn("_hit", hit)
        .withColumns({"rule": F.col("_hit.key"), "verdict": F.coalesce(F.col("_hit.verdict"), F.lit(otherwise))})
        .drop("_hit", "_verdicts")
    )


#: The rules that the query of this operator applies.
RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]

ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
f AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM f
"""
