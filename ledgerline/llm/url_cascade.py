"""URL filter: exact membership in lists of hosts and paths by cascades of Bloom filters.

Level 1 encodes the listed keys. Level 2 encodes those unlisted keys of the corpus that
pass level 1 by mistake, level 3 the listed keys that pass level 2, and so on until
nothing passes by mistake. The corpus's keys are all there is to ask, so the answer is
exact: a key is listed if the first level that refuses it is an even one. Urls are
judged by probing bits; no join takes part.

A filter is a literal of at most ``max_bytes``. Lists that need more are split by a hash
of the key into parts with a cascade each. Urls are then judged in one pass per part, so
that a task never holds more than the filters of one part (rules, which come as a list
of the driver, keep all their parts in one expression).

A rule is a host and a path prefix; it fits its host and all subdomains. Of the rules
that fit the longest wins. Without one, the list of hosts decides: listed hosts are
blocked. Null urls and urls without ``://`` have empty host and path and fit nothing.
Rows are judged one by one, repeated ones alike; an empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import bloom
from ledgerline.llm.bloom import Bloom
from ledgerline.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    whole = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(whole, "://")
    tail = F.when(at > 0, F.substr(whole, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(tail, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(tail, "^[^/?#]*([^?#]*)", 1)


@dataclass
class Cascade:
    levels: list[Bloom]

    def has(self, key: Column) -> Column:
        """Whether a key of the corpus is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for n in range(len(self.levels) - 1, -1, -1):
            out = F.when(~self.levels[n].passes(key), F.lit(n % 2 == 1)).otherwise(out)
        return out


@dataclass
class Cascades:
    """A cascade for each part of the keys; a key's hash names its part."""

    parts: list[Cascade]

    def part(self, key: Column) -> Column:
        return _part(key, len(self.parts))

    def has(self, key: Column) -> Column:
        """Whether a key of the corpus is listed, with the filters of all parts in one expression."""
        out = self.parts[-1].has(key)
        for n in range(len(self.parts) - 2, -1, -1):
            out = F.when(self.part(key) == n, self.parts[n].has(key)).otherwise(out)
        return out


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(parts))


def cascades(listed: DataFrame, universe: DataFrame, scratch: Scratch, name: str, max_bytes: int = bloom.MAX_BYTES) -> Cascades:
    """Cascades for ``listed`` (key) over ``universe`` (key), which need not hold the listed keys.

    There are as many parts as keep every level within ``max_bytes``: the first level holds
    the listed keys of its part, the second up to a fiftieth of the other keys.
    """
    marked = listed.select("key", F.lit(True).alias("on")).union(universe.select("key", F.lit(False).alias("on")))
    keys = scratch.save(marked.filter("key is not null").groupBy("key").agg(F.max("on").alias("on")), f"{name}-keys")
    counts = {r["on"]: r["count"] for r in keys.groupBy("on").count().collect()}
    most = max(counts.get(True, 0), counts.get(False, 0) // 50)
    parts = max(1, -(-most * bloom.BITS_PER_KEY // (max_bytes * 8)))
    made = []
    for n in range(parts):
        own = keys.filter(_part(F.col("key"), parts) == n) if parts > 1 else keys
        made.append(_cascade(own, scratch, f"{name}-{n}", max_bytes))
    return Cascades(made)


def _cascade(keys: DataFrame, scratch: Scratch, name: str, max_bytes: int) -> Cascade:
    inside, outside = keys.filter("on"), keys.filter(~F.col("on"))
    levels: list[Bloom] = []
    n = inside.count()
    while n:
        level = bloom.build(inside, n, len(levels) + 1, max_bytes)
        levels.append(level)
        # those of the other side that pass by mistake are what the next level encodes
        wrong = scratch.save(outside.filter(level.passes(F.col("key"))), f"{name}-{len(levels)}")
        inside, outside = wrong, inside
        n = inside.count()
    return Cascade(levels)


def mirrors(pages: DataFrame, min_hosts: int = 4, one_in: int = 3, url: str = "url", html: str = "html") -> DataFrame:
    """(key): hosts of whose pages at least one in ``one_in`` bears a title that ``min_hosts`` hosts bear.

    Counts of a host's equal titles shuffle, not pages. Empty and missing titles are nobody's.
    """
    title = F.regexp_extract(F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")), "<title>([^<]*)</title>", 1)
    cells = pages.select(split_url(F.col(f"`{url}`"))[0].alias("key"), title.alias("title")).filter("key != ''").groupBy("key", "title").count()
    spread = cells.filter("title != ''").groupBy("title").agg(F.count("*").alias("hosts")).filter(F.col("hosts") >= min_hosts).select("title", "hosts")
    shares = cells.join(spread, "title", "left").groupBy("key").agg(
        F.sum(F.when(F.col("hosts").isNotNull(), F.col("count")).otherwise(0)).alias("shared"), F.sum("count").alias("n")
    )
    return shares.filter(F.col("shared") * one_in >= F.col("n")).select("key")


def _candidates(host: str, path: str, lengths: list[int]) -> Column:
    """Every host suffix at a dot with every prefix of the path that has a rule's length, as (length, key)."""
    labels = F.split(host, "\\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substr(F.col(path), F.lit(1), F.lit(n))) for n in lengths])
    return F.when(
        F.col(host) != "",
        F.flatten(F.transform(suffixes, lambda s: F.transform(F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.concat(s, p)))),
    ).otherwise(F.array().cast("array<string>"))


def _named(keys: Column, verdict: Column) -> Column:
    return F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"), verdict.alias("verdict")))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    listed_hosts: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    max_bytes: int = bloom.MAX_BYTES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict).

    ``rules`` are (verdict, host, path) with verdict block or allow and a path that starts
    with ``/``; ``listed_hosts`` has a column key.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    if any(v not in ("block", "allow") or not p.startswith("/") for v, _, p in rules):
        raise ValueError("a rule is (block or allow, host, path from /)")
    host, path = split_url(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), host.alias("host"), path.alias("path"))
    lengths = sorted({len(p) for _, _, p in rules})
    rows = rows.withColumn("keys", _candidates("host", "path", lengths) if lengths else F.array().cast("array<string>"))
    universe = rows.select(F.explode("keys").alias("key")).distinct()
    options = []
    for verdict in ("block", "allow"):
        own = sorted({h + p for v, h, p in rules if v == verdict})
        if not own:
            continue
        keys = spark.createDataFrame([(k,) for k in own], "key string")
        made = cascades(keys, universe, scratch, verdict, max_bytes)
        options.append(_named(F.filter("keys", made.has), F.lit(verdict)))
    fits = F.array_max(F.concat(*options)) if options else F.lit(None).cast("struct<n: int, rule: string, verdict: string>")
    out = rows.withColumn("fit", fits)
    result = ["page_id", "host", "path", F.col("fit.rule").alias("rule")]
    if listed_hosts is None:
        return out.select(*result, F.coalesce("fit.verdict", F.lit("allow")).alias("verdict"))
    hosts = cascades(listed_hosts, rows.filter("host != ''").select(F.col("host").alias("key")), scratch, "hosts", max_bytes)
    passes = []
    for n, one in enumerate(hosts.parts):
        mine = out.filter(hosts.part(F.col("host")) == n) if len(hosts.parts) > 1 else out
        bad = one.has(F.col("host")) & (F.col("host") != "")
        passes.append(mine.select(*result, F.coalesce("fit.verdict", F.when(bad, "block").otherwise("allow")).alias("verdict")))
    return reduce(DataFrame.unionByName, passes)
