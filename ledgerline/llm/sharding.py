"""Sharding: groups of equal texts in corpus order, cut into contiguous shards whose largest is as small as possible.

A group is all documents of one text (by SHA-256; a null text is an empty one) and goes to
one shard whole. Groups stand in the order of their smallest id (nulls first), then digest.
A document's size is the UTF-8 bytes of its text plus 1.

The smallest feasible capacity is found by binary search between the larger of the fair
share and the largest group, and their sum. A capacity is feasible if greedy cuts, each
at the last group end within it, reach the end in as many shards as there are. The cuts
keep that capacity; among cuts that do, a shard takes no more than the fair share of
what is left, but at least one group and so much that the rest can be cut within the capacity.

The search needs only group ends, which are prefix sums over range-partitioned groups. The
driver holds at most a few thousand spans of ends: least and greatest end of each. Greedy
steps run on them with a lower and an upper position; where the two disagree on the answer,
the spans that were hit are split by one job that reads them alone. So the driver's memory
doesn't grow with the number of groups, and a level of refinement reads a small part of them.

Rows are numbered in shard order by a range partition over (shard, group, id): a text that a
third of all documents share is spread over tasks. Row counts of partitions, at most one
per partition and shard, give each partition its first slot.

Null ids come first in their group. Repeated rows each keep a slot of their own. Empty
texts have size 1. Columns are carried in ``_row``, so no name can clash. An empty table
gives an empty result. Shards stay empty only if there are fewer groups than shards.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, text_of

CELLS = 4096  # spans that one job reports
TABLE = "part int, before long"


def ranged(df: DataFrame, *order) -> DataFrame:
    """Rows range-partitioned and sorted; ``_at`` grows in that order, by one within a partition (``part``)."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return out.withColumn("part", F.shiftright("_at", 33).cast("int"))


class Ends:
    """All group ends as spans (least, greatest, how many), in order; a span of one or two ends is known exactly."""

    def __init__(self, spark: SparkSession, line: DataFrame, before: dict[int, int], total: int):
        self.spark, self.line, self.total = spark, line, total
        self.before = before
        self.spans = [(0, 0, 1)]
        self._split([(1, total, 3)])

    def _split(self, spans: list[tuple[int, int, int]]) -> None:
        """Replaces spans by finer ones; one job reads the rows of these spans alone."""
        cells = max(2, CELLS // len(spans))
        parts = sorted(self.before)
        pieces = []
        for n, (lo, hi, _) in enumerate(spans):
            width = -(-(hi - lo + 1) // cells)
            for i, p in enumerate(parts):
                first, last = self.before[p], self.before[parts[i + 1]] if i + 1 < len(parts) else self.total
                if first < hi and last >= lo:
                    pieces.append((n, lo, width, p, max(lo, first + 1) - first, min(hi, last) - first, first))
        # at most one piece per span and partition it meets; spans don't overlap, so few more pieces than partitions
        wanted = F.broadcast(self.spark.createDataFrame(pieces, "n int, lo long, width long, part int, a long, b long, before long"))
        least, most = min(p[4] for p in pieces), max(p[5] for p in pieces)
        own = self.line.filter(F.col("part").isin(sorted({p[3] for p in pieces})) & F.col("upto").between(least, most)) if len(pieces) <= 64 else self.line
        end = F.col("before") + F.col("upto")
        found = (
            own.join(wanted, "part")
            .filter("upto between a and b")
            .groupBy("n", F.expr("(before + upto - lo) div width").alias("cell"))
            .agg(F.min(end).alias("lo"), F.max(end).alias("hi"), F.count("*").alias("ends"))
        )
        finer = [(r.lo, r.hi, r.ends) for r in found.collect()]
        gone = set(spans)
        self.spans = sorted([s for s in self.spans if s not in gone] + finer)
        self.lows = [s[0] for s in self.spans]
        self.highs = [s[1] for s in self.spans]

    def last_upto(self, place: int):
        """(least, greatest possible) last end at or before the place, and the span that leaves it open."""
        lo, hi, n = span = self.spans[bisect_right(self.lows, place) - 1]
        if hi <= place:
            return hi, hi, None
        return (lo, lo, None) if n <= 2 else (lo, place, span)

    def first_from(self, place: int) -> int:
        """The first end at or after the place."""
        while True:
            lo, hi, n = span = self.spans[bisect_left(self.highs, place)]
            if lo >= place:
                return lo
            if n <= 2:
                return hi
            self._split([span])

    def exact(self, place: int) -> int:
        while True:
            lo, _, span = self.last_upto(place)
            if span is None:
                return lo
            self._split([span])

    def fits(self, capacity: int, shards: int) -> bool:
        """Whether greedy cuts within the capacity need no more than so many shards."""
        while True:
            low = high = 0
            unsure = set()
            for _ in range(shards):
                low, _, a = self.last_upto(low + capacity)
                _, high, b = self.last_upto(high + capacity)
                unsure |= {a, b} - {None}
            if low >= self.total:
                return True
            if high < self.total:
                return False
            self._split(sorted(unsure))

    def cuts(self, shards: int, largest: int) -> list[int]:
        """The ends after which shards 0 to shards - 2 are cut."""
        fair = -(-self.total // shards)
        lo, hi = max(fair, largest), fair + largest
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.fits(mid, shards) else (mid + 1, hi)
        earliest = [self.total]
        for _ in range(shards - 1):
            earliest.append(self.first_from(max(0, earliest[-1] - lo)))
        at, out = 0, []
        for left in range(shards, 1, -1):
            some = self.first_from(min(at + 1, self.total))  # at least one group a shard, while there are any
            at = max(earliest[left - 1], some, self.exact(at + min(lo, -(-(self.total - at) // left))))
            out.append(at)
        return out


def _first(counts: list[tuple[int, int]]) -> dict[int, int]:
    """Partition -> what lies before it."""
    before, out = 0, {}
    for part, n in sorted(counts):
        out[part] = before
        before += n
    return out


def assign(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(_row, size, text_crc32, shard, slot) of every document; slots count from 0 in each shard.

    ``_row`` holds the columns named by ``keep``, or all. The number of shards is a small literal.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    whole = text_of(text)
    rows = scratch.save(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("_row"),
            F.col(f"`{doc_id}`").alias("_id"),
            F.unhex(F.sha2(whole.cast("binary"), 256)).alias("_digest"),
            (F.octet_length(whole).cast("long") + 1).alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
        ),
        "rows",
    )
    some = rows.groupBy("_digest").agg(F.min("_id").alias("first"), F.sum("size").alias("bytes"), F.bool_or(F.col("_id").isNull()).alias("nameless"))
    groups = scratch.save(some, "groups")
    ordered = ranged(groups, F.desc("nameless"), "first", "_digest")
    upto = F.sum("bytes").over(Window.partitionBy("part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    line = scratch.save(ordered.select("_digest", "part", "bytes", upto.alias("upto")), "line")
    parts = line.groupBy("part").agg(F.sum("bytes").alias("n"), F.max("bytes").alias("largest")).collect()  # one row per partition
    if not parts:
        return rows.select("_row", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    before = _first([(r.part, r.n) for r in parts])
    cuts = Ends(spark, line, before, sum(r.n for r in parts)).cuts(shards, max(r.largest for r in parts))
    offsets = F.broadcast(spark.createDataFrame(list(before.items()), TABLE))  # one row per partition
    end = F.col("upto") + F.col("before")
    shard = sum([(end > c).cast("int") for c in cuts], F.lit(0))
    owner = line.join(offsets, "part").select("_digest", end.alias("_end"), shard.alias("shard"))
    placed = scratch.save(rows.join(owner, "_digest"), "placed")
    placed = scratch.save(ranged(placed, "shard", "_end", "_id").drop("_digest", "_end", "_id"), "numbered")
    pieces = placed.groupBy("part", "shard").agg(F.count("*").alias("n"), F.min("_at").alias("at"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(pieces.select("part", "shard", (earlier - F.col("at")).alias("shift")))  # at most partitions + shards rows
    return placed.join(starts, ["part", "shard"]).select("_row", "size", "text_crc32", "shard", (F.col("_at") + F.col("shift")).alias("slot"))


def write(docs: DataFrame, path: str, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes every column of the documents under ``path/shard=N``, a shard's files in the order of their slots.

    The texts are written twice on the way, as the numbering needs two range partitions.
    """
    out = assign(docs, shards, doc_id, text)
    flat = out.select("shard", "slot", F.col("_row").alias("document"))
    flat.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
