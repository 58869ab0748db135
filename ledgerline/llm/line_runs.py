"""Line dedup: a suffix array over line ids, refined by distributed prefix doubling.

A run is a sequence of neighbouring lines of one document with at least ``min_words``
words. Of all places where the same run occurs, the first stays (by id, null first,
then text hash, then line); the lines of the later ones are deleted.

1. Every line gets an id from its text (two 64-bit hashes). Ids that occur once can't
   be part of a repeat; they cut documents into segments. Segments with fewer than
   ``min_words`` words can't hold a run.
2. Prefix doubling: the rank of a suffix by its first 2k lines comes from the sorted
   pairs (rank by k lines, rank by k lines k further on). Ranks are numbered in sort
   order; pairs that occur once leave the array. Doubling stops when the interval of
   every shortest run is known: no run needs to be told apart any deeper.
3. For each line the shortest runs that begin and that end there are taken. All suffixes
   that share such a run, an interval of the array whose longest common prefix is at
   least the run, have equal pairs (rank of its first 2^j lines, rank of its last 2^j
   lines). The first suffix of the interval is the original, the others are copies.
4. Shortest runs of copies that overlap or touch make up the maximal repeated run:
   a line lies in a repeated run of ``min_words`` words or more exactly if a shortest
   run that covers it is repeated.

Words are runs of ``[^\\x20\\x09-\\x0D]``; a line ends at ``\\n``. Null texts count as empty
and stay. Rows that repeat id and text are one document given more than once and share
its fate; rows that repeat an id with another text are apart. An empty table gives
an empty result. All steps are DataFrame operations.

The joins are merge joins at every size: what they hold grows with the corpus, and AQE can
split a hot line's partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, keyed

SPLIT = "\n"
WORD = "[^\\x20\\x09-\\x0D]+"


def _lines(rows: DataFrame) -> DataFrame:
    """(_id, _h, n, a, b, w): line number, line id, words of the line."""
    each = rows.select("_id", "_h", F.posexplode(F.split("_text", SPLIT, -1)).alias("n", "line"))
    return each.select(
        "_id", "_h", "n",
        F.xxhash64("line").alias("a"),
        F.xxhash64(F.lit(1), "line").alias("b"),
        F.regexp_count("line", F.lit(WORD)).alias("w"),
    )


def _ranked(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Ranks in sort order of the keys that occur more than once."""
    again = pairs.groupBy(*keys).count().filter("count > 1").drop("count")
    return again.sort(*keys).withColumn("rank", F.monotonically_increasing_id())


def _search(sums: Column, target: Column, steps: Column, strict: bool) -> Column:
    """Last index (from 0) whose prefix sum is below (or at) the target, by halving steps."""

    def ahead(at: Column, step: Column) -> Column:
        there = F.get(sums, at + step)
        fits = (there < target) if strict else (there <= target)
        return F.when(F.coalesce(fits, F.lit(False)), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), ahead)


def _shortest_runs(segments: DataFrame, min_words: int) -> DataFrame:
    """(_id, _h, s, m, runs): runs as (first line, lines), counted within the segment."""
    sums = segments.withColumn("steps", F.reverse(F.transform(F.sequence(F.lit(0), F.floor(F.log2("m")).cast("int")), lambda x: F.call_function("shiftleft", F.lit(1), x))))
    total = F.element_at("p", -1)
    begin = F.transform(
        F.filter(F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda i: F.struct(i.alias("i"), F.get("p", i).alias("v"))), lambda x: total - x["v"] >= min_words),
        lambda x: F.struct(x["i"].alias("i"), (_search(F.col("p"), x["v"] + min_words, F.col("steps"), True) + 1 - x["i"]).alias("l")),
    )
    end = F.transform(
        F.filter(F.transform(F.sequence(F.lit(1), F.col("m")), lambda e: F.struct(e.alias("e"), F.get("p", e).alias("v"))), lambda x: x["v"] - F.get("p", F.lit(0)) >= min_words),
        lambda x: F.struct(
            _search(F.col("p"), x["v"] - min_words, F.col("steps"), False).alias("i"),
            (x["e"] - _search(F.col("p"), x["v"] - min_words, F.col("steps"), False)).alias("l"),
        ),
    )
    return sums.withColumn("runs", F.array_distinct(F.concat(begin, end)))


def copied_runs(rows: DataFrame, scratch: Scratch, min_words: int = 50) -> DataFrame:
    """(_id, _h, first, last): maximal stretches of lines [first, last) that are later copies, from ``keyed`` rows."""
    lines = _lines(rows)
    names = scratch.save(_ranked(lines, ["a", "b"]), "names0")
    by_doc = Window.partitionBy("_id", "_h").orderBy("n")
    found = (
        lines.join(names.hint("merge"), ["a", "b"])
        .select("_id", "_h", "n", "w", F.col("rank").alias("r0"))
        .distinct()  # a document given twice
        .withColumn("g", F.col("n") - F.row_number().over(by_doc))
        .withColumn("c", F.sum("w").over(by_doc))
    )
    in_segment = Window.partitionBy("_id", "_h", "g")
    flat = found.withColumn("all", F.sum("w").over(in_segment)).filter(F.col("all") >= min_words)
    flat = scratch.save(flat.select("_id", "_h", "g", "n", "w", "c", "r0"), "flat0")

    segment = ["_id", "_h", "g"]
    packed = (
        flat.groupBy(*segment)
        .agg(F.sort_array(F.collect_list(F.struct("n", "c", "w"))).alias("x"))
        .select(
            *segment,
            F.col("x")[0]["n"].alias("s"),
            F.size("x").alias("m"),
            F.concat(F.array(F.col("x")[0]["c"] - F.col("x")[0]["w"]), F.col("x")["c"]).alias("p"),
        )
    )
    runs = _shortest_runs(packed, min_words).select(*segment, "s", "runs")
    runs = scratch.save(runs, "runs")
    longest = runs.select(F.array_max(F.transform("runs", lambda r: r["l"])).alias("l")).agg(F.max("l")).first()[0] or 0

    level = 0
    in_order = Window.partitionBy(*segment).orderBy("n")
    while 2 << level <= longest:
        a, b = F.col(f"r{level}"), F.lead(f"r{level}", 1 << level).over(in_order)
        # places without a pair get a number of their own below zero: they match nothing and lie spread out
        none = F.col("_b").isNull() | F.col("_a").isNull()
        paired = flat.withColumn("_a", a).withColumn("_b", b)
        apart = -1 - F.abs(F.xxhash64("_id", "_h", "n") % F.lit(1 << 62))
        pairs = paired.withColumn("_a", F.when(none, apart).otherwise(F.col("_a"))).withColumn("_b", F.when(none, F.lit(-1)).otherwise(F.col("_b")))
        level += 1
        names = scratch.save(_ranked(pairs.filter("_b >= 0"), ["_a", "_b"]), f"names{level}")
        joined = pairs.join(names.withColumnRenamed("rank", f"r{level}").hint("merge"), ["_a", "_b"], "left").drop("_a", "_b")
        flat = scratch.save(joined, f"flat{level}")
        scratch.drop(f"flat{level - 1}")
        scratch.drop(f"names{level}")

    ranks = [f"r{k}" for k in range(level + 1)]
    arrays = (
        flat.groupBy(*segment)
        .agg(F.sort_array(F.collect_list(F.struct("n", *ranks))).alias("x"))
        .alias("f")
        .join(runs.alias("u").hint("merge"), F.expr("f._id <=> u._id and f._h = u._h and f.g = u.g"))
        .select("u._id", "u._h", "s", "x", "runs")
    )

    def rank_at(i: Column, k: Column) -> Column:
        out = F.get("x", i)[ranks[-1]]
        for j in range(level - 1, -1, -1):
            out = F.when(k == j, F.get("x", i)[ranks[j]]).otherwise(out)
        return out

    def named(r: Column) -> Column:
        k = F.floor(F.log2(r["l"])).cast("int")
        width = F.call_function("shiftleft", F.lit(1), k)
        return F.struct(r["i"].alias("i"), r["l"].alias("l"), rank_at(r["i"], k).alias("a"), rank_at(r["i"] + r["l"] - width, k).alias("b"))

    places = arrays.select("_id", "_h", "s", F.explode(F.transform("runs", named)).alias("r")).select(
        "_id", "_h", (F.col("s") + F.col("r.i")).alias("n"), F.col("r.l").alias("l"), F.col("r.a").alias("a"), F.col("r.b").alias("b")
    )
    places = scratch.save(places.filter("a is not null and b is not null"), "places")
    place = F.struct(F.col("_id"), F.col("_h"), F.col("n"))
    first = places.groupBy("l", "a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n_places")).filter("n_places > 1")
    later = places.join(first.hint("merge"), ["l", "a", "b"]).filter(place > F.col("first")).select("_id", "_h", F.col("n").alias("first"), (F.col("n") + F.col("l")).alias("last"))
    # overlapping and touching runs become one
    before = Window.partitionBy("_id", "_h").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_id", "_h").orderBy("first", "last")
    begun = later.withColumn("new", (F.col("first") > F.coalesce(F.max("last").over(before), F.lit(-1))).cast("int"))
    return (
        begun.withColumn("run", F.sum("new").over(upto))
        .groupBy("_id", "_h", "run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .drop("run")
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """(_row, kept, n_lines, n_deleted): every input row as a struct, its text without copied lines, and the counts."""
    scratch = Scratch(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    runs = copied_runs(rows, scratch, min_words)
    per_doc = runs.groupBy("_id", "_h").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("cut"))
    per_doc = scratch.save(per_doc, "cut").select(F.col("_id").alias("c_id"), F.col("_h").alias("c_h"), "cut")
    joined = rows.join(per_doc.hint("merge"), rows["_id"].eqNullSafe(F.col("c_id")) & (rows["_h"] == F.col("c_h")), "left")
    lines = F.split("_text", SPLIT, -1)
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("cut")),
        lambda j: F.struct(
            F.when(j == 0, F.lit(0)).otherwise(F.get("cut", j - 1)["last"]).alias("from"),
            F.coalesce(F.get("cut", j)["first"], F.size("_lines")).alias("to"),
        ),
    )
    left = F.flatten(F.transform(gaps, lambda g: F.slice("_lines", g["from"] + 1, g["to"] - g["from"])))
    gone = F.aggregate("cut", F.lit(0), lambda acc, c: acc + c["last"] - c["first"])
    return joined.select("_row", "_text", lines.alias("_lines"), "cut").select(
        "_row",
        F.when(F.col("cut").isNull(), F.col("_text")).otherwise(F.array_join(left, SPLIT)).alias("kept"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_deleted"),
    )
