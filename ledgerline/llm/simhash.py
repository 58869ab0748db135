"""SimHash near-duplicates: bit-sliced comparison and connected components.

Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z; features are the
shingles of ``shingle`` words, repeats included (fewer words: the whole sequence).
A fingerprint bit is set if more than half of the shingles' XXH64 values have it.

Fingerprints within ``radius`` bits are found without comparing all pairs: the 64
bits are cut into ``blocks`` blocks, and two fingerprints that differ in at most
``radius`` bits agree on at least ``blocks - radius`` whole blocks. So each distinct
fingerprint goes to one bucket per choice of that many blocks, and is compared within
its buckets only. A bucket's fingerprints lie as vertical bit planes, 64 to a word; a
query is held against a whole word at a time, plane by plane, with carry-save counters,
and a word is abandoned once all its lanes are beyond the radius. Buckets above
``part_size`` are split in parts and every pair of parts is a task of its own. A
task passes on a spanning forest of its links, not all of them, so copies in their
thousands don't make millions of links; connectivity is the same.

Components come from alternating star contractions on written tables.

Null texts count as empty: their fingerprint is zero and links like any other. A row
with a null id is fingerprinted too; the component id is the smallest id that is not
null, or null if there is none. Repeated rows share their fingerprint. An empty table
gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, keyed, text_of

SEED = 42
PART_SIZE = 8192  # fingerprints of a bucket that one task holds
DOCS = 200  # texts that a task turns into strings at a time
PAIRS = 1 << 19  # (query, word) pairs compared at a time
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of one text as an unsigned number."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    n = len(words) - shingle + 1
    if n <= 1:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    elif shingle == 3:
        hashes = [xxh64_intdigest(b"%b %b %b" % w, SEED) for w in zip(words, words[1:], words[2:])]
    else:
        hashes = [xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(n)]
    total, counts = len(hashes), np.zeros(64, dtype=np.int64)
    h = np.array(hashes, dtype=np.uint64)
    for at in range(0, total, 1 << 16):
        counts += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(rows: DataFrame, text: str, shingle: int = 3) -> DataFrame:
    """``rows`` with the column ``fp`` (bigint, the same 64 bits) in place of the text column."""
    keep = [c for c in rows.columns if c != text]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                some = batch.slice(at, DOCS)
                fp = np.array([fingerprint(t, shingle) for t in some.column(text).to_pylist()], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in keep], pa.array(fp)], names=[*keep, "fp"])

    return rows.mapInArrow(run, f"{schema}, fp bigint")


def block_masks(radius: int, blocks: int) -> list[int]:
    """One mask per choice of ``blocks - radius`` of the blocks."""
    if not radius < blocks <= 64:
        raise ValueError("blocks must be more than radius and at most 64")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    own = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(own, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes (64, words): bit b of fingerprint i is bit i % 64 of plane b, word i // 64."""
    n = len(fps)
    padded = np.zeros(-(-max(n, 1) // 64) * 64, dtype=np.uint64)
    padded[:n] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def near(query: np.ndarray, word: np.ndarray, fps: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray:
    """For each (query, word) pair the lanes of the word within ``radius`` bits, as a mask.

    Counters are bit-sliced: one bit plane per binary digit and an overflow plane,
    started so that the overflow comes with difference radius + 1.
    """
    digits = max(radius.bit_length(), 1)
    start = (1 << digits) - 1 - radius
    n = len(query)
    out = np.zeros(n, dtype=np.uint64)
    live = np.arange(n)
    q, w = fps[query], word
    count = [np.full(n, FULL if start >> d & 1 else 0, dtype=np.uint64) for d in range(digits)]
    over = np.zeros(n, dtype=np.uint64)
    for b in range(64):
        # differences of this plane: the query's bit spread over the word
        carry = planes[b][w] ^ (np.uint64(0) - ((q >> np.uint64(b)) & np.uint64(1)))
        for d in range(digits):
            count[d], carry = count[d] ^ carry, count[d] & carry
        over |= carry
        if b % 8 == 7 and b < 63:
            on = over != FULL
            if not on.all():
                live, q, w, over = live[on], q[on], w[on], over[on]
                count = [c[on] for c in count]
                if not len(live):
                    return out
    out[live] = ~over
    return out


def links_of(fps: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) within the radius where j lies in [first[i], last[i])."""
    planes = planes_of(fps)
    has = np.nonzero(last > first)[0]
    lo, hi = first[has] // 64, (last[has] - 1) // 64 + 1
    size = hi - lo
    ends = np.cumsum(size)
    left, right = [], []
    at = 0
    while at < len(has):
        to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")), at + 1)
        query = np.repeat(has[at:to], size[at:to])
        begun = np.repeat(ends[at:to] - size[at:to], size[at:to])
        word = np.repeat(lo[at:to], size[at:to]) + (np.arange(len(query)) + (ends[at - 1] if at else 0) - begun)
        hit = near(query, word, fps, planes, radius)
        some = np.nonzero(hit)[0]
        if len(some):
            lanes = np.unpackbits(hit[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            which, lane = np.nonzero(lanes)
            i, j = query[some[which]], word[some[which]] * 64 + lane
            inside = (j >= first[i]) & (j < last[i])
            left.append(i[inside])
            right.append(j[inside])
        at = to
    if not left:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component; min labels run along links and then along themselves."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    return label


def _compare(radius: int):
    """Streams rows (table, bucket, a, b, side, fp) sorted by unit and side; keeps whole units together."""

    def unit_links(frame: pd.DataFrame) -> pd.DataFrame:
        cols = [frame[c].to_numpy() for c in ("t", "k", "a", "b")]
        change = np.zeros(len(frame), dtype=bool)
        change[:1] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        start = np.nonzero(change)[0]
        unit = np.cumsum(change) - 1
        end = np.append(start[1:], len(frame))[unit]
        side = frame["side"].to_numpy()
        # one part with itself: the lanes after the query; two parts: the second part's lanes for queries of the first
        one = cols[2] == cols[3]
        second = end - np.bincount(unit, weights=side)[unit].astype(np.int64)
        i = np.arange(len(frame))
        first = np.where(one, i + 1, second)
        last = np.where(one | (side == 0), end, first)
        fps = frame["fp"].to_numpy().view(np.uint64)
        left, right = links_of(fps, first, last, radius)
        label = forest(len(fps), left, right)
        child = np.nonzero(label != i)[0]
        return pd.DataFrame({"u": fps[child].view(np.int64), "v": fps[label[child]].view(np.int64)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            if not len(frame):
                continue
            if held:
                frame = pd.concat([*held, frame], ignore_index=True)
            key = frame[["t", "k", "a", "b"]].to_numpy()
            # the last unit may go on in the next frame
            other = np.nonzero((key != key[-1]).any(axis=1))[0]
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield unit_links(frame.iloc[:cut].reset_index(drop=True))
            held = [frame.iloc[cut:]]
        if held:
            yield unit_links(held[0].reset_index(drop=True))

    return run


def near_links(fps: DataFrame, radius: int = 3, blocks: int = 5, part_size: int = PART_SIZE) -> DataFrame:
    """(u, v): links between distinct fingerprints of column ``fp`` that span every group linked within ``radius``."""
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(radius, blocks)])
    rows = fps.select("fp", F.posexplode(masks).alias("t", "mask")).select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("k"), "fp")
    sizes = rows.groupBy("t", "k").count().filter("count > 1")
    parts = F.ceil(F.col("count") / part_size).cast("int")
    dealt = rows.join(sizes, ["t", "k"]).select(
        "t", "k", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("own")
    )
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.least(p, "own").alias("a"), F.greatest(p, "own").alias("b")),
    )
    units = dealt.select("t", "k", "fp", "own", F.explode(pairs).alias("p")).select(
        "t", "k", "p.a", "p.b", (F.col("own") != F.col("p.a")).cast("int").alias("side"), "fp"
    )
    # the same part on both sides is one list
    return (
        units.repartition("t", "k", "a", "b")
        .sortWithinPartitions("t", "k", "a", "b", "side")
        .mapInPandas(_compare(radius), "u bigint, v bigint")
        .distinct()
    )


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link. Alternating large and small stars."""
    edges = scratch.save(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges0")
    step = 0
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: greater neighbours of a node go to the least of its neighbours
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: lesser neighbours of a node, and itself, go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        found = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u != v").distinct()
        step += 1
        new = scratch.save(found, f"edges{step}")
        # done when all edges are stars: no node is both above one and below another, and none has two roots
        again = new.groupBy("u").count().filter("count > 1").select("u").union(new.select("u").join(new.select(F.col("v").alias("u")).distinct(), "u", "left_semi"))
        done = again.limit(1).count() == 0
        scratch.drop(f"edges{step - 1}")
        edges = new
        if done:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _with_roots(marks: DataFrame, scratch: Scratch, radius: int, blocks: int, part_size: int) -> DataFrame:
    """``marks`` (with fp) and the root fingerprint of each."""
    distinct = scratch.save(marks.groupBy("fp").agg(F.count("*").alias("n")), "fps")
    roots = components(near_links(distinct, radius, blocks, part_size), scratch)
    return marks.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    radius: int = 3,
    blocks: int = 5,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document."""
    scratch = Scratch(docs.sparkSession)
    need = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    marks = scratch.save(fingerprints(need, "text", shingle), "marks")
    rooted = _with_roots(marks, scratch, radius, blocks, part_size)
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(ids, "root").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, blocks: int = 5, part_size: int = PART_SIZE
) -> DataFrame:
    """The input with one document of each component: that with the smallest id (null last), then text hash."""
    scratch = Scratch(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    marks = scratch.save(fingerprints(rows.select("_id", "_h", "_text"), "_text", shingle), "marks")
    rooted = _with_roots(marks, scratch, radius, blocks, part_size)
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_h"))).alias("w"))
    winners = first.select(F.col("w._id").alias("w_id"), F.col("w._h").alias("w_h"))
    kept = rows.join(winners, rows["_id"].eqNullSafe(F.col("w_id")) & (rows["_h"] == F.col("w_h")), "left_semi")
    # the same document given more than once stays once; a number per task settles which, before anything is moved again
    return _once(kept, scratch)


def _once(kept: DataFrame, scratch: Scratch) -> DataFrame:
    from pyspark.sql import Window

    by_doc = Window.partitionBy("_id", "_h").orderBy(F.xxhash64("_row"))
    return kept.withColumn("_n", F.row_number().over(by_doc)).filter("_n = 1").select("_row.*")
