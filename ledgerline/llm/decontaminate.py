"""Benchmark decontamination: SimHash of item-sized windows, multi-index blocks, exact check.

Words are lower-cased runs of letters and digits, so case and punctuation don't hide a
passage. A window has as many words as the benchmark item (a shorter document is one
window). Its similarity to the item is the weighted Jaccard of their shingles of
``SHINGLE`` words, the weight of a shingle being how often it occurs; below ``SHINGLE``
words the whole sequence is the only shingle. An item is found in a document if a
window reaches ``min_similarity``.

Windows without a shingle of any item have similarity 0; only the places around shared
shingles are looked at, at every word. There each window gets a 64-bit SimHash of its
shingles. The bits are cut in ``BLOCKS`` blocks; fingerprints within ``radius`` bits
differ in at most ``radius // BLOCKS`` bits of some block, so a table of each block's
values to that distance yields every item within the radius. Those candidates are
checked exactly.

The radius covers a window and an item by their weights: what they must have in common for
the similarity s, s (a + b) / (1 + s) of a and b shingles, over the product of their norms is a
lower bound of their cosine, and so of the bits that they differ in (64 angle / pi, give or
take). Where ``SPREAD`` standard deviations more still lie within the radius, the blocks alone
name the candidates: at similarity 0.8 and with shingles that don't repeat, a window is missed
with probability 1e-5. Repeated shingles make the norms large and the bound weak: windows
beyond it are also checked, at any distance, against items that enough of their shingles occur in.

The benchmark goes to the tasks in passes of at most ``pass_bytes`` of text, so what is
sent never grows with it; every pass reads all documents.

Null or wordless items match nothing; null texts count as empty. Repeated items and rows
each give their own rows. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_of

SHINGLE = 5
BLOCKS = 6
RADIUS = 22
SPREAD = 4.2
DOCS = 200  # documents whose words are hashed together
TABLE_BITS = 22
FOUND = "item_id bigint, similarity double, distance int, first_word int, n_words int"
WORDS = re.compile(r"[^\W_]+").findall


def words_of(text: str) -> list[str]:
    return WORDS(text.lower())


def _grams(words: list[str], k: int) -> list[str]:
    return [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]


def _signs(grams: list[str]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    h = np.array([xxh64_intdigest(g) for g in grams], dtype=np.uint64)
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.packbits(sums > 0, axis=1, bitorder="little")).view(np.uint64).ravel()


class Index:
    """Fingerprints by blocks: for every block value the members within ``radius // BLOCKS`` bits."""

    def __init__(self, fps: np.ndarray, radius: int):
        self.fps, self.radius = fps, radius
        edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
        self.blocks = []
        for a, b in zip(edges, edges[1:]):
            near = [sum(1 << i for i in c) for r in range(radius // BLOCKS + 1) for c in combinations(range(b - a), r)]
            own = (fps >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
            value = (own[:, None] ^ np.array(near, dtype=np.uint64)[None, :]).ravel().astype(np.int64)
            member = np.repeat(np.arange(len(fps), dtype=np.int32), len(near))
            order = np.argsort(value, kind="stable")
            start = np.searchsorted(value[order], np.arange((1 << (b - a)) + 1))
            self.blocks.append((a, (1 << (b - a)) - 1, start, member[order]))

    def within(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, member, distance) of all pairs within the radius."""
        found = []
        for a, mask, start, member in self.blocks:
            v = ((query >> np.uint64(a)) & np.uint64(mask)).astype(np.int64)
            size = start[v + 1] - start[v]
            q = np.repeat(np.arange(len(query)), size)
            inner = np.arange(len(q)) - np.repeat(np.cumsum(size) - size, size)
            found.append(q * len(self.fps) + member[np.repeat(start[v], size) + inner])
        pair = np.unique(np.concatenate(found))
        q, m = np.divmod(pair, max(len(self.fps), 1))
        d = np.bitwise_count(query[q] ^ self.fps[m])
        on = d <= self.radius
        return q[on], m[on], d[on]


def least_cosine(radius: int) -> float:
    """Least cosine whose fingerprints differ in at most ``radius`` bits, ``SPREAD`` standard deviations included."""
    share = np.linspace(0, 0.5, 10_001)
    fits = 64 * share + SPREAD * np.sqrt(64 * share * (1 - share)) <= radius
    return float(np.cos(np.pi * share[fits].max()))


class Finder:
    """The items of one pass, ready to be looked for."""

    def __init__(self, items: list[tuple[int | None, str]], min_similarity: float, radius: int):
        self.least = min_similarity
        self.cosine = least_cosine(radius)
        self.ids = []
        self.counts: list[Counter] = []
        self.fps: list[np.uint64] = []
        self.owners: dict[tuple[int, int], dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        by_size: dict[tuple[int, int], list[int]] = defaultdict(list)
        shared: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            k = min(SHINGLE, len(words))
            grams = _grams(words, k)
            n = len(self.ids)
            self.ids.append(item_id)
            self.counts.append(Counter(grams))
            self.fps.append(_pack(_signs(grams).sum(axis=0, keepdims=True))[0])
            by_size[len(words), k].append(n)
            for h in set(self._hashes(words, k).tolist()):
                shared[k][h].add(len(words))
                self.owners[len(words), k][h].append(n)
        self.sizes = {s: (np.array(own), Index(np.array([self.fps[i] for i in own], dtype=np.uint64), radius)) for s, own in by_size.items()}
        self.norms = {s: max(sum(c * c for c in self.counts[i].values()) for i in own) ** 0.5 for s, own in by_size.items()}
        self.shared = {}
        for k, sizes in shared.items():
            table = np.zeros(1 << TABLE_BITS, dtype=bool)
            table[np.array(list(sizes), dtype=np.uint64) >> np.uint64(64 - TABLE_BITS)] = True
            self.shared[k] = (table, dict(sizes))

    @staticmethod
    def _hashes(words: list[str], k: int, each: np.ndarray | None = None) -> np.ndarray:
        if each is None:
            each = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
        n = max(len(each) - k + 1, 0)
        out = np.zeros(n, dtype=np.uint64)
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
            out ^= out >> np.uint64(29)
        return out * np.uint64(0xBF58476D1CE4E5B9)

    def find_all(self, texts: list[str]) -> list[list[tuple]]:
        """For every text (item number, similarity, distance, first word, words), the best window of each item."""
        cut = [words_of(t) for t in texts]
        size = np.array([len(w) for w in cut])
        start = np.cumsum(size) - size
        flat = [w for words in cut for w in words]
        each = np.fromiter(map(hash, flat), dtype=np.int64, count=len(flat)).view(np.uint64)
        at: dict[int, dict[tuple[int, int], list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for k, (table, sizes) in self.shared.items():
            h = self._hashes(flat, k, each)
            for p in np.nonzero(table[h >> np.uint64(64 - TABLE_BITS)])[0].tolist():
                lengths = sizes.get(int(h[p]))
                if lengths:
                    doc = int(np.searchsorted(start, p, "right")) - 1
                    if p + k <= start[doc] + size[doc]:
                        for n in lengths:
                            at[doc][n, k].append((p - int(start[doc]), int(h[p])))
        return [self._windows(cut[d], at[d]) if d in at else [] for d in range(len(texts))]

    def _windows(self, words: list[str], places: dict[tuple[int, int], list[tuple[int, int]]]) -> list[tuple]:
        best: dict[int, tuple] = {}
        for (n, k), hits in places.items():
            length = min(n, len(words))
            last = len(words) - length  # the last start
            edge = np.zeros(last + 2, dtype=np.int32)
            p = np.array([at for at, _ in hits])
            per = length - k + 1
            least_common = self.least * (per + n - k + 1) / (1 + self.least) - 1e-9
            np.add.at(edge, np.clip(p + k - length, 0, last), 1)
            np.add.at(edge, np.clip(p, 0, last) + 1, -1)
            starts = np.nonzero(np.cumsum(edge)[:-1] > 0)[0]
            if not len(starts):
                continue
            for group in np.split(starts, np.nonzero(np.diff(starts) > 1)[0] + 1):
                own = words[group[0] : group[-1] + length]
                grams = _grams(own, k)
                upto = np.vstack([np.zeros((1, 64), dtype=np.int32), np.cumsum(_signs(grams), axis=0, dtype=np.int32)])
                first = group - group[0]
                members, index = self.sizes[n, k]
                fps = _pack(upto[first + per] - upto[first])
                q, m, d = index.within(fps)
                pairs = dict(zip(zip(q.tolist(), members[m].tolist()), d.tolist()))
                # windows whose weights leave the bits open
                wide = least_common < self.cosine * self.norms[n, k] * self._norms(grams, first, per)
                a, b = np.searchsorted(p, group), np.searchsorted(p, group + per)
                for i in np.nonzero(wide & (b - a >= least_common))[0].tolist():
                    common = Counter(j for _, h in hits[a[i] : b[i]] for j in self.owners[n, k][h])
                    pairs |= {(i, j): int(np.bitwise_count(fps[i] ^ self.fps[j])) for j, c in common.items() if c >= least_common}
                for (i, j), dist in pairs.items():
                    i = int(first[i])
                    both = self._similar(grams[i : i + per], self.counts[j])
                    if both >= self.least:
                        mark = (-both, dist, int(group[0]) + i)
                        if j not in best or mark < best[j][0]:
                            best[j] = (mark, (j, both, dist, int(group[0]) + i, length))
        return [best[j][1] for j in sorted(best)]

    @staticmethod
    def _norms(grams: list[str], first: np.ndarray, per: int) -> np.ndarray:
        """Norms of the windows' shingle weights; the windows follow one another."""
        if len(set(grams)) == len(grams):
            return np.full(len(first), per**0.5)
        held = Counter(grams[first[0] : first[0] + per])
        square = sum(c * c for c in held.values())
        out = [square]
        for i in first[1:].tolist():
            gone, new = grams[i - 1], grams[i + per - 1]
            square -= 2 * held[gone] - 1
            held[gone] -= 1
            square += 2 * held[new] + 1
            held[new] += 1
            out.append(square)
        return np.sqrt(out)

    @staticmethod
    def _similar(grams: list[str], item: Counter) -> float:
        own = Counter(g for g in grams if g in item)
        common = sum(min(c, item[g]) for g, c in own.items())
        return common / (len(grams) + item.total() - common)


def _passes(benchmark: DataFrame, item_id: str, text: str, pass_bytes: int) -> Iterator[list[tuple]]:
    """The items in parts of about ``pass_bytes`` of text; a part is all that the driver holds."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("id"), text_of(text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // pass_bytes)
    part = F.pmod(F.xxhash64("id", "text"), F.lit(max(parts, 1)))
    for p in range(parts):
        yield [tuple(r) for r in items.filter(part == p).orderBy("id", "text").collect()]


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_similarity: float = 0.8,
    radius: int = RADIUS,
    pass_bytes: int = 8 << 20,
) -> DataFrame:
    """(doc_id, item_id, similarity, distance, first_word, n_words): the best window of every item found in a document."""
    need = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"))
    kind = need.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    out = spark.createDataFrame([], f"doc_id {kind}, {FOUND}")
    for part in _passes(benchmark, item_id, item_text, pass_bytes):
        shared = spark.sparkContext.broadcast(part)

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            finder = Finder(shared.value, min_similarity, radius)
            for frame in frames:
                rows = []
                for at in range(0, len(frame), DOCS):
                    some = frame.iloc[at : at + DOCS]
                    for doc, found in zip(some["doc_id"], finder.find_all(some["text"].tolist())):
                        rows += [(doc, finder.ids[j], *rest) for j, *rest in found]
                made = pd.DataFrame(rows, columns=["doc_id", "item_id", "similarity", "distance", "first_word", "n_words"])
                yield made.astype({"item_id": "Int64"})

        out = out.union(need.mapInPandas(run, f"doc_id {kind}, {FOUND}"))
    return out


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_similarity: float = 0.8,
    radius: int = RADIUS,
    pass_bytes: int = 8 << 20,
) -> DataFrame:
    """The rows in which no item is found, as they came."""
    column = docs.columns.index(text)
    for part in _passes(benchmark, item_id, item_text, pass_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = Finder(shared.value, min_similarity, radius)
            for batch in batches:
                for at in range(0, batch.num_rows, DOCS):
                    some = batch.slice(at, DOCS)
                    found = finder.find_all([t or "" for t in some.column(column).to_pylist()])
                    yield some.filter(pa.array([not f for f in found], type=pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
