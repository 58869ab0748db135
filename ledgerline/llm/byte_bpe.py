"""Byte-level BPE encoding and decoding by a rank table.

Text is cut by the tokenizer's pattern; the distinct words of a batch are folded
once, all together: of all neighbouring pieces, those whose concatenation has the lowest rank
merge first, the leftmost of equals first. Ids travel as packed little-endian
unsigned 32-bit integers. Decoding concatenates the ids' byte pieces.

Null texts count as empty and have no ids. Documents are handled one by one, so
repeated rows and ids each get their own result and an empty table an empty one.
Only the named columns are read, other columns may have any name.
"""

from __future__ import annotations

import base64
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_of

CACHED_WORDS = 150_000  # words whose ids a task remembers; more are folded again
DOCS = 150  # documents whose new words are folded together
LONG_WORD = 64  # bytes from which a heap finds the next merge


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 piece and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word."""
    if word in ranks:
        return [ranks[word]]
    if len(word) >= LONG_WORD:
        return _fold_long(word, ranks)
    get, none = ranks.get, math.inf
    pieces = [word[i : i + 1] for i in range(len(word))]
    merged = [get(a + b, none) for a, b in zip(pieces, pieces[1:])]
    while merged and (best := min(merged)) != none:
        i = merged.index(best)
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        del merged[i]
        if i:
            merged[i - 1] = get(pieces[i - 1] + pieces[i], none)
        if i < len(merged):
            merged[i] = get(pieces[i] + pieces[i + 1], none)
    return [ranks[p] for p in pieces]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of candidate pairs: n log n for words without a blank."""
    n = len(word)
    end = list(range(1, n + 1))  # piece i covers word[i:end[i]]; end 0: swallowed
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(word[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # one of the two has changed since
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Merges:
    """The rank table by pairs of ids, for folding many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[piece[:i]] << 32 | ranks[piece[i:]], rank)
            for piece, rank in ranks.items()
            for i in range(1, len(piece))
            if piece[:i] in ranks and piece[i:] in ranks
        ]
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.keys, self.ranks = table[:, 0].copy(), table[:, 1].copy()
        self.none = 1 << 62
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), self.none)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def fold(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words that are not empty. Each round merges one pair of every word that has one."""
        size = np.array([len(w) for w in words])
        ids = self.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        pair = np.full(len(ids), self.none)
        inner = np.nonzero(word[1:] == word[:-1])[0]
        pair[inner] = self.rank(ids[inner], ids[inner + 1])
        done_word, done_ids = [], []
        while len(ids):
            start = np.nonzero(np.append(True, word[1:] != word[:-1]))[0]
            low = np.minimum.reduceat(pair, start)
            nth = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(ids))))
            over = (low == self.none)[nth]
            done_word.append(word[over])
            done_ids.append(ids[over])
            hits = np.nonzero((pair == low[nth]) & ~over)[0]
            if not len(hits):
                break
            hits = hits[np.append(True, nth[hits[1:]] != nth[hits[:-1]])]  # the leftmost of each word
            ids[hits] = pair[hits]
            keep = ~over
            keep[hits + 1] = False
            at = (np.cumsum(keep) - 1)[hits]
            ids, word, pair = ids[keep], word[keep], pair[keep]
            for left in (at, at[at > 0] - 1):
                inside = left[left + 1 < len(ids)]
                pair[left[left + 1 >= len(ids)]] = self.none
                same = word[inside] == word[inside + 1]
                pair[inside[~same]] = self.none
                inside = inside[same]
                pair[inside] = self.rank(ids[inside], ids[inside + 1])
        word, ids = np.concatenate(done_word), np.concatenate(done_ids)
        order = np.argsort(word, kind="stable")
        packed = ids[order].astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(word, minlength=len(words))) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]


class Coder:
    """Encoder and decoder of one task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.merges = Merges(ranks)
        self.words = regex.compile(pattern).findall
        self.pieces = {i: p for p, i in ranks.items()}
        self.known: dict[str, bytes] = {}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of some texts; their distinct new words are folded together."""
        known, cut = self.known, [self.words(t) for t in texts]
        if len(known) > CACHED_WORDS:
            known.clear()
        new = list(set().union(*cut).difference(known))
        short, coded = [], [w.encode() for w in new]
        for w, b in zip(new, coded):
            if b in self.ranks or len(b) >= LONG_WORD:
                known[w] = np.array(fold(b, self.ranks), dtype="<u4").tobytes()
            else:
                short.append((w, b))
        if short:
            known.update(zip([w for w, _ in short], self.merges.fold([b for _, b in short])))
        return [b"".join(list(map(known.__getitem__, words))) for words in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


def _mapped(df: DataFrame, ranks: dict[bytes, int], pattern: str, schema: str, make) -> DataFrame:
    """``make`` turns the second column's values, some rows at a time, into the columns after the first."""
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                some = batch.slice(at, DOCS)
                made = make(coder, some.column(1).to_pylist())
                names = ["doc_id", *made]
                yield pa.RecordBatch.from_arrays([some.column(0), *[pa.array(v, pa.binary()) for v in made.values()]], names=names)

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): packed ids of each whole text. The ranks are one vocabulary file, whose size is fixed."""
    need = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"))
    kind = need.schema["doc_id"].dataType.simpleString()
    return _mapped(
        need, ranks, pattern, f"doc_id {kind}, ids binary",
        lambda c, texts: {"ids": c.encode_all(texts)},
    )


def decode(coded: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, bytes): the byte pieces of packed ids, concatenated; null ids give no bytes."""
    need = coded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    kind = need.schema["doc_id"].dataType.simpleString()
    return _mapped(
        need, ranks, pattern, f"doc_id {kind}, bytes binary",
        lambda c, coded: {"bytes": [c.decode(i) for i in coded]},
    )


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, bytes): both steps in one pass over the texts."""
    need = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"))
    kind = need.schema["doc_id"].dataType.simpleString()

    def both(c: Coder, texts: list[str]) -> dict[str, list[bytes]]:
        ids = c.encode_all(texts)
        return {"ids": ids, "bytes": [c.decode(i) for i in ids]}

    return _mapped(need, ranks, pattern, f"doc_id {kind}, ids binary, bytes binary", both)


def digests(coded: DataFrame) -> DataFrame:
    """The figures that tell one encoding from another, from ``round_trip`` rows."""
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
