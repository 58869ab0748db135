"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Text is written as codes of 8 bytes, hashed from its lower-cased words, which end at every character
that is no letter (digits are words of their own): every letter is read. A word of up to
``WHOLE`` letters gives one code. Scripts written without blanks and longer runs give a code for
each overlapping piece: of 2 letters in Chinese and Japanese, else of ``PIECE``. Codes that don't lie in a dictionary
can't be compressed, so that a window's length tells how much of it the dictionary has
seen, and nothing else (plain letters drown that in the costs of entropy tables).

Training takes at most ``sample`` labelled rows of each class, those with the smallest
hash of the id. Three quarters of them, each text once, train the dictionaries: the toxic one holds codes that
occur in toxic documents at least twice as often as in ordinary ones, with a log likelihood ratio
of ``evidence`` or more (by chance about one code of 200,000 has 20); the ordinary one codes of ordinary documents that lean their way with a
ratio of ``ordinary_evidence`` (nothing is twice as frequent in nearly all of the corpus). The strongest come
last, where matches cost least. They are raw content for zstandard, not the output of its dictionary trainer.
The others calibrate: a logistic curve over the bytes that windows save with either dictionary
against a plain compressor, in all and per word. The classes weigh as in all labelled rows, not as in the sample,
so that a score is a share; 0.5 is the threshold.

Null texts count as empty; empty texts save nothing and get the curve's lowest
score. Labels that are null are not used, a document labelled twice counts as toxic if
one label says so. Without labels of both classes every score is 0. Rows are scored
one by one: repeated rows get equal scores, an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, text_of

WHOLE = 16  # letters of the longest word with a code of its own
PIECE = 5
WINDOW = 64  # codes
DOCS = 200  # texts that a task turns into strings at a time
LEVEL = 3

# Scripts without blanks between words: those with a letter for a syllable or word, and those of South-East Asia.
HAN = r"\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
THAI = r"\u0e00-\u0e7f\u0e80-\u0eff\u1000-\u109f\u1780-\u17ff"
# Marks belong to the letter before them.
MARKS = "".join(c for c in map(chr, range(0x300, 0x10000)) if unicodedata.category(c)[0] == "M")
WORDS = re.compile(rf"([{HAN}]+)|((?:(?!\d)[{THAI}])+)|((?:[^\W\d_{HAN}{THAI}]+[{MARKS}]*)+)|\d+").finditer
# The same words in a text without those scripts and marks, many times faster.
PLAIN = re.compile(r"[^\W\d_]+|\d+").findall
# A class within 16 bits is looked up at once, a larger one item by item.
OTHER = re.compile(rf"[{HAN[:-21]}{THAI}{MARKS}]|[\U00010000-\U0003ffff]").search


def words_of(text: str) -> list[tuple[str, int | None]]:
    if text.isascii() or not OTHER(text):
        return [(word, None) for word in PLAIN(text)]
    return [(match.group(), match.lastindex) for match in WORDS(text)]


def pieces(word: str, kind: int | None) -> list[str]:
    """What a word is coded by; ``kind``: the group of ``WORDS`` that it is."""
    size = 2 if kind == 1 else PIECE
    if len(word) <= size or (kind != 1 and kind != 2 and len(word) <= WHOLE):
        return [word]
    return [word[i : i + size] for i in range(len(word) - size + 1)]


class Coder:
    """Writes words as codes; remembers the codes of ``MEMORY`` pieces."""

    MEMORY = 100_000

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}

    def codes(self, text: str) -> list[bytes]:
        from xxhash import xxh64_digest

        known, out = self.known, []
        if len(known) > self.MEMORY:
            known.clear()
        for word, kind in words_of(text.lower()):
            for piece in (word,) if kind is None and len(word) <= WHOLE else pieces(word, kind):
                code = known.get(piece)
                if code is None:
                    code = known[piece] = xxh64_digest(piece.encode())
                out.append(code)
        return out


class Meter:
    """Compressed lengths of a document's windows under both dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard

        self.coder = Coder()
        self.length = []
        for content in (b"", ordinary, toxic):
            if len(content) < 8:  # the plain compressor, or nothing characteristic
                made = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
            else:
                # the library indexes no position in the last 8 bytes
                own = zstandard.ZstdCompressionDict(content + bytes(16), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                own.precompute_compress(level=LEVEL)
                made = zstandard.ZstdCompressor(dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)
            self.length.append(made.compress)

    def saved(self, text: str) -> tuple[int, int, int]:
        """Bytes saved by the toxic and by the ordinary dictionary, summed over the windows that gain, and the codes."""
        codes = self.coder.codes(text)
        plain, ordinary, toxic = self.length
        by_toxic = by_ordinary = 0
        for at in range(0, len(codes), WINDOW):
            window = b"".join(codes[at : at + WINDOW])
            alone = len(plain(window))
            by_toxic += max(alone - len(toxic(window)), 0)
            by_ordinary += max(alone - len(ordinary(window)), 0)
        return by_toxic, by_ordinary, len(codes)


class Model:
    """Dictionaries and curve. Small: two contents of at most ``size`` bytes and five weights."""

    def __init__(self, ordinary: bytes, toxic: bytes, weights: list[float] | None):
        self.ordinary, self.toxic, self.weights = ordinary, toxic, weights

    def scores(self, texts, meter: Meter | None = None) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        meter = meter or Meter(self.ordinary, self.toxic)
        x = features([meter.saved(t) for t in texts])
        return 1 / (1 + np.exp(-(x @ np.array(self.weights))))


def features(saved: list[tuple[int, int, int]]) -> np.ndarray:
    s = np.array(saved, dtype=float).reshape(-1, 3)
    words = np.maximum(s[:, 2], 1)
    return np.stack([np.ones(len(s)), *(f for i in (0, 1) for f in (np.log1p(s[:, i]), np.log1p(100 * s[:, i] / words)))], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> list[float]:
    """Weights by Newton steps, halved until the loss falls: classes may be separable. ``weight``: what each row counts."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(weight @ (np.logaddexp(0, z) - y * z) + ridge * (w @ w) / 2)

    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        while np.abs(step).max() > 1e-9 and loss(w + step) > loss(w):
            step = step / 2
        if np.abs(step).max() < 1e-9:
            break
        w = w + step
    return w.tolist()


def _ratio(a: int, n: int, b: int, m: int) -> float:
    """Log likelihood ratio of a of n against b of m."""

    def fit(k: int, total: int, q: float) -> float:
        return (k * math.log(q) if k else 0.0) + ((total - k) * math.log(1 - q) if total > k else 0.0)

    p = (a + b) / (n + m)
    return 2 * (fit(a, n, a / n) + fit(b, m, b / m) - fit(a, n, p) - fit(b, m, p))


def dictionary(counts: list[tuple[bytes, int, int]], n: int, m: int, evidence: float, size: int, lean: float) -> bytes:
    """Content from (code, documents of the class, documents of the other); ``lean``: least ratio of the shares."""
    strong = []
    for code, a, b in counts:
        if a >= 4 and a * m > lean * b * n:
            r = _ratio(a, n, b, m)
            if r >= evidence:
                strong.append((r, code))
    return b"".join(code for _, code in sorted(strong))[-size:]


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fold: int = 5,
    sample: int = 3000,
    evidence: float = 20.0,
    ordinary_evidence: float = 3.0,
    size: int = 1 << 16,
) -> Model:
    """Learns from rows whose crc32 of the id is not a multiple of ``fold``."""
    known = (
        labels.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
        .filter("id is not null and y in (0, 1)")
        .filter(~_held_out("id", fold))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    by_hash = F.xxhash64("id")
    chosen = known.filter("y = 1").orderBy(by_hash, "id").limit(sample).union(known.filter("y = 0").orderBy(by_hash, "id").limit(sample))
    # at most twice the sample: a bound that does not depend on the tables
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), text_of(text).alias("text")).join(F.broadcast(chosen), "id")
    texts = Scratch(docs.sparkSession).save(texts, "sample")

    def coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder()
        for f in frames:
            yield pd.DataFrame({"id": f["id"], "y": f["y"], "text": f["text"], "codes": [list(set(coder.codes(t))) for t in f["text"]]})

    each = texts.mapInPandas(coded, "id bigint, y int, text string, codes array<binary>").withColumn(
        "part", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(4))
    )
    fit = each.filter("part > 0").dropDuplicates(["y", "text"])  # copies of one text are one piece of evidence
    total = {r["y"]: r["n"] for r in fit.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    if not n0 or not n1:
        return Model(b"", b"", None)
    counts = (
        fit.select("y", F.explode("codes").alias("code"))
        .groupBy("code")
        .agg(F.count_if(F.col("y") == 1).alias("t"), F.count_if(F.col("y") == 0).alias("o"))
        .filter(((F.col("t") >= 4) & (F.col("t") * n0 > F.col("o") * (2 * n1))) | ((F.col("o") >= 20) & (F.col("o") * n1 > F.col("t") * n0)))
        .collect()
    )  # words of the sample that lean to one class
    toxic = dictionary([(bytes(r["code"]), r["t"], r["o"]) for r in counts], n1, n0, evidence, size, 2)
    usual = [(bytes(r["code"]), r["o"], r["t"]) for r in counts if r["o"] >= 20]
    ordinary = dictionary(usual, n0, n1, ordinary_evidence, size, 1)

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        meter = Meter(ordinary, toxic)
        for f in frames:
            s = [meter.saved(t) for t in f["text"]]
            yield pd.DataFrame({"id": f["id"], "y": f["y"], "toxic": [a for a, _, _ in s], "ordinary": [b for _, b, _ in s], "words": [c for _, _, c in s]})

    rows = each.filter("part = 0").select("id", "y", "text").mapInPandas(measured, "id bigint, y int, toxic bigint, ordinary bigint, words bigint")
    got = rows.orderBy("id", "toxic", "ordinary", "words").collect()  # a quarter of the sample, five numbers each
    if not got:
        return Model(ordinary, toxic, None)
    x = features([(r["toxic"], r["ordinary"], r["words"]) for r in got])
    y = np.array([r["y"] for r in got], dtype=float)
    of = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    weight = np.where(y == 1, of[1] / max(y.sum(), 1), of[0] / max((1 - y).sum(), 1))
    return Model(ordinary, toxic, logistic(x, y, weight * len(y) / weight.sum()))


def _held_out(doc_id: str, fold: int):
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % fold == 0, F.lit(False))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", fold: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    need = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"))
    kind = need.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(model.ordinary, model.toxic)
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS):
                some = batch.slice(first, DOCS)
                scores = model.scores(some.column(1).to_pylist(), meter)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(scores)], names=["doc_id", "score"])

    out = need.mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", _held_out("doc_id", fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose score is below 0.5, as they came."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(model.ordinary, model.toxic)
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS):
                some = batch.slice(first, DOCS)
                texts = [t or "" for t in some.column(at).to_pylist()]
                yield some.filter(pa.array(model.scores(texts, meter) < 0.5))

    return docs.mapInArrow(run, docs.schema)
