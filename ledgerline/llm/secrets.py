"""Secret scan: fixed patterns, and tokens that a battery of randomness tests calls random.

A candidate is a run ``[A-Za-z0-9+/_-]+={0,2}`` with at least ``min_length``
characters before the padding that touches no pattern match. ``-`` and ``_`` are separators and no
symbols: UUIDs and grouped keys are read without them, and a random URL-safe base 64
token is uniform over the other 62 symbols. The encoding is the smallest alphabet that
holds the rest: hex (of either case, or mixed), base 32, one case and digits, letters and
digits, else base 64. A random token that fits a smaller alphabet by chance is uniform there too.
Three statistics are taken against uniform random symbols of that encoding:

* chi-squared of the symbol counts against the uniform alphabet,
* the runs test of symbols above and below the alphabet's middle,
* the serial correlation of neighbouring symbols.

The hypothesis that has to be refuted is that a candidate is text. Short text passes for
random for want of power, so each candidate gets the probability that running text of the
same length looks as random: under text the chi-squared statistic is noncentral, with a
noncentrality that grows with the length and with the corpus's own letter frequencies (both
cases together where the encoding has one). Random means random in all three tests, so the
p-value of a candidate is the largest that a test gives for text: 1 if one of them rejects it
as random (``reject``), else the chi-squared one. Rejecting only raises p-values, so they
stay valid. They go through Benjamini-Hochberg within length classes, over all
candidates of the corpus, the rejected ones counted, at ``fdr``. The step-up works on counts per
bin of width 0.02 in -log10 p, rejected candidates in bin 0.

Null texts count as empty. Each row is judged by itself, so repeated rows and ids
get equal results. An empty table gives an empty result. Only the id and the text
are read, other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, text_of

# The patterns of the base kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

# The smaller ones first.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "abcdefghijklmnopqrstuvwxyz234567",
    "BASE32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower": "abcdefghijklmnopqrstuvwxyz0123456789",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
PLACES = {kind: {c: i for i, c in enumerate(alphabet)} for kind, alphabet in ALPHABETS.items()}
NO_SYMBOLS = str.maketrans("", "", "-_=")
BIN = 0.02  # width of a bin in -log10 p
SPANS = "kind int, `start` int, `end` int"


def _tail(z: float) -> float:
    """Two-sided normal tail."""
    return math.erfc(abs(z) / math.sqrt(2))


def symbols_of(token: str) -> tuple[str, str]:
    """Encoding and symbols of a token: the smallest alphabet that holds all but separators and padding."""
    body = token.translate(NO_SYMBOLS)
    used = set(body)
    for kind, place in PLACES.items():
        if used <= place.keys():
            return kind, body
        if kind == "HEX" and used <= place.keys() | PLACES["hex"].keys():
            return "hex", body.lower()
    raise ValueError(f"no encoding holds {token!r}")


def battery(token: str) -> tuple[str, np.ndarray, float, float, float]:
    """Encoding, symbols' counts, and the p-values of the three tests for one token."""
    kind, body = symbols_of(token)
    place = PLACES[kind]
    x = np.array([place[c] for c in body], dtype=float)
    n, k = len(x), len(place)
    counts = np.bincount(x.astype(int), minlength=k)
    if n < 3:
        return kind, counts, 1.0, 1.0, 1.0
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    p_chi = _tail(0) if chi <= k - 1 else 0.5 * math.erfc(_wilson(chi, k - 1) / math.sqrt(2))
    up = x >= k / 2
    a, b = int(up.sum()), int((~up).sum())
    if a and b:
        runs = 1 + int((up[1:] != up[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = _tail((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    dev = x - (k - 1) / 2
    spread = (k * k - 1) / 12
    p_serial = _tail(float((dev[1:] * dev[:-1]).sum()) / (spread * math.sqrt(n - 1)))
    return kind, counts, p_chi, p_runs, p_serial


def _wilson(chi: float, df: float) -> float:
    """Normal deviate of a chi-squared value."""
    return ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))


def text_p(counts: np.ndarray, weights: np.ndarray) -> float:
    """Probability that text with these letter frequencies has a chi-squared as low (noncentral, Sankaran's normal form)."""
    n, k = int(counts.sum()), len(counts)
    if n < 2:
        return 1.0
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    off = max(float(((weights - 1 / k) ** 2).sum() * k) * (n - 1), 1e-9)
    df = k - 1
    h = 1 - 2 * (df + off) * (df + 3 * off) / (3 * (df + 2 * off) ** 2)
    p = (df + 2 * off) / (df + off) ** 2
    m = (h - 1) * (1 - 3 * h)
    mean = 1 + h * p * (h - 1 - 0.5 * (2 - h) * m * p)
    var = h * math.sqrt(2 * p) * (1 + 0.5 * m * p)
    z = ((chi / (df + off)) ** h - mean) / var
    return max(0.5 * math.erfc(-z / math.sqrt(2)), 1e-300)


def length_class(n: int) -> int:
    """Length classes grow by a quarter octave, so their number follows the logarithm of the longest token."""
    return int(4 * math.log2(max(n, 1)))


def _find(docs: DataFrame, doc_id: str, text: str, min_length: int, reject: float) -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()
    # letters: counts of the byte values 0 to 127 over a frame's texts, on the frame's first row;
    # refused: length classes of the candidates that a test rejects as random
    schema = f"doc_id {kind}, letters array<bigint>, base array<struct<{_fields(SPANS)}>>, found array<struct<{_fields(SPANS)}, size: int, enc: string, counts: array<int>>>, refused array<int>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        assign = re.compile(ASSIGN, re.I | re.A).finditer
        access = re.compile(ACCESS).finditer
        hexes = re.compile(r"[0-9a-f]{24,}").finditer
        tokens = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % min_length).finditer

        def base_of(t: str) -> list[tuple[int, int, int]]:
            low, out = t.lower(), []
            if "pass" in low or "secret" in low or "token" in low or "api" in low:
                out = [(0, *m.span()) for m in assign(t) if m.end(2) - m.start(2) >= 6]
            if "AKIA" in t:
                out += [(1, *m.span()) for m in access(t) if m.end() - m.start() >= 20]
            out += [(2, *m.span()) for m in hexes(t)]
            return sorted(out, key=lambda s: (s[1], s[0]))

        def found_in(t: str, base: list[tuple[int, int, int]]) -> tuple[list[dict], list[int]]:
            out, refused = [], []
            at, reach = 0, 0  # base spans that begin before the token's end, and how far they go
            for m in tokens(t):
                s, e = m.span()
                while at < len(base) and base[at][1] < e:
                    reach = max(reach, base[at][2])
                    at += 1
                if reach > s:
                    continue
                enc, counts, *ps = battery(m.group())
                size = int(counts.sum())
                if min(ps) < reject:
                    refused.append(length_class(size))
                else:
                    out.append({"kind": 3, "start": s, "end": e, "size": size, "enc": enc, "counts": counts.tolist()})
            return out, refused

        for frame in frames:
            bases = [base_of(t) for t in frame["text"]]
            letters = np.zeros(256, dtype=np.int64)
            for t in frame["text"]:
                letters += np.bincount(np.frombuffer(t.encode(), dtype=np.uint8), minlength=256)
            found = [found_in(t, b) for t, b in zip(frame["text"], bases)]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "letters": [letters[:128].tolist() if i == 0 else None for i in range(len(frame))],
                    "base": [[{"kind": k, "start": s, "end": e} for k, s, e in b] for b in bases],
                    "found": [f for f, _ in found],
                    "refused": [r for _, r in found],
                }
            )

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text")).mapInPandas(run, schema)


def _fields(ddl: str) -> str:
    return ", ".join(": ".join(f.rsplit(" ", 1)) for f in ddl.split(", "))


def step_up(bins: list[tuple[int, int, int]], fdr: float) -> dict[int, int]:
    """Benjamini-Hochberg on counts: (class, bin, rows) -> smallest bin of -log10 p that is a discovery, by class."""
    out: dict[int, int] = {}
    for cls in {c for c, _, _ in bins}:
        own = sorted(((b, n) for c, b, n in bins if c == cls), reverse=True)
        total, seen = sum(n for _, n in own), 0
        for b, n in own:
            seen += n
            if 10 ** (-b * BIN) * total <= fdr * seen:
                out[cls] = b
    return out


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = 20,
    reject: float = 0.001,
    fdr: float = 0.01,
) -> DataFrame:
    """(doc_id, base, spans): spans as array of (kind number, start, end) in code points, by start, then kind."""
    found = Scratch(docs.sparkSession).save(_find(docs, doc_id, text, min_length, reject), "found")
    by_letter = found.select(F.posexplode("letters").alias("c", "n")).groupBy("c").agg(F.sum("n").alias("n"))
    letters = {chr(c): n for c, n in by_letter.collect()}  # 128 rows
    share = {}
    for enc, alphabet in ALPHABETS.items():
        one_case = enc not in ("base62", "base64")  # text in capitals has the letters of other text
        w = np.array([sum(letters.get(x, 0) for x in ({c.lower(), c.upper()} if one_case else c)) for c in alphabet], dtype=float) + 1
        share[enc] = w / w.sum()

    @F.pandas_udf("array<struct<cls: int, bin: int>>")
    def judge(each: pd.Series) -> pd.Series:
        def one(x):
            p = text_p(np.array(x["counts"]), share[x["enc"]])
            return {"cls": length_class(x["size"]), "bin": int(-math.log10(p) / BIN)}

        return each.map(lambda xs: [one(x) for x in xs])

    judged = found.withColumn("judged", judge("found"))
    # one row for each length class and bin: the logarithm of the longest token times 15,000 bins at most
    refused = F.transform("refused", lambda c: F.struct(c.alias("cls"), F.lit(0).alias("bin")))
    bins = judged.select(F.explode(F.concat("judged", refused)).alias("j")).groupBy("j.cls", "j.bin").count()
    least = step_up([tuple(r) for r in bins.collect()], fdr)
    both = F.arrays_zip(F.col("found").alias("f"), F.col("judged").alias("j"))
    random = F.transform(
        F.filter(both, lambda z: _kept(z["j"], least)),
        lambda z: F.struct(z["f"]["kind"].alias("kind"), z["f"]["start"].alias("start"), z["f"]["end"].alias("end")),
    )
    return judged.select("doc_id", "base", _by_start(F.concat("base", random)).alias("spans"))


def _kept(j: Column, least: dict[int, int]) -> Column:
    out = F.lit(False)
    for cls, b in least.items():
        out = out | ((j["cls"] == cls) & (j["bin"] >= b))
    return out


def _by_start(spans: Column) -> Column:
    moved = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.transform(
        F.sort_array(moved), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def written(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
