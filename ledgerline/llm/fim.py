"""Fill-in-middle: a text is cut into prefix, middle and suffix at two units, and written in another order.

A text's UTF-8 bytes lie in blocks of fixed length. A Fenwick tree over the blocks stores
how many units, and how many code points, begin in each; binary lifting descends to the
block where the wanted unit begins, and only that block is searched for its byte. Units
are code points, or the matches of a pattern (what lies between two matches belongs to the
earlier one, what lies before the first to the first).

Cuts and form follow from hashes of the id: h1 to h4 are the first four groups of 8 hex
digits of sha256("<seed>:<id>"). Prefix ends after the smaller of h1 % (n + 1) and
h2 % (n + 1) units, middle after the larger. A text is plain if it is empty, contains a
mark, or h3 % 100 is not below ``rate``; else spm if h4 % 100 is below ``spm``; else psm.

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

A transformed text holds every mark once: the text has none, and no mark overlaps itself or
another, so none can arise at a cut. ``restored`` therefore rebuilds the text exactly from
output and form, without the cuts.

A null text counts as empty. A null id counts as one without digits. Repeated rows give
repeated results. An empty table gives an empty result. Other columns are carried in
``_row``, so no name can clash. Texts pass through tasks in slices of bounded bytes; one text
needs a few times its own size.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import text_of

MARKS = ("<P>", "<S>", "<M>")
BLOCK = 4096  # bytes
SLICE = 16 << 20  # bytes of text turned at a time
FORMS = ("plain", "psm", "spm")


class BlockTree:
    """Fenwick tree over blocks: row i sums the units and code points of the (i & -i) blocks that end with block i."""

    def __init__(self, counts: np.ndarray):
        self.n = len(counts)
        self.sums = np.vstack([np.zeros((1, 2), np.int64), counts])
        step = 1
        while step <= self.n:  # all nodes of one span at a time, each into the node above it
            at = np.arange(step, self.n + 1 - step, 2 * step)
            self.sums[at + step] += self.sums[at]
            step *= 2
        self.top = step // 2

    def find(self, unit: int) -> tuple[int, int, int]:
        """The block in which the unit (from 0) begins, with the units and code points before that block."""
        block, units, points, step = 0, 0, 0, self.top
        while step:
            if block + step <= self.n and units + self.sums[block + step, 0] <= unit:
                block += step
                units += int(self.sums[block, 0])
                points += int(self.sums[block, 1])
            step //= 2
        return block, units, points


class Text:
    """One text as bytes, with the tree over its blocks."""

    def __init__(self, data: np.ndarray, pattern: re.Pattern | None, block: int):
        self.data, self.block = data, block
        self.leads = (data & 0xC0) != 0x80  # the first byte of each code point
        self.begins = self.leads if pattern is None else self._matches(pattern)
        at = np.arange(0, len(data), block)
        counts = np.stack([np.add.reduceat(x, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64) for x in (self.begins, self.leads)], axis=1)
        self.tree = BlockTree(counts)
        self.units = int(counts[:, 0].sum())
        self.points = int(counts[:, 1].sum())

    def _matches(self, pattern: re.Pattern) -> np.ndarray:
        starts = [m.start() for m in pattern.finditer(self.data.tobytes().decode("utf-8", "replace")) if m.end() > m.start()]
        begins = np.zeros(len(self.data), bool)
        begins[np.flatnonzero(self.leads)[starts]] = True
        return begins

    def cut(self, units: int) -> tuple[int, int]:
        """(byte, code points) where the first ``units`` units end."""
        if units >= self.units:
            return len(self.data), self.points
        if units == 0:
            return 0, 0
        block, before, points = self.tree.find(units)
        first = block * self.block
        inside = int(np.flatnonzero(self.begins[first : first + self.block])[units - before])
        return first + inside, points + int(self.leads[first : first + inside].sum())


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    first, held = 0, 0
    for i, size in enumerate(pa.compute.binary_length(batch.column("_text")).to_pylist()):
        if held and held + size > SLICE:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


def _turn(marks: tuple[str, str, str], pattern: str | None, block: int):
    p, s, m = (x.encode() for x in marks)
    units = None if pattern is None else re.compile(pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                n, prefix, middle, output = [], [], [], []
                h1, h2, form = (part.column(c).to_pylist() for c in ("_h1", "_h2", "_form"))
                for i, raw in enumerate(part.column("_text")):
                    raw = raw.as_py()
                    text = Text(np.frombuffer(raw, np.uint8), units, block)
                    n.append(text.units)
                    if form[i] == "plain":
                        prefix.append(None), middle.append(None), output.append(raw)
                        continue
                    a, b = sorted((h1[i] % (text.units + 1), h2[i] % (text.units + 1)))
                    (a, before), (b, upto) = text.cut(a), text.cut(b)
                    prefix.append(before), middle.append(upto - before)
                    head, mid, tail = raw[:a], raw[a:b], raw[b:]
                    output.append(b"".join((p, head, s, tail, m, mid) if form[i] == "psm" else (s, tail, p, head, m, mid)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), pa.array(n, pa.int64()), part.column("_form"), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary())],
                    names=["_row", "n", "form", "prefix_chars", "middle_chars", "_output"],
                )

    return run


def transform(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    marks: tuple[str, str, str] = MARKS,
    unit: str | None = None,
    rate: int = 90,
    spm: int = 20,
    seed: str = "1",
    block: int = BLOCK,
) -> DataFrame:
    """(_row, n, form, prefix_chars, middle_chars, output): every document in fill-in-middle order.

    ``_row`` holds the other columns. ``unit`` is a pattern of Python's ``re``, or none for code points.
    """
    for one in marks:
        if not one or any(one[i:] == two[: len(one) - i] or two in one[i:] for two in marks for i in range(1, len(one))):
            raise ValueError("a mark may neither overlap itself or another nor hold one")
    if len(set(marks)) < 3:
        raise ValueError("marks must differ")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(key, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    whole = text_of(text)
    plain = (whole == "") | (h[2] % 100 >= rate)
    for mark in marks:
        plain = plain | whole.contains(mark)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text or text == doc_id]).alias("_row"),
        whole.cast("binary").alias("_text"),
        h[0].alias("_h1"),
        h[1].alias("_h2"),
        F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm").alias("_form"),
    )
    schema = T.StructType(
        [
            rows.schema["_row"],
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("_output", T.BinaryType()),
        ]
    )
    out = rows.mapInArrow(_turn(marks, unit, block), schema)
    return out.select("_row", "n", "form", "prefix_chars", "middle_chars", F.col("_output").cast("string").alias("output"))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output of this form was made from."""
    p, s, m = marks
    between = lambda after, before: F.substring_index(F.substring_index(output, before, 1) if before else output, after, -1)
    middle = between(m, None)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
