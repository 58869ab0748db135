"""Bloom filters as literals: built from a column ``key`` of strings, probed by expressions.

Bits are set by one aggregation over 64-bit words; what reaches the driver are the
words, at most ``max_bytes`` in all. A filter of more keys than fit into that many bytes
is fuller and lets more strange keys pass; it never refuses a key that it holds.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 10
PROBES = 5  # with these two, strange keys pass once in 106
MAX_BYTES = 8 << 20


@dataclass
class Bloom:
    bits: bytes
    seed: int

    def passes(self, key: Column) -> Column:
        if not self.bits:  # no keys
            return F.lit(False)
        out = F.lit(True)
        for p in places(key, 8 * len(self.bits), self.seed):
            byte = F.conv(F.hex(F.substr(F.lit(self.bits), F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            bit = F.call_function("shiftright", byte, (p % 8).cast("int"))
            out = out & (bit.bitwiseAND(F.lit(1)) == 1)
        return out


def places(key: Column, size: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed * PROBES + j), key), F.lit(size)) for j in range(PROBES)]


def build(keys: DataFrame, n: int, seed: int, max_bytes: int = MAX_BYTES) -> Bloom:
    """The filter of ``keys``, of which there are about ``n``."""
    if not n:
        return Bloom(b"", seed)
    words = max(1, min(-(-n * BITS_PER_KEY // 64), max_bytes // 8))
    bit = keys.select(F.explode(F.array(*places(F.col("key"), words * 64, seed))).alias("p"))
    whole = bit.groupBy(F.floor(F.col("p") / 64).cast("int").alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("word")
    )
    out = bytearray(words * 8)
    for at, word in whole.toLocalIterator():  # at most max_bytes / 8 rows
        struct.pack_into("<q", out, 8 * at, word)
    return Bloom(bytes(out), seed)
