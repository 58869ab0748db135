"""Shards, fill-in-middle and the prefix trie against plain versions, and on odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import fim, prefix_trie, sharding


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    return df.select("*", F.lit(1).alias("_row"), F.lit("x").alias("shard"), F.lit(2).alias("slot"), F.lit(3).alias("n"), F.lit("y").alias("form"))


ODD = [(1, None), (2, ""), (3, " \n "), (None, "a b c"), (4, "same text here"), (4, "same text here"), (5, "same text here"), (-6, "z" * 90000), (7, "été 😀 " * 900), (8, "a<P>b"), (9, "x<S"), (10, "P>y")]


# ---------------------------------------------------------------- shards


def plain_capacity(sizes, shards):
    """The smallest largest shard, by trying every total of neighbouring groups."""

    def fits(cap):
        used, held = 1, 0
        for s in sizes:
            if s > cap:
                return False
            used, held = (used, held + s) if held + s <= cap else (used + 1, s)
        return used <= shards

    totals = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})
    return next(c for c in totals if fits(c))


def check_shards(rows, got, shards):
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    for r in got:
        assert 0 <= r.shard < shards
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for i, t in rows:
        first, nameless, n = groups.get(t or "", (None, False, 0))
        groups[t or ""] = (i if first is None else first if i is None else min(first, i), nameless or i is None, n + len((t or "").encode()) + 1)
    order = sorted(groups, key=lambda t: (not groups[t][1], groups[t][0] is not None, groups[t][0] or 0, hashlib.sha256(t.encode()).digest()))
    owner = defaultdict(set)
    for r in got:
        owner[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in owner.values()), "equal texts stay together"
    shard_of = [next(iter(owner[zlib.crc32(t.encode()), len(t.encode()) + 1])) for t in order]
    assert shard_of == sorted(shard_of), "shards are contiguous in the order of the groups"
    load = Counter()
    for t, s in zip(order, shard_of, strict=True):
        load[s] += groups[t][2]
    assert max(load.values()) == plain_capacity([groups[t][2] for t in order], shards)
    return load


@pytest.mark.parametrize("cells", [9, 4096])
def test_smallest_largest_shard(spark, monkeypatch, cells):
    monkeypatch.setattr(sharding, "CELLS", cells)  # few cells: several levels of refinement
    rnd = random.Random(cells)
    rows = [(i, "w" * rnd.choice([0, 1, 3, 50, 900]) + str(rnd.randrange(60))) for i in rnd.sample(range(1000), 160)]
    got = sharding.assign(texts(spark, rows), shards=5).select("_row.doc_id", "size", "text_crc32", "shard", "slot").collect()
    load = check_shards(rows, got, 5)
    assert len(load) == 5 and max(load.values()) < 1.3 * sum(load.values()) / 5


def test_a_text_that_half_the_rows_share(spark):
    rows = [(i, "hot text") for i in range(300)] + [(1000 + i, f"t{i}" * 3) for i in range(300)]
    got = sharding.assign(texts(spark, rows), shards=8, keep=["doc_id"]).select("_row.doc_id", "size", "text_crc32", "shard", "slot").collect()
    load = check_shards(rows, got, 8)
    rest = sorted(load.values())[:-1]
    assert len(load) == 8 and rest[-1] < 1.2 * rest[0], "the others share evenly what the large group leaves"
    assert {r.slot for r in got if r.text_crc32 == zlib.crc32(b"hot text")} == set(range(300))


def test_odd_shards(spark):
    got = sharding.assign(texts(spark, ODD), shards=3).select("_row.doc_id", "_row.slot", "size", "text_crc32", "shard", F.col("slot").alias("s")).collect()
    check_shards(ODD, [type("R", (), {"doc_id": r.doc_id, "size": r["size"], "text_crc32": r.text_crc32, "shard": r.shard, "slot": r.s}) for r in got], 3)
    assert {r[1] for r in got} == {2}, "columns of the same name stay in _row"
    assert {(r["size"], r.text_crc32) for r in got if r.doc_id in (1, 2)} == {(1, 0)}
    assert sharding.assign(texts(spark, []), shards=3).collect() == []
    assert {r.shard for r in sharding.assign(texts(spark, ODD), shards=1).collect()} == {0}
    with pytest.raises(ValueError):
        sharding.assign(texts(spark, ODD), shards=0)


def test_written_shards(spark, tmp_path):
    rows = [(i, f"text {i % 40} " * 20) for i in range(200)]
    sharding.write(texts(spark, rows), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text) for r in back.select("document.doc_id", "document.text").collect()) == Counter(rows)
    assert [r[0] for r in back.groupBy("shard").agg((F.max("slot") + 1 == F.count("*"))).select("shard").orderBy("shard").collect()] == [0, 1, 2, 3]


# ---------------------------------------------------------------- fill-in-middle


def plain_fim(doc_id, text, unit=None):
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    starts = list(range(len(text))) if unit is None else [m.start() for m in re.finditer(unit, text) if m.group()]
    n = len(starts)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    at = lambda k: len(text) if k >= n else 0 if k == 0 else starts[k]
    a, b = sorted(at(x % (n + 1)) for x in h[:2])
    pre, mid, suf = text[:a], text[a:b], text[b:]
    spm = h[3] % 100 < 20
    return n, "spm" if spm else "psm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("unit,block", [(None, 4096), (None, 7), (r"\S+", 16), (r"[^\n]*\n", 5)])
def test_fill_in_middle(spark, unit, block):
    rnd = random.Random(block)
    rows = ODD + [(100 + i, "".join(rnd.choice(["a", "é", "😀", " ", "\n", "字", "<", "P>", "<S"]) for _ in range(rnd.randrange(200)))) for i in range(150)]
    out = fim.transform(texts(spark, rows), unit=unit, block=block)
    got = out.select("_row.doc_id", "_row.n", F.struct("n", "form", "prefix_chars", "middle_chars", "output").alias("o"), fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert Counter((r.doc_id, tuple(r.o), r.back) for r in got) == Counter((i, plain_fim(i, t, unit), t or "") for i, t in rows)
    assert {r[1] for r in got} == {3}
    assert len({r.o.form for r in got}) == 3


def test_block_tree():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 8, 13, 64, 100):
        counts = rnd.integers(0, 4, (n, 2))
        tree, upto = fim.BlockTree(counts), np.vstack([[0, 0], counts.cumsum(axis=0)])
        for unit in range(int(counts[:, 0].sum()) if n else 0):
            block = int(np.searchsorted(upto[1:, 0], unit, side="right"))
            assert tree.find(unit) == (block, *upto[block])


def test_odd_fill_in_middle(spark):
    assert fim.transform(texts(spark, [])).collect() == []
    for marks in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "<S>", ""), ("ab", "bc", "<M>"), ("abc", "b", "<M>")):
        with pytest.raises(ValueError):
            fim.transform(texts(spark, ODD), marks=marks)


# ---------------------------------------------------------------- prefix trie


def turn_key(r, t):
    return hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{t or ''}".encode()).digest()


def plain_trie(rows, stride=5, longest=8):
    own = defaultdict(list)
    for c, turn, r, t in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, turn_key(r, t), r or "", t or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (longest + 1)
        base = c - int(np.fmod(c, stride))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        w = (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += w
    return Counter(
        (min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], sha(",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(p))))
        for p, cs in members.items()
    )


def talks(spark, rows):
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    return df.select("*", F.lit(1).alias("depth"), F.lit("x").alias("fp"), F.lit("y").alias("conv"))


def trie(spark, rows, **more):
    out = prefix_trie.nodes(talks(spark, rows), **more).drop("turn_conv", "turn_place", "fingerprint")
    return Counter(tuple(r) for r in out.collect())


def test_prefix_trie(spark):
    rnd = random.Random(3)
    rows = [
        (c, t if rnd.random() < 0.9 else None, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bé", None, "", "long text " * 9]))
        for c in rnd.sample(range(-40, 200), 120)
        for t in range(rnd.randrange(1, 14))
    ]
    rows += [(None, 1, "user", "nobody's"), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "user", "other tie")]
    assert trie(spark, rows) == plain_trie(rows)


def test_trie_of_equal_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3 if c % 3 else 1)] + [(1001, 0, "user", "short")]
    assert trie(spark, rows) == plain_trie(rows)


def test_trie_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    monkeypatch.setattr(prefix_trie, "PIECE", 64)
    # one conversation runs over several partitions; one copy shares all of it, another half
    long = [("user", f"turn {i}") for i in range(90)]
    rows = [(10, i, *t) for i, t in enumerate(long)] + [(11, i, *t) for i, t in enumerate(long)] + [(12, i, *t) for i, t in enumerate(long[:45])]
    rows += [(c, i, "user", "x" * c) for c in range(20, 24) for i in range(3)]
    assert trie(spark, rows) == plain_trie(rows)
    r = 12345
    turns = talks(spark, rows).select(F.col("conv_id").alias("conv"), "turn", F.lit(b"k").alias("key"), F.lit(1).alias("size"))
    own = prefix_trie._own(turns, prefix_trie.Scratch(spark), r, prefix_trie.P).filter("conv = 10").orderBy("place").collect()
    want = 0
    for i, row in enumerate(own):
        want = (want * r + ord("k")) % prefix_trie.P
        assert (row.place, int.from_bytes(row.fp, "big")) == (i, want)


def test_odd_tries(spark):
    assert trie(spark, []) == Counter()
    assert trie(spark, [(None, 1, "user", "x")]) == Counter()
    # conversation 3 has h = 5 and no base: it is rebuilt without a turn
    assert zlib.crc32(b"3") % 9 and trie(spark, [(3, 0, "user", "x")]) == plain_trie([(3, 0, "user", "x")])


def test_unequal_sequences_are_never_merged(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in range(40) for t in range(4)]
    with pytest.raises(prefix_trie.CollisionError):
        trie(spark, rows, prime=7)
