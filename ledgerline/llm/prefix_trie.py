"""Prefix trie of conversations that are rebuilt from the head of a base conversation and a tail of their own.

Conversation c takes the first h turns of its base (all if it has fewer, none if it is absent)
and then its own turns after its first h. Neither rebuilt texts nor rebuilt turn lists are
made: a turn is a reference with a digest of its role and text, and a sequence is an element
of the monoid (length, product) with

    (k1, x1) . (k2, x2) = (k1 + k2, x1 * R^k2 + x2)   mod P

where a turn is (1, its digest mod P). Prefix products come from one ordered pass: turns are
range-partitioned by (conversation, turn), each task streams its part, and a run that goes on
from the part before is multiplied by that run's product (at most one carry per partition).
A rebuilt prefix is the base's head product combined with a suffix product. As R has an
inverse, the suffix product is the quotient of two own prefix products, so the fingerprint
of depth d = a + k (a turns from the base, k = j - h of the own j) is

    own(j) + (base(a) - own(h)) * R^k

and the fingerprint of the parent is (fingerprint - turn) / R.

A node is (depth, fingerprint). Fingerprints only group: every group must hold one parent
fingerprint and one turn digest (SHA-256), reached through the members' turn references; by
induction over the depth all its prefixes are equal then. If a group fails, the whole pass
is done again with another R.

Sums over subtrees need no walk: every node is charged to its smallest member, charges are
summed along each conversation from its end, and the members of a node add up what its
subtree holds. The ids that end in a node are joined in ranges by many tasks; only the hash
itself runs over the joined pieces in order, a megabyte at a time.

Ties of one turn number are ordered by the digest of (role, text); null turns come first, null
role or text counts as empty. Rows without a conversation id belong to no conversation and
are left out. Remainders of negative ids are negative, as in SQL. Other columns are ignored. An
empty table gives an empty result, else the root is there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, text_of

P = 2**127 - 1
SEEDS = ("prefix trie", "second try", "third try", "fourth try")
CHUNK = 4096  # depths summed in one window; longer conversations are summed by chunks
PIECE = 1 << 20  # bytes of joined ids
SCAN = "conv long, part int, place long, fp binary, key binary, size int"
MADE = "conv long, depth long, fp binary, up binary, key binary, size int, ends boolean, turn_conv long, turn_place long"
NODE = ["depth", "fp"]


class CollisionError(RuntimeError):
    """Different sequences had one fingerprint with every R."""


def _raw(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _num(b: bytes | None) -> int:
    return int.from_bytes(b or b"", "big")


def _scan(r: int, p: int):
    """Products of each run of a conversation, over the rows of one sorted partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, place, product = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            places, products = [], []
            for c, key in zip(batch.column("conv").to_pylist(), batch.column("key").to_pylist(), strict=True):
                if c != conv:
                    conv, place, product = c, 0, 0
                product = (product * r + _num(key)) % p
                places.append(place), products.append(_raw(product))
                place += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64()), pa.array(products, pa.binary()), batch.column("key"), batch.column("size")],
                names=["conv", "part", "place", "fp", "key", "size"],
            )

    return run


def _carried(carry: dict[int, tuple[int, int, int]], r: int, p: int):
    """Places and products of whole conversations: a part's first run goes on from the carry."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            for i, (c, part) in enumerate(zip(rows["conv"], rows["part"], strict=True)):
                if part in carry and carry[part][0] == c:
                    _, n, product = carry[part]
                    k = rows["place"][i] + 1
                    rows["fp"][i] = _raw((product * pow(r, k, p) + _num(rows["fp"][i])) % p)
                    rows["place"][i] += n
            yield pa.RecordBatch.from_pydict(rows, schema=batch.schema)

    return run


def _made(r: int, p: int):
    """Fingerprints of rebuilt prefixes and of their parents."""
    back = pow(r, -1, p)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [1]
        while len(powers) < 4096:
            powers.append(powers[-1] * r % p)
        for batch in batches:
            rows = batch.to_pydict()
            fps, ups = [], []
            for own, key, base_head, own_head, k in zip(*(rows[c] for c in ("fp", "key", "base_head", "own_head", "k")), strict=True):
                fp = _num(own)
                if base_head != own_head:
                    fp = (fp + (_num(base_head) - _num(own_head)) * (powers[k] if k < len(powers) else pow(r, k, p))) % p
                fps.append(_raw(fp))
                ups.append(_raw((fp - _num(key)) * back % p))
            made = {"conv": rows["conv"], "depth": rows["depth"], "fp": fps, "up": ups} | {c: rows[c] for c in ("key", "size", "ends", "turn_conv", "turn_place")}
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made.values(), kinds, strict=True)], names=list(made))

    return run


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of each node, joined by commas in pieces of bounded size."""
    part, seq, node, held, size = TaskContext.get().partitionId(), 0, None, [], 0

    def piece():
        return pa.RecordBatch.from_pydict(
            {"depth": [node[0]], "fp": [node[1]], "seq": [(part << 40) + seq], "ids": [",".join(held)]},
            schema=pa.schema([("depth", pa.int64()), ("fp", pa.binary()), ("seq", pa.int64()), ("ids", pa.string())]),
        )

    out: list[pa.RecordBatch] = []
    for batch in batches:
        for own in zip(*(batch.column(c).to_pylist() for c in ("depth", "fp", "conv")), strict=True):
            if node != own[:2] or size >= PIECE:
                if held:
                    out.append(piece())
                    seq += 1
                node, held, size = own[:2], [], 0
            held.append(str(own[2]))
            size += len(held[-1]) + 1
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
            out = []
    if held:
        yield piece()


def _hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node, which come in order."""
    schema = pa.schema([("depth", pa.int64()), ("fp", pa.binary()), ("ends_sha256", pa.string())])
    node, state = None, hashlib.sha256()
    for batch in batches:
        done = {"depth": [], "fp": [], "ends_sha256": []}
        for depth, fp, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "fp", "ids")), strict=True):
            if node == (depth, fp):
                state.update(b",")
            else:
                if node:
                    for c, v in zip(done, (*node, state.hexdigest()), strict=True):
                        done[c].append(v)
                node, state = (depth, fp), hashlib.sha256()
            state.update(ids.encode())
        if done["fp"]:
            yield pa.RecordBatch.from_pydict(done, schema=schema)
    if node:
        yield pa.RecordBatch.from_pydict({"depth": [node[0]], "fp": [node[1]], "ends_sha256": [state.hexdigest()]}, schema=schema)


def _own(turns: DataFrame, scratch: Scratch, r: int, p: int) -> DataFrame:
    """(conv, place, fp, key, size): every turn with the product of its conversation up to it."""
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("key")]
    line = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    line = scratch.save(line.select("conv", "key", "size").mapInArrow(_scan(r, p), SCAN), "scan")
    at = F.struct("conv", "place", "fp")
    edges = line.groupBy("part").agg(F.min("conv").alias("first"), F.max(at).alias("last")).orderBy("part").collect()  # one row per partition
    carry: dict[int, tuple[int, int, int]] = {}
    conv, n, product = None, 0, 0
    for e in edges:
        if conv is not None and e["first"] == conv:
            carry[e["part"]] = (conv, n, product)
        k, last = e["last"]["place"] + 1, _num(e["last"]["fp"])
        goes_on = e["part"] in carry and e["last"]["conv"] == conv
        conv, n, product = e["last"]["conv"], k + (n if goes_on else 0), (last + (product * pow(r, k, p) if goes_on else 0)) % p
    if not carry:
        return line.drop("part")
    return scratch.save(line.mapInArrow(_carried(carry, r, p), SCAN).drop("part"), "own")


def _members(own: DataFrame, stride: int, longest: int, r: int, p: int) -> DataFrame:
    """One row per rebuilt conversation and depth, depth 0 included."""
    heads = own.filter(F.col("place") < longest).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("place", "fp", "key", "size"))).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % (longest + 1)).cast("int")
    none = F.array().cast("array<struct<place:bigint,fp:binary,key:binary,size:int>>")
    fp_at = lambda head, n: F.coalesce(F.get(F.col(head)["fp"], F.col(n) - 1), F.lit(bytes(16)))
    info = (
        own.groupBy("conv")
        .agg(F.count("*").alias("own_turns"))
        .withColumn("base", F.col("conv") - F.col("conv") % stride)
        .withColumn("h", h)
        .join(heads.withColumnRenamed("head", "own_part"), "conv", "left")
        .join(heads.select(F.col("conv").alias("base"), "head"), "base", "left")
        .withColumn("head", F.coalesce(F.slice("head", 1, F.greatest("h", F.lit(0))), none))
        .withColumn("a", F.size("head"))
        .withColumn("n", F.col("a") + F.greatest(F.col("own_turns") - F.col("h"), F.lit(0)))
        .withColumn("base_head", fp_at("head", "a"))
        .withColumn("own_head", fp_at("own_part", "h"))
        .drop("own_part")
    )
    zero = F.lit(bytes(16))
    ref = lambda conv, place: [F.col(conv).alias("turn_conv"), F.col(place).alias("turn_place")]
    head = info.select("conv", "n", "base", F.explode("head").alias("t")).select(
        "conv",
        (F.col("t.place") + 1).alias("depth"),
        "t.fp",
        "t.key",
        "t.size",
        zero.alias("base_head"),
        zero.alias("own_head"),
        F.lit(0).cast("long").alias("k"),
        (F.col("t.place") + 1 == F.col("n")).alias("ends"),
        *ref("base", "t.place"),
    )
    k = F.col("place") + 1 - F.col("h")
    tail = (
        own.join(info.drop("head", "base"), "conv")
        .filter(F.col("place") >= F.col("h"))
        .select("conv", (F.col("a") + k).alias("depth"), "fp", "key", "size", "base_head", "own_head", k.alias("k"), (F.col("a") + k == F.col("n")).alias("ends"), *ref("conv", "place"))
    )
    made = head.unionByName(tail).mapInArrow(_made(r, p), MADE)
    root = info.select("conv", F.lit(0).cast("long").alias("depth"), zero.alias("fp"), F.lit(None).cast("binary").alias("up"), F.lit(b"").alias("key"), F.lit(0).alias("size"), (F.col("n") == 0).alias("ends"), F.lit(None).cast("long").alias("turn_conv"), F.lit(None).cast("long").alias("turn_place"))
    return made.unionByName(root)


def _from_the_end(charged: DataFrame, columns: list[str]) -> DataFrame:
    """Replaces the columns by their sums over the own and all deeper rows of the conversation."""
    chunk = F.floor(F.col("depth") / CHUNK)
    rows = charged.withColumn("chunk", chunk)
    inner = Window.partitionBy("conv", "chunk").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(*[c for c in rows.columns if c not in columns], *[F.sum(c).over(inner).alias(c) for c in columns])
    # only conversations beyond a chunk have rows here
    far = charged.filter(F.col("depth") >= CHUNK).groupBy("conv", chunk.alias("chunk")).agg(*[F.sum(c).alias(c) for c in columns])
    outer = Window.partitionBy("conv").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, 0)
    far = far.select("conv", (F.col("chunk") - 1).alias("chunk"), *[F.sum(c).over(outer).alias(f"far_{c}") for c in columns])
    rows = rows.join(far, ["conv", "chunk"], "left")
    return rows.select(*[c for c in charged.columns if c not in columns], *[(F.col(c) + F.coalesce(F.col(f"far_{c}"), F.lit(0))).alias(c) for c in columns])


def _ends(members: DataFrame) -> DataFrame:
    order = ["depth", "fp", "conv"]
    ended = members.filter("ends").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ended.mapInArrow(_pieces, "depth long, fp binary, seq long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions("depth", "fp", "seq").mapInArrow(_hashes, "depth long, fp binary, ends_sha256 string")


def nodes(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    stride: int = 5,
    longest: int = 8,
    prime: int = P,
) -> DataFrame:
    """One row per trie node, with the reference (conversation, place) to its last turn.

    The base of c is c - c % stride; h is crc32(decimal c) % (longest + 1).
    """
    scratch = Scratch(conversations.sparkSession)
    name: Column = text_of(role)
    said = text_of(text)
    turns = conversations.filter(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name, said).cast("binary"), 256)).alias("key"),
        F.octet_length(said).alias("size"),
    )
    for seed in SEEDS:
        r = 2 + int.from_bytes(hashlib.sha256(seed.encode()).digest(), "big") % (prime - 2)
        members = scratch.save(_members(_own(turns, scratch, r, prime), stride, longest, r, prime), "members")
        groups = scratch.save(
            members.groupBy(*NODE).agg(
                F.count("*").alias("n_convs"),
                F.min(F.struct("conv", "turn_conv", "turn_place")).alias("least"),
                F.min("up").alias("up"),
                F.min("size").cast("long").alias("size"),
                (F.min("up").eqNullSafe(F.max("up")) & (F.min("key") == F.max("key"))).alias("same"),
            ),
            "groups",
        )
        if groups.filter(~F.col("same")).isEmpty():
            break
    else:
        raise CollisionError("different sequences share a fingerprint; take a larger prime")
    groups = groups.select(*NODE, F.col("least.conv").alias("conv"), "least.turn_conv", "least.turn_place", "up", "size", "n_convs")
    below = groups.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("fp")).agg(F.count("*").alias("n_children"))
    tree = scratch.save(groups.join(below, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "tree")
    charge = tree.select(
        "conv",
        "depth",
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
    ).filter("saved_tokens > 0 or n_leaves > 0")
    zero = F.lit(0).cast("long")
    charged = members.select("conv", *NODE).join(charge, ["conv", "depth"], "left").withColumns({c: F.coalesce(c, zero) for c in ("saved_tokens", "n_leaves")})
    sums = _from_the_end(charged, ["saved_tokens", "n_leaves"]).groupBy(*NODE).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    parents = tree.select((F.col("depth") + 1).alias("depth"), F.col("fp").alias("up"), F.col("conv").alias("parent_conv_id"))
    return (
        tree.join(sums, NODE)
        .join(_ends(members), NODE, "left")
        .join(parents, ["depth", "up"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
            "turn_conv",
            "turn_place",
            F.lower(F.hex("fp")).alias("fingerprint"),
        )
    )
