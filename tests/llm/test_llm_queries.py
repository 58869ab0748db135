"""The registered corpus queries: against their SQL where there is one, and the pipeline against a plain version."""

import hashlib
import re
import struct
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
import xxhash

import compare
import corpus_pipeline
from ledgerline.llm import byte_bpe, queries
from tests.llm.test_llm_operators import brute_lines

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    assert got or name == "op10_benchmark_windows"
    if name in queries.CHECKS:
        con = duckdb.connect()
        for t in compare.TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        cur = con.execute(queries.CHECKS[name])
        cols = [c[0] for c in cur.description]
        assert sorted(cols) == sorted(df.columns)
        assert compare.rows_of(df.columns, got) == compare.rows_of(cols, cur.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    kept = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == kept and 0 < len(kept) <= 200


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints):
    """Members of one group for each index, by following links until nothing is new."""
    left, groups = set(range(len(prints))), []
    while left:
        group, new = set(), {min(left)}
        while new:
            group |= new
            new = {j for j in left - group if any((prints[i] ^ prints[j]).bit_count() <= 3 for i in new)}
        groups.append(group)
        left -= group
    return groups


def plain_best(words, item, k=5):
    """Largest weighted Jaccard of a window of the item's length; a step of the window changes two counts."""
    k, n = min(k, len(item)), min(len(item), len(words))
    grams = lambda w: [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
    want, all_of, size = Counter(grams(item)), grams(words), n - k + 1
    if size < 1 or not want.keys() & set(all_of):
        return 0
    have, best = Counter(all_of[:size]), 0
    common = sum((have & want).values())
    for at in range(len(all_of) - size + 1):
        if at:
            old, new = all_of[at - 1], all_of[at + size - 1]
            common -= have[old] <= want[old]
            have[old] -= 1
            have[new] += 1
            common += have[new] <= want[new]
        best = max(best, common / (size + want.total() - common))
    return best


def test_fingerprints_against_their_definition(spark):
    got = {r.doc_id: r.fingerprint for r in queries.QUERIES["op3_simhash"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert got == {r.doc_id: f"{plain_fingerprint(r.text or ''):016x}" for r in docs}


def test_pipeline_against_a_plain_version(spark):
    """Toxicity by op6's own labels (its score has no plain form), the other four stages anew."""
    toxic = {r.doc_id for r in queries.QUERIES["op6_toxicity"](spark, SF).collect() if r.predicted == 1}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.doc_id not in toxic}
    cut = brute_lines(texts, 50)
    texts = {i: t for i, (t, gone) in cut.items() if not gone or re.search(r"[^\x20\x09-\x0D]", t)}
    assert toxic and any(gone for _, gone in cut.values())
    ids = sorted(texts)
    firsts = [ids[min(g)] for g in plain_groups([plain_fingerprint(texts[i]) for i in ids])]
    assert len(firsts) < len(ids)
    words_of = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = [w for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if (w := words_of(r.text))]
    clean = [i for i in firsts if all(plain_best(words_of(texts[i]), item) < 0.8 for item in items)]
    ranks = byte_bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for i in clean:
        tokens = enc.encode_ordinary(texts[i])
        want.add((i, len(tokens), hashlib.sha256(struct.pack(f"<{len(tokens)}I", *tokens)).hexdigest(), hashlib.sha256(texts[i].encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
