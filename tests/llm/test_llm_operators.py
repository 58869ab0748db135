"""The corpus operations against plain versions, and on odd inputs."""

import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, decontaminate, line_runs, pii, queries, secrets, simhash, toxicity, url_cascade, vptree, warc

ODD = [(1, None), (2, ""), (3, " \n "), (None, "a b c"), (4, "same text here"), (4, "same text here"), (5, "same text here"), (6, "z" * 70000), (7, "été 😀 " * 300)]


def texts(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    return df.select("*", F.lit(1).alias("_id"), F.lit("x").alias("fp"), F.lit(2).alias("rank")) if extra else df


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_bpe_equals_the_library(spark, ranks):
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = ODD + [(8, "don't 's  \x85\x1c x　 ٣½\n\n b" * 5), (9, "<|endoftext|>"), (10, "ab" * 900)]
    out = byte_bpe.digests(byte_bpe.round_trip(texts(spark, rows), ranks, public_tokenizers.PATTERN)).collect()
    want = Counter()
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(b"".join(struct.pack("<I", x) for x in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in out) == want
    coded = byte_bpe.encode(texts(spark, rows), ranks, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.bytes).decode() for r in byte_bpe.decode(coded, ranks, public_tokenizers.PATTERN).collect()}
    assert back[7] == ODD[-1][1] and back[1] == ""


def test_secrets(spark):
    rnd = random.Random(1)
    key = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60))
    prose = " ".join("".join(rnd.choice(["an", "the", "ou", "st"]) for _ in range(12)) for _ in range(300))
    rows = ODD + [(20, f"é PASSWORD : 'abcdef' token=abc AKIA{'Z' * 16} {'0a' * 13} {key} {prose}"), (21, "password:token:abcdefgh")]
    got = {r.doc_id: (r.b, r.s) for r in secrets.scan(texts(spark, rows)).select("doc_id", secrets.written(F.col("base")).alias("b"), secrets.written(F.col("spans")).alias("s")).collect()}
    assert got[20][0] == "assign:2:20,access:32:52,hex:53:79"
    assert got[20][1] == got[20][0] + ",random:80:140", "a random token, but no long word"
    assert got[21] == ("", "") and got[1] == ("", "")
    assert secrets.scan(texts(spark, [])).count() == 0


def random_tokens(rnd, n):
    """Random upper hex of 32 and 64 symbols, base 32, mixed hex, UUIDs of either case, URL-safe base 64."""
    for _ in range(n):
        lower = "".join(rnd.choice("0123456789abcdef") for _ in range(64))
        uuid = f"{lower[:8]}-{lower[8:12]}-4{lower[13:16]}-a{lower[17:20]}-{lower[20:32]}"
        yield from (lower[:32].upper(), lower.upper(), uuid, uuid.upper(), "".join(rnd.choice([c, c.upper()]) for c in lower[:40]))
        yield "".join(rnd.choice(secrets.ALPHABETS["BASE32"]) for _ in range(52))
        yield "".join(rnd.choice(secrets.ALPHABETS["base62"] + "-_") for _ in range(48))


def test_random_tokens_of_every_encoding_pass_the_battery():
    lost = sum(min(secrets.battery(token)[2:]) < 0.001 for token in random_tokens(random.Random(11), 300))
    assert lost <= 0.01 * 7 * 300, "three tests at 0.001 each"
    assert min(secrets.battery("-" * 30)[2:]) == 1.0 and min(secrets.battery("the-same-word-and-the-same-word-and-the-same")[2:]) < 0.001


def test_secrets_of_every_encoding(spark):
    rnd = random.Random(12)
    prose = " ".join("".join(rnd.choice(["an", "the", "ou", "st"]) for _ in range(12)) for _ in range(300))
    rows = [(i, f"{token} é {prose[:400]}") for i, token in enumerate(random_tokens(rnd, 2))]
    got = {r.doc_id: r.s for r in secrets.scan(texts(spark, rows)).select("doc_id", secrets.written(F.col("spans")).alias("s")).collect()}
    assert got == {i: f"random:0:{t.index(' ')}" for i, t in rows}


def test_refused_candidates_count_in_the_step_up(spark):
    rnd = random.Random(13)
    letters, weights = zip(*{"e": 13, "t": 9, "a": 8, "o": 8, "i": 7, "n": 7, "s": 6, "h": 6, "r": 6, "d": 4, "l": 4, "u": 3, "c": 3, "m": 3, "w": 2, "f": 2, "g": 2, "y": 2, "p": 2, "b": 1, "v": 1, "k": 1}.items())
    clean = ["".join(rnd.choices(letters, weights, k=70)) for _ in range(20000)]
    key = "".join(rnd.choice(secrets.ALPHABETS["base64"]) for _ in range(75))
    passed = [t for t in clean if min(secrets.battery(t)[2:]) >= 0.001]
    assert passed, "some clean tokens look random to the battery"
    rows = [(i, " ".join(clean[i * 100 : i * 100 + 100])) for i in range(200)] + [(1000, key)]
    spans = {r.doc_id: r.s for r in secrets.scan(texts(spark, rows)).select("doc_id", secrets.written(F.col("spans")).alias("s")).collect()}
    assert sum(s.count("random") for i, s in spans.items() if i < 1000) <= 1 and spans[1000] == "random:0:75"


def brute_lines(docs, least):
    docs = sorted(docs.items())
    cut = [t.split("\n") for _, t in docs]
    words = [[len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in s] for s in cut]
    places = defaultdict(list)
    for d, s in enumerate(cut):
        for i, x in enumerate(s):
            places[x].append((d, i))
    out = {}
    for d, (doc_id, _) in enumerate(docs):
        gone = set()
        for i, x in enumerate(cut[d]):
            best = 0
            for e, j in places[x]:
                if (e, j) >= (d, i):
                    break
                n = 0
                while i + n < len(cut[d]) and j + n < len(cut[e]) and cut[d][i + n] == cut[e][j + n]:
                    n += 1
                best = max(best, n)
            if best and sum(words[d][i : i + best]) >= least:
                gone |= set(range(i, i + best))
        out[doc_id] = ("\n".join(x for i, x in enumerate(cut[d]) if i not in gone), len(gone))
    return out


def test_line_runs(spark):
    rnd = random.Random(2)
    docs = {i: "\n".join(rnd.choice(["", "a", "b b", "c c c", "d d d d d"]) for _ in range(rnd.randint(0, 25))) for i in range(50)}
    docs |= {60: "\n".join(["a a"] * 40), 61: "\n".join(["a a"] * 40), 62: "\n".join(["x"] * 70)}
    out = line_runs.without_copies(texts(spark, list(docs.items())), min_words=6).select("_row.doc_id", "kept", "n_deleted").collect()
    assert {r.doc_id: (r.kept, r.n_deleted) for r in out} == brute_lines(docs, 6)
    odd = line_runs.without_copies(texts(spark, ODD), min_words=2).select("_row.doc_id", "_row.text", "kept").collect()
    assert len(odd) == len(ODD) and {r.doc_id: r.kept for r in odd}[5] == "" and {r.doc_id: r.kept for r in odd}[4] != ""
    assert line_runs.without_copies(texts(spark, [])).count() == 0


def test_simhash(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(200)]
    rows = list(ODD)
    for i in range(40):
        words = [rnd.choice(vocabulary) for _ in range(300)]
        for c in range(4):
            rows.append((100 + 10 * i + c, " ".join(words).upper() if c % 2 else "\t".join(words)))
            words[rnd.randrange(300)] = "new"
    out = simhash.near_duplicates(texts(spark, rows), part_size=8).collect()
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    want = Counter((d, f"{prints[i]:016x}", min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))
    assert Counter(tuple(r) for r in out) == want
    kept = simhash.keep_one(texts(spark, rows)).collect()
    assert len(kept) == len(least) and set(kept[0].asDict()) == {"doc_id", "text", "_id", "fp", "rank"}
    assert simhash.near_duplicates(texts(spark, [])).count() == 0


def test_bit_slices_for_other_radii():
    rnd = np.random.default_rng(4)
    fps = rnd.integers(0, 1 << 20, 300, dtype=np.uint64)
    i = np.arange(300)
    for radius in (0, 1, 3, 6):
        a, b = simhash.links_of(fps, i + 1, np.full(300, 300), radius)
        want = {(x, y) for x in range(300) for y in range(x + 1, 300) if int(fps[x] ^ fps[y]).bit_count() <= radius}
        assert set(zip(a.tolist(), b.tolist())) == want


def test_url_cascade(spark):
    rows = [(1, None), (2, ""), (3, "foo"), (4, "http://A.Example.NET/en/x?y=/de/"), (5, "http://net"), (6, "http://net/"), (7, "x://xnet/"), (8, "http://a.b.net#/"), (9, "http://bad.org/x"), (9, "http://bad.org/x"), (10, "http://a.org/fr/")]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING").withColumn("host", F.lit(0)).withColumn("key", F.lit(1))
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("allow", "org", "/fr/")]
    listed = spark.createDataFrame([("bad.org",), ("absent.org",)], "key STRING")
    for rules_now, want_rule in ((rules, "net/"), ([], None)):
        got = {r.page_id: r for r in url_cascade.judge(pages, rules_now, listed).collect()}
        assert got[9].verdict == "block" and got[9].rule is None and got[6].rule == want_rule
        assert got[5].verdict == "allow" and (got[1].host, got[1].path) == ("", "")
    got = url_cascade.judge(pages, rules, listed).collect()
    assert {r.page_id: r.rule for r in got}[4] == "example.net/en/" and len(got) == len(rows)
    assert url_cascade.judge(pages.limit(0), rules, listed).count() == 0


def test_cascade_is_exact(spark):
    from ledgerline.llm.common import Scratch

    universe = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    made = url_cascade.cascades(universe.filter("xxhash64(key) % 7 = 0"), universe, Scratch(spark), "t")
    assert len(made.parts) == 1 and len(made.parts[0].levels) > 1
    assert universe.filter(made.has(F.col("key")) != F.expr("xxhash64(key) % 7 = 0")).count() == 0


def test_lists_beyond_a_filter_are_split(spark):
    hosts = [f"h{i}.org" for i in range(300)]
    listed = spark.createDataFrame([(h,) for i, h in enumerate(hosts) if i % 3 == 0], "key STRING")
    rules = [("block", f"x{i}.net", "/") for i in range(40)]
    urls = [f"http://{h}/p" for h in hosts] + [f"http://a.x{i}.net/" for i in range(60)] + [None, ""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id BIGINT, url STRING")
    got = url_cascade.judge(pages, rules, listed, max_bytes=48)
    want = {i: "block" if (i < 300 and i % 3 == 0) or 300 <= i < 340 else "allow" for i in range(len(urls))}
    assert {r.page_id: r.verdict for r in got.collect()} == want and got.count() == len(urls)


def test_mirrors(spark):
    page = "<html><title>{}</title>".format
    rows = [(f"http://h{i}/", page("same")) for i in range(4)] + [("http://H0/a", page("own")), ("http://h0/b", None)]
    rows += [("http://h1/", page(f"t{i}")) for i in range(3)] + [(f"http://g{i}/", page("two")) for i in range(3)] + [(None, page("same")), ("", None)]
    rows += [(f"http://e{i}/", page("")) for i in range(5)]
    pages = spark.createDataFrame(rows, "url STRING, html STRING").withColumn("title", F.lit(1)).withColumn("key", F.lit(1))
    assert sorted(r.key for r in url_cascade.mirrors(pages).collect()) == ["h0", "h2", "h3"], "h1 has one of four, g three hosts, e no title"
    assert url_cascade.mirrors(pages.limit(0)).count() == 0


def brute_pii(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_pii(spark):
    rnd = random.Random(5)
    rows = ODD + [(100 + i, "".join(rnd.choice("aZ09@.-+ ()_%é😀1234\n5") for _ in range(rnd.randint(0, 200)))) for i in range(400)]
    rows += [(1000 + i, "".join(rnd.choice("0123456789. -+") for _ in range(120))) for i in range(200)] + [(2000, "1 " * 20000), (2001, "x@" * 5000), (2002, "1.2.3.4 " * 2000)]
    rows += [(3000 + i, f"my mail: user{i}@x.org is new") for i in range(20)] + [(4000, "my mail: someone@localhost is new")]
    got = defaultdict(list)
    for r in pii.extract(texts(spark, rows)).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, t in rows:
        assert all([tuple(s) for s in r.base] == brute_pii(t or "") for r in got[i]) or i is None
    assert [tuple(s) for s in got[4000][0].spans] == [(9, 4, 26)], "found by its context"
    assert pii.extract(texts(spark, [])).count() == 0


def test_toxicity(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join([f"{rnd.randrange(900)}w" for _ in range(80)] + ([rnd.choice(["vile", "nasty", "awful"]) for _ in range(6)] if i % 3 == 0 else []))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows] + [(None, 1), (1, None)], "doc_id BIGINT, toxic INT")
    docs = texts(spark, rows + [(None, None), (-1, ""), (-2, "vile " * 50000)])
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert sum(got[i].predicted == (i % 3 == 0) for i, _ in rows) >= 0.98 * len(rows) and got[-1].predicted == 0 and 0 <= got[-2].score <= 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got.values())
    none = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}


def test_toxicity_reads_joined_and_unspaced_text(spark):
    rnd = random.Random(14)
    vile = ["vile", "nasty", "awful"]
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 300)]
    rows = [(i, " ".join([f"w{chr(97 + rnd.randrange(26))}{chr(97 + rnd.randrange(26))}" for _ in range(80)] + ([rnd.choice(vile) for _ in range(6)] if i % 3 == 0 else []))) for i in range(400)]
    for i in range(400, 800):
        words = ["".join(rnd.choice(han) for _ in range(3)) for _ in range(40)] + (["罵倒惡語"] * 3 if i % 3 == 0 else [])
        rnd.shuffle(words)
        rows.append((i, "".join(words)))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id BIGINT, toxic INT")
    fresh = [(-1, "-".join(vile * 4)), (-2, "so_" + "/".join(vile * 4)), (-3, "x," + ",".join(vile * 4)), (-4, "x." + ".".join(vile * 4)), (-5, "".join(han[:30]) + "罵倒惡語" * 3 + "".join(han[30:60]))]
    clean = [(-11, "waa-wab_wac/wad,wae"), (-12, "".join(han[100:170])), (-13, "w " * 30)]
    docs = texts(spark, rows + fresh + clean)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert [got[i] for i, _ in fresh] == [1] * 5 and [got[i] for i, _ in clean] == [0] * 3
    assert sum(got[i] == (i % 3 == 0) for i, _ in rows) >= 0.98 * len(rows)


def test_every_letter_is_coded():
    words = [p for m in toxicity.WORDS("vile-nasty_a1b2 हिन्दी สวัสดี漢字かな " + "z" * 20) for p in toxicity.pieces(m.group(), m.lastindex)]
    assert words[:7] == ["vile", "nasty", "a", "1", "b", "2", "हिन्दी"] and words[7:12] == ["สวัสด", "วัสดี", "漢字", "字か", "かな"] and words[12:] == ["z" * 5] * 16
    assert len(set(toxicity.Coder().codes("insulting insulted"))) == 2, "words that share five letters"


@pytest.mark.parametrize("size", [1 << 20, 8])
def test_warc(spark, tmp_path, size):
    same = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 20
    rows = [(5, "http://u/", same), (3, "u\nv", same), (9, None, same), (1, "x", None), (2, "HTTPS://x", ""), (4, "y", "small"), (6, "y", "small"), (None, "z", same), (None, "", same)]
    rows += [(7, "http://q", "w" * 300000), (7, "http://q", "w" * 300000), (8, "q", "w" * 300000), (8, "q", "w" * 300000), (None, None, "n" * 200), (None, None, "n" * 200)]
    rows += [(100 + i, f"http://p/{i}", f"<p>{i % 70}</p>" * 30) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").withColumn("digest", F.lit("x")).withColumn("key", F.lit("x"))
    warc.write(pages, str(tmp_path / "w"), max_bytes=size, gzip=size == 8, per_file=50)
    got = warc.read(spark, str(tmp_path / "w")).collect()
    first = {}
    for i, _, h in rows:
        if i is not None and h and len(h.encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    want = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = h in first and i != first[h]
        want[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, u.replace("\n", " ") if u else None) for i, u, _ in rows)
    warc.write(pages.limit(0), str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).count() == 0


def test_warc_records(spark, tmp_path):
    body = "<p>text</p>" * 20
    rows = [(1, "http://a/", body), (1, "http://a/", body), (2, "http://b/", body), (2, "http://b/", body), (3, None, "short")]
    warc.write(spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING"), str(tmp_path / "w"), date="2026-01-02T03:04:05Z")
    files = [f.read_bytes() for f in (tmp_path / "w").glob("part-*")]
    found = [r for f in files for r in warc.parse(f)]
    ids = [h["warc-record-id"] for h, _ in found]
    assert len(set(ids)) == len(rows) and all(re.fullmatch("<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-8[0-9a-f]{3}-[0-9a-f]{12}>", i) for i in ids)
    assert {h["warc-date"] for h, _ in found} == {"2026-01-02T03:04:05Z"}
    for head, block in found:
        if head["warc-type"] == "revisit":
            assert head["warc-refers-to"] in ids and block == b"" and head["page-id"] == "2"
        elif head["page-id"] == "1":
            assert block.startswith(b"HTTP/1.1 200 OK\r\n") and block.endswith(b"\r\n\r\n" + body.encode())
        else:
            assert block == b"short" and head["warc-target-uri"] == "urn:ledgerline:page:3"
    # an uncompressed record can be read by its offset alone
    at = files[0].rindex(b"WARC/1.1\r\n")
    assert next(warc.parse(files[0][at:]))[0]["warc-record-id"] in ids


def test_warc_payloads_stay(spark):
    """Of rows whose filters are not full, hardly any payload is held for the join."""
    rows = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.concat(F.lit("page "), (F.col("id") % 3000).cast("string")), 20).alias("html"))
    saved = {}

    class Watched(warc.Scratch):
        def save(self, df, name):
            saved[name] = super().save(df, name)
            return saved[name]

    with pytest.MonkeyPatch.context() as m:
        m.setattr(warc, "Scratch", Watched)
        out = warc.resolve(rows)
        assert out.filter("record_type = 'revisit' and refers_to = page_id - 3000").count() == 1000 and out.count() == 4000
        assert saved["held"].count() < 80 and "payload" not in saved["marked"].columns


def test_vantage_points(spark):
    rnd = np.random.default_rng(7)
    vectors = {i: rnd.normal(size=8).astype("f4").tolist() for i in range(600)}
    vectors |= {1000 + i: vectors[3] for i in range(60)}
    rows = list(vectors.items()) + [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [1.0, None]), (2080, []), (None, [1.0] * 8), (20, vectors[20])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").withColumn("dim", F.lit(0))
    ids = np.array(sorted(vectors))
    x = np.array([vectors[int(i)] for i in ids], dtype=float)
    for size, block in ((8192, 4096), (64, 10)):
        got = defaultdict(list)
        for r in vptree.nearest(df, F.col("vec_id") % 20 == 0, k=20, shard_size=size, block_size=block).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.vec_id, r.score))
        assert set(got) == {int(i) for i in ids if i % 20 == 0}
        for q, found in got.items():
            s = vptree.products(np.broadcast_to(np.array(vectors[q], dtype=float), x.shape), x)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:20]
            assert found == [(int(ids[j]), float(s[j])) for j in order]
    assert vptree.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_decontamination(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([3, 40, 60])))) for i in range(20)] + [(90, None), (91, "...")]
    rows = list(ODD)
    for i, t in items[:20]:
        w = t.split()
        if len(w) > 20:
            near = w[:-1] + ["end"]
            rows += [(100 + i, " ".join(rnd.choice(words) for _ in range(50)) + " " + t.upper() + "!"), (200 + i, " ".join(near)), (300 + i, " ".join(w[: len(w) // 2]))]
    docs = texts(spark, rows)
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING").withColumn("similarity", F.lit(0))
    want = {}
    for d, t in rows:
        w = decontaminate.words_of(t or "")
        for i, b in items:
            v = decontaminate.words_of(b or "")
            if v and w:
                k = min(5, len(v))
                n = min(len(v), len(w))
                c = Counter(decontaminate._grams(v, k))
                best = max((decontaminate.Finder._similar(g, c) for s in range(len(w) - n + 1) if (g := decontaminate._grams(w[s : s + n], k))), default=0)
                if best >= 0.8:
                    want[d, i] = best
    for size in (8 << 20, 500):
        got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find(docs, bench, pass_bytes=size).collect()}
        assert got == pytest.approx(want)
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len({d for d, _ in want})
    assert decontaminate.find(docs, bench.limit(0)).count() == 0


def test_decontamination_of_repeated_shingles(spark):
    rnd = random.Random(15)
    items = [(i, [f"w{rnd.randrange(5000)}" for _ in range(200)]) for i in range(12)]
    rows = []
    for i, w in items:
        at = 180 if i % 2 else 90
        rows.append((i, " ".join(w[:at] + ["filler"] * 17 + w[at + 17 :])))
    rows.append((100, " ".join(["filler"] * 400)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id BIGINT, text STRING")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find(texts(spark, rows), bench).collect()}
    assert set(got) == {(i, i) for i, _ in items} and min(got.values()) >= 0.8


def test_recall_with_the_registered_factor(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    all_rows = [(r.vec_id, r.embedding) for r in rows.select("vec_id", "embedding").orderBy("vec_id").collect()]
    ids, x = np.array([i for i, _ in all_rows]), np.array([v for _, v in all_rows], dtype=float)
    got = {(r.query_id, r.vec_id) for r in vptree.nearest(rows, F.col("vec_id") % 20 == 0, k=20, factor=queries.NEAR).collect()}
    want = set()
    for q in np.nonzero(ids % 20 == 0)[0]:
        s = vptree.products(np.broadcast_to(x[q], x.shape), x)
        want |= {(int(ids[q]), int(ids[j])) for j in [j for j in np.lexsort((ids, -s)) if j != q][:20]}
    assert len(got & want) >= 0.9 * len(want)


def test_the_tree_leaves_points_out():
    rnd = np.random.default_rng(2)
    flat = rnd.normal(size=(4000, 2)) @ rnd.normal(size=(2, 16))  # vectors of few dimensions
    flat /= np.linalg.norm(flat, axis=1, keepdims=True)
    tree = vptree.Tree(flat, 1.0)
    point, best = tree.search(flat[:50], 10, 1.0)
    want = np.sort(flat[:50] @ flat.T, axis=1)[:, -10:]
    assert np.allclose(np.sort(best, axis=1), want) and tree.scored < 0.2 * 50 * 4000, "exact, and most products are never computed"
    rows = duckdb.sql("SELECT embedding FROM '/root/testdata/sf0.1/embeddings.parquet' ORDER BY vec_id").fetchall()
    x = np.array([r[0] for r in rows], dtype=float)
    norm2, q = float((x * x).sum(axis=1).max()), x[::20]
    top = np.argsort(-(q @ x.T), axis=1)[:, 1:21]
    found = {}
    for factor in (1.0, queries.NEAR):
        tree = vptree.Tree(x, norm2)
        point, _ = tree.search(q, 21 + vptree.SPARE, factor)
        recall = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(top.tolist(), point.tolist())])
        found[factor] = recall, tree.scored / (len(q) * len(x))
    assert found[1.0][0] == 1 and found[queries.NEAR][0] >= 0.9 and found[queries.NEAR][1] < 0.93


def test_blocks_name_the_candidates(monkeypatch):
    rnd = random.Random(5)
    items = [(i, " ".join(f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([30, 80])))) for i in range(60)]
    near = [" ".join([*t.split()[:-2], "other", "end"]) for _, t in items]
    finder = decontaminate.Finder(items, 0.8, decontaminate.RADIUS)
    found = [{j for j, *_ in f} for f in finder.find_all(near)]
    assert found == [{i} for i in range(60)]
    nothing = np.zeros(0, dtype=np.int64)
    monkeypatch.setattr(decontaminate.Index, "within", lambda self, query: (nothing, nothing, nothing))
    assert not any(finder.find_all(near)), "without the blocks nothing is found"


def test_both_dictionaries_weigh(spark):
    rnd = random.Random(4)
    usual, nice, vile = ([f"{p}{i:02d}x" .translate(str.maketrans("0123456789", "abcdefghij")) for i in range(n)] for p, n in (("u", 60), ("n", 12), ("v", 12)))
    rows = [(i, " ".join(rnd.choice(usual) for _ in range(30)) + " " + " ".join(rnd.sample(vile if i % 3 == 0 else nice, 4))) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id BIGINT, toxic INT")
    model = toxicity.train(texts(spark, rows), labels)
    assert model.toxic and model.ordinary
    meter = toxicity.Meter(model.ordinary, model.toxic)
    a, b, _ = meter.saved(" ".join(vile))
    c, d, _ = meter.saved(" ".join(nice))
    assert a > b and d > c
    right = [(r.predicted == int(r.doc_id % 3 == 0)) for r in toxicity.score(texts(spark, rows), model).filter("held_out").collect()]
    assert len(right) > 80 and all(right)


SPACES = " \t\n\x0b\x0c\r"


def plain_contexts(rows, min_digits=5, rounds=3, min_seeds=3, accept=0.8):
    """Spans found by context, by a walk over the whole graph in plain Python."""
    places = []
    group = r"[0-9()+./-]*[0-9][0-9()+./-]*"
    token = re.compile(rf"(?<![^{SPACES}])[^{SPACES}0-9@]*(?:[0-9][^{SPACES}@]*(?![^{SPACES}])(?: {group}(?![^{SPACES}]))*|[0-9@][^{SPACES}]*)")
    for i, t in set(rows):
        t = t or ""
        base = brute_pii(t)
        spans = [(s, e, True, k) for s, k, e in base]
        for m in token.finditer(t):
            digits = len(re.sub("[^0-9]", "", m.group()))
            if ("@" in m.group() or digits >= min_digits) and not any(s < m.end() and m.start() < e for s, _, e in base):
                spans.append((*m.span(), False, 4))
        places.append((i, t, spans))
    edges, at, times, words = Counter(), [], Counter(), Counter()
    repeats = Counter((i, t or "") for i, t in rows)
    for (_, t), n in repeats.items():
        for w in re.split(f"[{SPACES}]+", t.strip(SPACES)):
            words[w.lower()] += n
    for i, t, spans in places:
        # a kind's neighbours: the words between it and the next match of its own pattern
        for s, e, seed, kind in spans:
            if kind == 4:
                cuts = [m.span() for m in token.finditer(t)]
            else:
                cuts = [m.span() for m in re.finditer([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", r"[0-9](?:[\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"][kind], t)]
            n = cuts.index((s, e))
            before, after = t[cuts[n - 1][1] if n else 0 : s], t[e : cuts[n + 1][0] if n + 1 < len(cuts) else len(t)]
            word = lambda x, j: (re.split(f"[{SPACES}]+", x.strip(SPACES)) or [""])[j].lower()
            patterns = ("L " + word(before, -1), "R " + word(after, 0))
            for p in patterns:
                edges[p, t[s:e].lower(), seed] += 1
                times[p] += repeats[i, t]
            at.append((i, s, e, seed, t[s:e].lower(), patterns))
    form_seed = defaultdict(bool)
    n_of = Counter()
    for (p, f, seed), n in edges.items():
        n_of[p, f] += n
        form_seed[p, f] |= seed
    n_of = {k: min(n, 3) for k, n in n_of.items()}
    score, confidence = {}, {}
    for _ in range(rounds):
        total, weight, seeds = Counter(), Counter(), Counter()
        for (p, f), n in n_of.items():
            total[p] += n * (1_000_000 if form_seed[p, f] else round(score.get(f, 0) * 1_000_000))
            weight[p] += n
            seeds[p] += form_seed[p, f]
        special = lambda p: times[p] / max(times[p], words[p[2:]])
        confidence = {p: total[p] / weight[p] / 1e6 * special(p) if seeds[p] >= min_seeds and len(p) > 2 else 0 for p in weight}
        side = defaultdict(lambda: [0, 0, 0, 0])
        for (p, f), n in n_of.items():
            if not form_seed[p, f]:
                x = side[f]
                x[0 if p[0] == "L" else 2] += n * round(confidence[p] * 1_000_000)
                x[1 if p[0] == "L" else 3] += n
        score = {f: 1 - (1 - (a / b / 1e6 if b else 0)) * (1 - (c / d / 1e6 if d else 0)) for f, (a, b, c, d) in side.items()}
    return {(i, s, e) for i, s, e, seed, f, ps in at if not seed and (max(confidence[p] for p in ps) >= accept or score.get(f, 0) >= accept)}


def test_contexts_equal_the_plain_rounds(spark):
    rnd = random.Random(9)
    names = [f"user{i}@mail{i % 7}.org" for i in range(60)]
    rows = [(i, f"{rnd.choice(['my mail:', 'write to', 'see'])} {rnd.choice(names)} {rnd.choice(['is new', 'now', 'quickly then'])}") for i in range(200)]
    rows += [(500 + i, f"{rnd.choice(['my mail:', 'see', 'room'])} {rnd.choice(['bob@localhost', 'ann@intern', '12345', '555 123 4567', 'x99999'])} {rnd.choice(['is new', 'and more', 'now'])}") for i in range(120)]
    rows += [(700 + i, f"call me at +49 30 {1000000 + i * 37} today") for i in range(40)]
    # the three probes: a free right context, a number in groups, a known identifier elsewhere
    rows += [(900, "my mail: someone@localhost quickly"), (901, "call me at 555 123 4567 today"), (902, "my mail: roe@intern is new"), (903, "unusual roe@intern place"), (904, f"{'z' * 90}1 my mail: {'y' * 500}@localhost rare")]
    rows += [(950 + i, f"room {70000 + i} and more") for i in range(10)]
    rows += [(960 + i, f"see {80000 + i} and more, see it, see that, see this") for i in range(60)] + rows[:30]
    got = {(r.doc_id, s.start, s["end"]) for r in pii.extract(texts(spark, rows)).collect() for s in r.spans if s.kind == 4}
    want = plain_contexts(rows)
    assert got == want
    found = {i for i, _, _ in got}
    assert {900, 901, 902, 904} <= found and not {i for i in found if i >= 950}, "numbers that no sure context has"


def test_long_texts_with_many_tokens(spark):
    """100,000 tokens, half of them base spans, in one text."""
    import time

    rnd = random.Random(3)
    hexes = " ".join("".join(rnd.choice("0123456789abcdef") for _ in range(32)) + (" x-" + "ab1" * 8 if i % 2 else "") for i in range(60000))
    mails = " ".join(f"u{i}@x.org n{i}@h" for i in range(50000))
    t0 = time.perf_counter()
    got = {r.doc_id: (r.b, r.n) for r in secrets.scan(texts(spark, [(1, hexes)])).select("doc_id", F.size("base").alias("b"), F.size("spans").alias("n")).collect()}
    assert got[1][0] == 90000
    t1 = time.perf_counter()
    found = pii.extract(texts(spark, [(1, mails)])).select(F.size("base").alias("b"), F.size("spans").alias("n")).collect()
    assert found[0].b == 50000
    t2 = time.perf_counter()
    assert t1 - t0 < 60 and t2 - t1 < 120, (t1 - t0, t2 - t1)


def test_battery_and_step_up_against_plain_versions():
    rnd = random.Random(12)
    for kind in ("hex", "base62"):
        alphabet = secrets.ALPHABETS[kind]
        for n in (24, 60):
            token = "".join(rnd.choice(alphabet) for _ in range(n)) if kind == "hex" else "Zz0" + "".join(rnd.choice(alphabet) for _ in range(n))
            enc, counts, p_chi, p_runs, p_serial = secrets.battery(token)
            place = {c: i for i, c in enumerate(secrets.ALPHABETS[enc])}
            x, k = [place[c] for c in token], len(place)
            chi = sum((x.count(v) - len(x) / k) ** 2 / (len(x) / k) for v in range(k))
            # exact shuffles and draws in place of the normal forms
            draws = 3000
            sims = [[rnd.randrange(k) for _ in x] for _ in range(draws)]
            share = np.mean([sum((s.count(v) - len(x) / k) ** 2 / (len(x) / k) for v in set(s)) + (k - len(set(s))) * len(x) / k >= chi for s in sims])
            assert abs(share - p_chi) < 0.06 or p_chi == 1.0
            serial = lambda s: abs(sum((a - (k - 1) / 2) * (b - (k - 1) / 2) for a, b in zip(s, s[1:])))
            assert abs(np.mean([serial(s) >= serial(x) for s in sims]) - p_serial) < 0.06
            runs = lambda s: sum((a >= k / 2) != (b >= k / 2) for a, b in zip(s, s[1:]))
            up = sum(v >= k / 2 for v in x)
            order = [k - 1] * up + [0] * (len(x) - up)
            mean, seen = 2 * up * (len(x) - up) / len(x), []
            for _ in range(draws):
                rnd.shuffle(order)
                seen.append(abs(runs(order) - mean) >= abs(runs(x) - mean) - 1e-9)
            assert abs(np.mean(seen) - p_runs) < 0.2
    for _ in range(50):
        ps = [(rnd.randrange(3), rnd.randrange(0, 400)) for _ in range(60)]
        least = secrets.step_up([(c, b, n) for (c, b), n in Counter(ps).items()], 0.05)
        for cls in range(3):
            own = sorted(10 ** (-b * secrets.BIN) for c, b in ps if c == cls)
            passed = [p for i, p in enumerate(own, 1) if p * len(own) <= 0.05 * i]
            kept = [p for p in own if cls in least and p <= 10 ** (-least[cls] * secrets.BIN) * 1.0000001]
            assert len(kept) == (own.index(max(passed)) + own.count(max(passed)) if passed else 0)
