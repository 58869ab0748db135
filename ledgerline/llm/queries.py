"""The registered queries over the corpus tables, and their SQL checks."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    byte_bpe,
    decontaminate,
    fim,
    line_runs,
    pii,
    prefix_trie,
    secrets,
    sharding,
    simhash,
    toxicity,
    url_cascade,
    vptree,
    warc,
)
from ledgerline.llm.common import Query, Scratch, table

VOCABULARY = "byte_bpe_50k.tiktoken"

# The rules of the url filter.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

# Factor of the nearest-neighbour search: README gives the recall and the share of products for several.
NEAR = 6.0

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return register


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def n(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(secrets.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


OP2_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT doc_id, generate_subscripts(a, 1) AS n, unnest(a) AS line FROM d),
w AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM l),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY n) AS upto FROM w),
e AS (SELECT x.doc_id, x.n, min(y.n) AS last FROM c x JOIN c y
      ON x.doc_id = y.doc_id AND y.n >= x.n AND y.upto - x.upto + x.w >= 50 AND y.upto - y.w - x.upto + x.w < 50
      GROUP BY ALL),
b AS (SELECT y.doc_id, max(x.n) AS n, y.n AS last FROM c y JOIN c x
      ON x.doc_id = y.doc_id AND y.n >= x.n AND y.upto - x.upto + x.w >= 50 AND y.upto - x.upto < 50
      GROUP BY y.doc_id, y.n),
r AS (SELECT r.doc_id, r.n, r.last, list_slice(a, r.n, r.last) AS run
      FROM (SELECT * FROM e UNION SELECT * FROM b) r JOIN d USING (doc_id)),
f AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, n) AS copy FROM r),
x AS (SELECT DISTINCT doc_id, unnest(generate_series(n, last)) AS n FROM f WHERE copy > 1),
k AS (SELECT c.doc_id, count(*) AS n_lines, count(x.n) AS n_deleted,
             coalesce(string_agg(c.line, chr(10) ORDER BY c.n) FILTER (x.n IS NULL), '') AS kept
      FROM c LEFT JOIN x USING (doc_id, n) GROUP BY c.doc_id)
SELECT doc_id, n_lines, n_deleted, sha256(kept) AS kept_sha256 FROM k
"""


@query("op2_line_runs", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_runs.without_copies(table(spark, sf_dir, "documents"), min_words=50)
    return out.select("_row.doc_id", "n_lines", "n_deleted", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


OP4_SQL = r"""
WITH p AS (SELECT page_id, regexp_extract(coalesce(html, ''), '<title>([^<]*)</title>', 1) AS title,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages),
h AS (SELECT page_id, title, translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(kind, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
f AS (SELECT h.page_id, max({'n': length(r.host || r.path), 'rule': r.host || r.path, 'kind': r.kind}) AS fit
      FROM h JOIN r ON starts_with(h.path, r.path) AND (h.host = r.host OR ends_with(h.host, '.' || r.host)) GROUP BY h.page_id),
-- hosts of whose pages a third bears titles that four hosts bear
t AS (SELECT title FROM h WHERE title <> '' AND host <> '' GROUP BY title HAVING count(DISTINCT host) >= 4),
l AS (SELECT host FROM h WHERE host <> '' GROUP BY host HAVING 3 * count(*) FILTER (title IN (FROM t)) >= count(*))
SELECT h.page_id, h.host, h.path, fit.rule AS rule,
       coalesce(fit.kind, CASE WHEN h.host IN (FROM l) THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN f USING (page_id)
"""


@query("op4_url_cascade", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_cascade.judge(pages, RULES, url_cascade.mirrors(pages, min_hosts=4, one_in=3))


@query("op5_contextual_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(table(spark, sf_dir, "documents"))

    def n(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        n(0).alias("n_email"),
        n(1).alias("n_ip"),
        n(2).alias("n_card"),
        n(3).alias("n_phone"),
        F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), fold=5))


@query("op7_warc_revisits")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark).root}/warc"
    warc.write(table(spark, sf_dir, "pages"), path, min_bytes=100)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return byte_bpe.digests(byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


@query("op8_vantage_points")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=NEAR)


@query("op10_benchmark_windows")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_similarity=0.8)


# crc32 of a list of bytes: the table of 256 remainders, then one fold.
CRC = r"""
t AS (SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
      FROM (SELECT unnest(range(256)) AS i))"""

OP11_SQL = (
    r"""
WITH RECURSIVE """
    + CRC
    + r""",
b AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size FROM documents),
h AS (SELECT text, hex(encode(text)) AS h FROM (SELECT DISTINCT text FROM b)),
c AS (SELECT text, xor(4294967295, list_reduce([4294967295] || list_transform(range(0, strlen(h), 2), lambda i: ('0x' || substr(h, i + 1, 2))::BIGINT),
             lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS crc FROM h, t),
g AS (SELECT text, min(doc_id) AS first, sum(size)::BIGINT AS bytes FROM b GROUP BY text),
e AS (SELECT text, bytes, sum(bytes) OVER (ORDER BY first)::BIGINT AS e FROM g),
n AS (SELECT max(e) AS total, max(bytes) AS largest, (max(e) + 7) // 8 AS fair FROM e),
-- one greedy step a row; when a capacity is decided, the next one starts at 0
s AS (SELECT greatest(fair, largest) AS lo, fair + largest AS hi, 0 AS step, 0::BIGINT AS at FROM n
      UNION ALL
      SELECT CASE WHEN bad THEN mid + 1 ELSE lo END, CASE WHEN good THEN mid ELSE hi END, CASE WHEN good OR bad THEN 0 ELSE step + 1 END, CASE WHEN good OR bad THEN 0 ELSE next END
      FROM (SELECT *, next = total AS good, next < total AND step = 7 AS bad
            FROM (SELECT lo, hi, step, (lo + hi) // 2 AS mid, coalesce(max(e), s.at) AS next, total FROM s JOIN n ON lo < hi LEFT JOIN e ON e.e <= s.at + (lo + hi) // 2
                  GROUP BY lo, hi, step, s.at, total))),
cap AS (SELECT min(hi) AS cap FROM s WHERE lo = hi),
r AS (SELECT 8 AS i, total AS at FROM n UNION ALL SELECT i - 1, CASE WHEN r.at - cap <= 0 THEN 0 ELSE min(e.e) END FROM r, cap, e WHERE i > 1 AND e.e >= r.at - cap GROUP BY i, r.at, cap),
f AS (SELECT 0 AS i, 0::BIGINT AS at
      UNION ALL
      SELECT f.i + 1, greatest(r.at, coalesce(max(e.e) FILTER (e.e <= f.at + least(cap, (total - f.at + 7 - f.i) // (8 - f.i))), f.at), coalesce(min(e.e) FILTER (e.e > f.at), f.at))
      FROM f JOIN r ON r.i = f.i + 1 AND f.i < 7 JOIN n ON true JOIN cap ON true JOIN e ON true GROUP BY f.i, f.at, r.at),
o AS (SELECT text, e, (SELECT count(*) FROM f WHERE f.i > 0 AND f.at < e.e) AS shard FROM e)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY e, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM b JOIN o USING (text) JOIN c USING (text)
"""
)


@query("op11_sharding", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(table(spark, sf_dir, "documents"), shards=8, keep=["doc_id"])
    return out.select("_row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
n AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                  WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM n),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return out.select(
        "_row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP13_SQL = (
    r"""
WITH """
    + CRC
    + r""",
o AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, own, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
             lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1]))) % 9 AS h FROM o, t),
m AS (SELECT a.c, coalesce(b.own[:a.h], []) || a.own[a.h + 1:] AS turns FROM h a LEFT JOIN o b ON b.c = a.c - a.c % 5),
x AS (SELECT c, unnest(range(len(turns) + 1)) AS depth, turns FROM m),
p AS (SELECT c, depth, turns[:depth] AS path, depth = len(turns) AS ends FROM x),
n AS (SELECT depth, path, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ids FROM p GROUP BY depth, path),
k AS (SELECT n.*, u.conv_id AS parent_conv_id, (n_convs - 1) * CASE WHEN n.depth = 0 THEN 0 ELSE strlen(n.path[-1].t) END AS w
      FROM n LEFT JOIN (SELECT depth + 1 AS depth, path AS up, conv_id FROM n) u ON u.depth = n.depth AND u.up = n.path[:n.depth - 1]),
c AS (SELECT depth - 1 AS depth, path[:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
f AS (SELECT k.*, coalesce(n_children, 0) AS n_children FROM k LEFT JOIN c USING (depth, path)),
s AS (SELECT path[:d] AS path, d AS depth, sum(w)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(depth + 1)) AS d FROM f) GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ids) AS ends_sha256 FROM f JOIN s USING (depth, path)
"""
)


@query("op13_prefix_trie", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(table(spark, sf_dir, "conversations")).drop("turn_conv", "turn_place", "fingerprint")
