"""WARC archives with revisit records: one response per payload, fresh headers for the rest.

Headers (id, url, digest, size) shuffle to find, for every payload of at least
``min_bytes``, the record with the smallest id; the others become revisits that refer to
it and are written from their headers alone. Payloads stay where they are read: a Bloom
filter of the revisits, with a second one of the responses that pass it by mistake, says
of nearly every row which it is. Only rows that pass both are held and joined by id and
digest, never by digest alone, so copies of one payload don't meet. Filters have at most
``max_bytes``; beyond about 6.7 million revisits they get fuller, and more payloads are
held and joined, with the same result.

Archives are written by Spark's text sink: a row is one record, the line separator is the
blank lines that end a record. So files appear only when their task commits, on any
store. They are not compressed, so that a record can be read by its offset; ``gzip``
makes one gzip stream of each file instead. Records have a date, a target (a URN where
the url is empty), a record id that no other has, and the page's id in a field of their
own; a response to an http url holds an HTTP head of status 200 before the payload.

Reading goes by Content-Length, payloads may hold blank lines or look like headers.
Revisits get size and digest from the response that they refer to, not from their own
headers.

A null payload counts as empty; a null id is written as none, sorts after all others and
is never referred to while an id exists. Rows that repeat id and payload are all
responses, if the id is the smallest; revisits refer to one of them. An empty table gives
an archive without records. Only the named columns are read, other columns may have any
name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bloom
from ledgerline.llm.common import Scratch

END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
NO_URL = "urn:ledgerline:page:"
READ = "page_id bigint, url string, record_type string, refers_to bigint, record string, refers_record string, own_digest string, own_bytes bigint, header_digest string"
PIECE = 1 << 20  # bytes inflated at a time


def _rows(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    return pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))


def _key(page_id: str = "page_id") -> Column:
    return F.concat(F.coalesce(F.col(page_id).cast("string"), F.lit("null")), F.lit(":"), F.col("digest"))


def _urn(name: Column) -> Column:
    """A record id made of a name that no other record has (a UUID of version 8)."""
    h = F.sha2(name.cast("binary"), 256)
    parts = [F.substr(h, F.lit(at), F.lit(n)) for at, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), parts[0], F.lit("-"), parts[1], F.lit("-8"), parts[2], F.lit("-8"), parts[3], F.lit("-"), parts[4])


def headers(rows: DataFrame, min_bytes: int, scratch: Scratch) -> DataFrame:
    """(page_id, url, digest, key, first_id) of every row, written; ``first_id`` is null but for revisits."""
    heads = scratch.save(rows.select("page_id", "url", "digest", F.octet_length("payload").alias("bytes")), "heads")
    # digests with one id need no entry: what is joined are the repeated ones
    first = (
        heads.filter(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"), F.count("*").alias("n"), F.count("page_id").alias("ids"))
        .filter((F.col("first_id") < F.col("last_id")) | ((F.col("ids") < F.col("n")) & (F.col("ids") > 0)))
        .select("digest", "first_id")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return scratch.save(heads.join(first, "digest", "left").select("page_id", "url", "digest", _key().alias("key"), refers.alias("first_id")), "marked")


def resolve(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 100, max_bytes: int = bloom.MAX_BYTES
) -> DataFrame:
    """(page_id, url, payload, digest, record_type, refers_to, record, refers_record): what each row is to be in the archive."""
    scratch = Scratch(pages.sparkSession)
    rows = _rows(pages, page_id, url, payload)
    heads = headers(rows, min_bytes, scratch)
    revisits, others = heads.filter("first_id is not null"), heads.filter("first_id is null")
    twins = others.groupBy("key").count().filter("count > 1")

    def bits(keys: DataFrame, seed: int) -> bloom.Bloom:
        return bloom.build(keys, keys.count(), seed, max_bytes)

    listed = bits(revisits, 1)
    passes = listed.passes(F.col("key"))
    strange = bits(others.filter(passes), 2) if listed.bits else listed
    repeated = bits(twins, 3)
    rows = rows.withColumn("key", _key())
    sure = passes & ~strange.passes(F.col("key"))
    unsure = ~sure & (passes | repeated.passes(F.col("key")))
    # copies of one id and payload are told apart by numbers, which stay as they are once written
    held = scratch.save(rows.filter(unsure).withColumn("_n", F.monotonically_increasing_id()), "held")
    held = held.join(revisits.select("key").distinct(), "key", "left_anti")
    held = held.join(held.groupBy("key").agg(F.min("_n").alias("_first")), "key")
    name = F.when(F.col("_n") > F.col("_first"), F.concat_ws(":", "key", "_n")).otherwise(F.col("key"))

    def responses(part: DataFrame, name: Column) -> DataFrame:
        none = F.lit(None)
        return part.select("page_id", "url", "payload", "digest", F.lit("response").alias("record_type"),
                           none.cast("long").alias("refers_to"), _urn(name).alias("record"), none.cast("string").alias("refers_record"))

    plain = responses(rows.filter(~sure & ~unsure), F.col("key"))
    # a revisit is made of its header alone; nothing refers to it
    again = revisits.select(
        "page_id", "url", F.lit("").alias("payload"), "digest", F.lit("revisit").alias("record_type"), F.col("first_id").alias("refers_to"),
        _urn(F.concat_ws(":", "key", F.lit("again"), F.monotonically_increasing_id())).alias("record"), _urn(_key("first_id")).alias("refers_record"),
    )
    return plain.unionByName(responses(held, name)).unionByName(again)


def records(resolved: DataFrame, date: str | None = None) -> DataFrame:
    """One text column: the whole record but for the two line ends that close it."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("record_type") == "revisit"
    web = F.col("url").rlike("^[Hh][Tt][Tt][Pp][Ss]?://")
    size = F.octet_length("payload")
    http = F.concat(F.lit(HTTP), size, F.lit(END))
    block = F.when(revisit, "").when(web, F.concat(http, F.col("payload"))).otherwise(F.col("payload"))
    length = F.when(revisit, 0).when(web, F.octet_length(http) + size).otherwise(size)
    # a line end within a url would end its header
    target = F.when(F.col("url") == "", F.concat(F.lit(NO_URL), F.coalesce(F.col("page_id").cast("string"), F.lit("")))).otherwise(
        F.regexp_replace("url", "[\r\n]", " ")
    )

    def line(name: str, value: Column | str, only: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value)
        return text if only is None else F.when(only, text)

    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<"), "record", F.lit(">"))),
        line("WARC-Date", date or now),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("WARC-Refers-To", F.concat(F.lit("<"), "refers_record", F.lit(">")), revisit),
        line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", revisit),
        line("Content-Type", F.when(web, "application/http; msgtype=response").otherwise("text/html; charset=utf-8"), ~revisit),
        line("Page-ID", F.col("page_id").cast("string"), F.col("page_id").isNotNull()),
        line("Refers-To-Page-ID", F.col("refers_to").cast("string"), revisit),
        line("Content-Length", length.cast("string")),
    ]
    return resolved.select(F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block).alias("value"))


def write(pages: DataFrame, path: str, date: str | None = None, per_file: int = 1000, gzip: bool = False, **columns) -> None:
    """Writes the archives, ``per_file`` records each; nothing is left visible by a task that fails."""
    out = records(resolve(pages, **columns), date)
    sink = out.write.option("lineSep", END).option("maxRecordsPerFile", per_file).option("zlib.compress.level", "BEST_SPEED")
    sink.option("compression", "gzip" if gzip else "none").text(path)


def _pieces(data: bytes) -> Iterator[bytes]:
    """The archive's bytes, inflated piece by piece; gzip members may follow one another."""
    if data[:2] != b"\x1f\x8b":
        for at in range(0, len(data), PIECE):
            yield data[at : at + PIECE]
        return
    while data:
        z = zlib.decompressobj(31)
        rest = data
        while rest and not z.eof:
            yield z.decompress(rest, PIECE)
            rest = z.unconsumed_tail
        yield z.flush()
        data = z.unused_data


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of one archive; a record that ends early is an error."""
    pieces, buf = _pieces(data), bytearray()

    def fill(n: int) -> bool:
        while len(buf) < n:
            more = next(pieces, None)
            if more is None:
                return False
            buf.extend(more)
        return True

    while True:
        while (cut := buf.find(b"\r\n\r\n")) < 0:
            if not fill(len(buf) + 1):
                if buf.strip():
                    raise ValueError("an archive ends within a header")
                return
        lines = bytes(buf[:cut]).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        size = int(head["content-length"])
        if not fill(cut + 4 + size + 4):
            raise ValueError("an archive ends within a record")
        yield head, bytes(buf[cut + 4 : cut + 4 + size])
        del buf[: cut + 4 + size + 4]


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _read_files(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split(" ")[0] for f in READ.split(", ")]
    for frame in frames:
        for data in frame["content"]:
            rows = []
            for head, block in parse(data):
                if head.get("content-type", "").startswith("application/http"):
                    block = block.partition(b"\r\n\r\n")[2]
                digest = hashlib.sha256(block).hexdigest()
                kind, page, target = head["warc-type"], _number(head.get("page-id")), head.get("warc-target-uri")
                if kind == "response" and head["warc-payload-digest"] != f"sha256:{digest}":
                    raise ValueError(f"the payload of {head['warc-record-id']} has another digest than its header says")
                rows.append(
                    (
                        page,
                        None if target == f"{NO_URL}{'' if page is None else page}" else target,
                        kind,
                        _number(head.get("refers-to-page-id")),
                        head["warc-record-id"],
                        head.get("warc-refers-to"),
                        digest if kind == "response" else None,
                        len(block) if kind == "response" else None,
                        head["warc-payload-digest"].removeprefix("sha256:"),
                    )
                )
                if len(rows) == 5000:
                    yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64", "own_bytes": "Int64"})
                    rows = []
            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64", "own_bytes": "Int64"})


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) from written archives."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    # kept as a table: each archive is inflated once, though both kinds of record are looked at
    rows = Scratch(spark).save(files.mapInPandas(_read_files, READ), "records")
    revisits = rows.filter("record_type = 'revisit'").select("page_id", "url", "refers_to", "refers_record", "header_digest")
    responses = rows.filter("record_type = 'response'")
    # a response is known by record id and digest, so that archives that repeat an id can't multiply rows
    known = responses.groupBy(F.col("record").alias("refers_record"), F.col("own_digest").alias("header_digest")).agg(
        F.max("own_bytes").alias("payload_bytes")
    )
    followed = revisits.join(known, ["refers_record", "header_digest"], "left").select(
        "page_id", "url", "payload_bytes",
        F.when(F.col("payload_bytes").isNotNull(), F.col("header_digest")).alias("payload_digest"),
        F.lit("revisit").alias("record_type"), "refers_to",
    )
    plain = responses.select(
        "page_id", "url", F.col("own_bytes").alias("payload_bytes"), F.col("own_digest").alias("payload_digest"), "record_type", "refers_to"
    )
    return plain.unionByName(followed)
