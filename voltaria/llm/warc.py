"""WARC archives: written by Spark's writer, read back by its reader, assembled into one row per capture.

A capture is three records: a request, a response (or a revisit that refers to one by its record id) and metadata;
request and metadata name the response in WARC-Concurrent-To, and the metadata hold the page's id. The text writer ends every row with a line separator; with CR LF CR LF for
that, a row that holds a record's header and block is a WARC record, and files land on any file system that Spark
writes to. Reading uses the same separator: a task joins the pieces of its files again and cuts records by their
Content-Length alone, so a payload may hold separators or whole records. A task holds one record at a time. Compressed
files are read whole by one task each; files that Spark would split are dealt by file first and read in order. The
writer's files have one gzip member each, which every reader of archives takes, but none can start in the middle.

Record ids number the rows of the input, which are written once with their numbers: what a revisit refers to has the same
number whenever a task is run again.

Edge cases: a null html is an empty payload; payloads under ``least`` bytes are never revisits; of equal payloads every
row with the smallest page_id is a response (repeated rows too, each its own capture); a null page_id is kept as null and
counts as greater than any other; a null url is written as none; other columns are not written; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, cut_lineage, partitions, shared_path, table

CRLF, END = "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-31T00:00:00Z"


def _record(kind: str, page: Column, copy: Column, headers: list[tuple[str, Column | str | None]], block: Column, date: str) -> Column:
    """One record as text, without the separator that ends it."""
    lines: list[Column] = [F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.lit(kind), F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Record-ID: "), _urn(page, kind, copy)]
    for name, value in headers:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(f"{CRLF}{name}: "), value), F.lit("")))
    return F.concat(*lines, F.lit(f"{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def _urn(page: Column, kind: str, copy: Column) -> Column:
    return F.concat(F.lit("<urn:capture:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(f":{kind}:"), copy.cast("string"), F.lit(">"))


def write_warc(pages: DataFrame, path: str, least: int = 100, date: str = DATE, compression: str = "gzip") -> None:
    """Writes request, response or revisit, and metadata records of (page_id, url, html) as WARC files under ``path``."""
    body = F.coalesce("html", F.lit(""))
    p = pages.select("page_id", F.regexp_replace("url", "[\r\n]+", " ").alias("url"), body.alias("html"))
    p = p.withColumn("bytes", F.octet_length("html")).withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    numbered = shared_path(pages.sparkSession, "pages")
    p.withColumn("copy", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(numbered)
    p = pages.sparkSession.read.parquet(numbered)
    # digests with copies alone, checkpointed, so that the join below is one whose hot keys are split
    firsts = p.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "copy")).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    firsts = cut_lineage(firsts.select("digest", F.col("first.page_id").alias("first"), F.col("first.copy").alias("first_copy")))
    p = p.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    p = p.withColumn("again", F.coalesce(again, F.lit(False)))

    page, copy, url = F.col("page_id"), F.col("copy"), F.col("url")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    http = "application/http; msgtype="
    kind = F.when(F.col("again"), "revisit").otherwise("response")
    to = F.when(F.col("again"), _urn(page, "revisit", copy)).otherwise(_urn(page, "response", copy))
    uri = ("WARC-Target-URI", url)
    response = _record("response", page, copy, [uri, ("WARC-Payload-Digest", digest), ("Content-Type", http + "response")], F.concat(head, F.col("html")), date)
    refers = [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(F.col("first"), "response", F.col("first_copy")))]
    revisit = _record("revisit", page, copy, [uri, ("WARC-Payload-Digest", digest), *refers, ("Content-Type", http + "response")], head, date)
    request = _record("request", page, copy, [uri, ("WARC-Concurrent-To", to), ("Content-Type", http + "request")], F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(f" HTTP/1.1{END}")), date)
    metadata = _record("metadata", page, copy, [uri, ("WARC-Concurrent-To", to), ("Content-Type", "application/warc-fields")], F.concat(F.coalesce(F.concat(F.lit("pageId: "), page.cast("string"), F.lit(CRLF)), F.lit("")), F.lit("payloadBytes: "), F.col("bytes").cast("string"), F.lit(f"{CRLF}recordType: "), kind, F.lit(CRLF)), date)
    main = F.when(F.col("again"), revisit).otherwise(response)
    p.select(F.explode(F.array(request, main, metadata))).write.option("lineSep", END).option("compression", compression).text(path)


RECORDS = "record_id string, type string, fields map<string,string>, concurrent_to string, refers_to string, target_uri string, content_type string, declared_digest string, payload_bytes long, payload_digest string, block binary"


def _parse(head: bytes, block: bytes, keep: bool) -> tuple:
    h = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        h[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    kind, rid = h.get("warc-type"), h.get("warc-record-id")
    declared = h.get("warc-payload-digest")
    payload = digest = fields = None
    if kind in ("response", "revisit"):
        http, found, body = block.partition(b"\r\n\r\n")
        if kind == "response":
            body = body if found else block
            payload, digest = len(body), hashlib.sha256(body).hexdigest()
        else:  # the block of a revisit has the headers of the full response
            sizes = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            payload = int(sizes[0]) if sizes else None
            digest = (declared or "").rpartition(":")[2].lower() or None
    elif kind == "metadata" and h.get("content-type") == "application/warc-fields":
        pairs = (x.partition(b":") for x in block.split(b"\r\n") if b":" in x)
        fields = {n.strip().decode("utf-8", "replace"): v.strip().decode("utf-8", "replace") for n, _, v in pairs}
    return rid, kind, fields, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("content-type"), declared, payload, digest, block if keep else None


def read_records(spark: SparkSession, path: str, blocks: bool = False) -> DataFrame:
    """One row per record of the WARC files under ``path``. ``blocks``: with the records' blocks."""
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "map<string,string>": pa.map_(pa.string(), pa.string())}
    types = [kinds[x.split()[1]] for x in RECORDS.split(", ")]
    end = END.encode()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flow, head, want = bytearray(), None, 0  # the files' bytes again, as far as no record has taken them
        for batch in batches:
            rows = []
            for piece in batch.column(0).cast(pa.binary()).to_pylist():
                flow += piece
                flow += end
                while True:
                    if head is None:
                        # where a block ends in CR LF the reader cuts early, and adds a separator at the file's end
                        at = len(flow) - len(flow.lstrip(end))
                        cut = flow.find(end, at)
                        if cut < 0:
                            break
                        head = bytes(flow[at:cut])
                        if not head.startswith(b"WARC/"):
                            raise ValueError("a WARC record was expected")
                        del flow[: cut + 4]
                        want = next(int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    if len(flow) < want + 4:
                        break
                    if flow[want : want + 4] != end:
                        raise ValueError("a record's length doesn't match its header")
                    rows.append(_parse(head, bytes(flow[:want]), blocks))
                    del flow[: want + 4]
                    head = None
            yield batch_of(rows)
        if head is not None or flow.strip(end):
            raise ValueError("the last record is cut off")

    bounded_batches(spark)
    pieces = spark.read.option("lineSep", END).text(path)
    if not all(f.endswith((".gz", ".bz2", ".zst", ".deflate", ".snappy", ".lz4")) for f in pieces.inputFiles()):
        of = pieces.select(F.col("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
        pieces = of.repartition(partitions(spark), "file").sortWithinPartitions("file", "start", "n")
    return pieces.select(F.col("value").cast("binary")).mapInArrow(run, RECORDS)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit with the request and the metadata that are concurrent to it.

    A capture's records share one key, what they are concurrent to or their own id, so one pass over the records and one
    shuffle bring them together. Of several requests, or metadata, of one response the one with the least record id stays;
    records that name a response that isn't there are left out.
    """
    record = F.struct(*(c for c in records.columns if c != "fields"))
    of = lambda *kinds: F.min_by(record, F.when(F.col("type").isin(*kinds), F.col("record_id")))
    some = lambda *kinds: F.max(F.col("type").isin(*kinds))
    one = lambda name, *kinds: F.when(some(*kinds), of(*kinds)).alias(name)
    fields = F.min_by("fields", F.when(F.col("type") == "metadata", F.col("record_id"))).alias("fields")
    own = records.filter(F.col("type").isin("request", "response", "revisit", "metadata")).withColumn("capture", F.coalesce("concurrent_to", "record_id"))
    return own.groupBy("capture").agg(one("response", "response", "revisit"), one("request", "request"), one("metadata", "metadata"), fields).filter("response IS NOT NULL")


def op10_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    c = captures(read_records(spark, path))
    at = lambda name: F.col(f"response.{name}").alias(name)
    has = [F.col(f"{k}.record_id").isNotNull().alias(f"has_{k}") for k in ("request", "metadata")]
    c = cut_lineage(c.select("capture", F.col("fields")["pageId"].cast("long").alias("page_id"), at("payload_bytes"), at("payload_digest"), at("type"), at("refers_to"), *has))
    # what a revisit refers to is the record with that id; a response that has revisits may have very many
    again = c.filter("type = 'revisit'").select(F.col("refers_to").alias("capture")).distinct()
    named = cut_lineage(c.filter("type = 'response'").join(again, "capture").select(F.col("capture").alias("refers_to"), F.col("page_id").alias("first")))
    cols = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("first").alias("refers_to"), "has_request", "has_metadata"]
    return c.join(named, "refers_to", "left").select(*cols)


OP10_SQL = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d),
    r AS (SELECT *, payload_bytes >= 100 AND page_id > first AS again FROM f)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN first END AS refers_to, true AS has_request, true AS has_metadata FROM r"""
