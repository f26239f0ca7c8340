"""WARC archives with revisits resolved: equal payloads are stored once.

Only headers are shuffled by payload digest; each digest's smallest id is found with partial aggregation. Digests that more than a
thousandth of the repeated payloads share, less than a thousand, are broadcast to their records, and so are the responses that
as many revisits name; so a payload that fills a third of the rows is no hot task. Records are rendered as text by Spark's own writer: records end in two line breaks,
which is the writer's line separator, so its commit protocol also covers lost tasks. Archives are read once, without splitting a
file, piece by piece, and records are cut by their Content-Length, whatever the payload holds; their headers are kept in the shared folder.

Defined results: null payload is the empty payload; payloads below ``least_bytes`` are always responses; a null id sorts after
all others; rows that repeat the smallest id of their payload are all responses; an empty table gives an archive without
records and no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import join_by_count, scratch, stored

BREAK = "\r\n\r\n"
LEAST_BYTES = 100
RECORD = "record_id long, target_uri string, record_type string, refers_to long, payload_digest string, payload_bytes long, n_read long, digest_read string"


def resolve_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to of every row of (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digest = F.sha2(payload, 256)
    n_bytes = F.octet_length(payload).cast("long")
    rows = pages.select("page_id", "url", payload.alias("payload"), n_bytes.alias("payload_bytes"), digest.alias("payload_digest"))
    heads = pages.where(n_bytes >= least_bytes).select("page_id", F.unhex(digest).alias("d_key"))
    # Payloads found once are responses and need no entry.
    first = heads.groupBy("d_key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("d_n"))
    first = stored(first.where("d_n > 1 and first is not null"), "warc-first")
    total = first.agg(F.sum("d_n")).first()[0] or 0
    key = F.when(F.col("payload_bytes") >= least_bytes, F.unhex("payload_digest"))
    joined = join_by_count(rows, key, first, total)
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = joined.withColumn("refers_to", F.when(again, F.col("first"))).drop("first")
    return joined.withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))


def write_archives(records: DataFrame, path: str) -> None:
    """Records of ``resolve_revisits`` as gzipped WARC files; revisits carry headers only."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + BREAK)
    revisit = F.col("record_type") == "revisit"
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string")))
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]+", " ")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), urn("page_id")),
        F.concat(F.lit("WARC-Target-URI: "), clean),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn("refers_to"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(BREAK), block)
    records.select(record.alias("value")).write.option("lineSep", BREAK).option("compression", "gzip").text(path)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the pieces of each file again and cuts records by their length."""
    schema = pa.schema([
        ("record_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("n_read", pa.int64()), ("digest_read", pa.string()),
    ])
    mark = BREAK.encode()
    head, parts, got, rows = None, [], 0, []
    ident = lambda x: int(x[10:-1]) if x and x[10:-1] else None
    for batch in batches:
        for piece in batch.column(0).to_pylist():
            parts.append(piece + mark)
            got += len(piece) + len(mark)
            while True:
                if head is None:
                    # The last piece of a file may end without a separator, so line breaks can be left over between records.
                    data = b"".join(parts).lstrip(b"\r\n")
                    if not data:
                        parts, got = [], 0
                        break
                    cut = data.find(mark)
                    if cut < 0:
                        parts, got = [data], len(data)
                        break
                    fields = data[:cut].decode("utf-8", "replace").split("\r\n")[1:]
                    head = {k.lower(): v for k, _, v in (f.partition(": ") for f in fields)}
                    data = data[cut + len(mark) :]
                    parts, got = [data], len(data)
                need = int(head["content-length"]) + len(mark)
                if got < need:
                    break
                data = b"".join(parts)
                payload = data[: need - len(mark)].partition(mark)[2]
                rows.append({
                    "record_id": ident(head["warc-record-id"]), "target_uri": head.get("warc-target-uri"),
                    "record_type": head["warc-type"], "refers_to": ident(head.get("warc-refers-to")),
                    "payload_digest": head["warc-payload-digest"].removeprefix("sha256:"), "payload_bytes": None,
                    "n_read": len(payload), "digest_read": hashlib.sha256(payload).hexdigest(),
                })
                head, parts, got = None, [data[need:]], len(data) - need
                if not parts[0]:
                    parts = []
                    break
        if len(rows) >= 5000:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            rows = []
    if parts or head is not None:
        raise ValueError("an archive ends inside a record")
    yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Headers of all records with the length and digest of the payload as read."""
    pieces = spark.read.schema("value string").option("lineSep", BREAK).text(path).select(F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_records, RECORD)


def resolved_records(records: DataFrame) -> DataFrame:
    """Records with the payload length and digest of their original: responses have their own, revisits their response's."""
    own = records.where("record_type = 'response'").select(
        "record_id", "target_uri", "record_type", "refers_to", F.col("digest_read").alias("payload_digest"), F.col("n_read").alias("payload_bytes")
    )
    again = records.where("record_type = 'revisit'").drop("payload_bytes", "n_read", "digest_read")
    named = again.groupBy("refers_to", "payload_digest").agg(F.count(F.lit(1)).alias("d_n"))
    origin = own.select(F.col("record_id").alias("o_id"), F.col("payload_digest").alias("o_digest"), "payload_bytes").distinct()
    named = named.join(origin, (F.col("refers_to") == F.col("o_id")) & (F.col("payload_digest") == F.col("o_digest")))
    original = F.unhex(F.sha2(F.concat_ws("/", F.col("refers_to").cast("string"), "payload_digest"), 256))
    named = stored(named.select(original.alias("d_key"), "d_n", "payload_bytes"), "warc-named")
    total = named.agg(F.sum("d_n")).first()[0] or 0
    again = join_by_count(again, original, named, total).where("payload_bytes is not null")
    return own.unionByName(again)


def archived(pages: DataFrame, path: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the pages as deduplicated archives (in the shared folder where no path is given) and read them back."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_archives(resolve_revisits(pages, least_bytes), path)
    return resolved_records(stored(read_archives(spark, path), "warc-headers"))
