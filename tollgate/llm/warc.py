"""WARC archives: writing captures, reading records back, and assembling transactions.

**Writing.**  A capture is three records: a request, a response (or a revisit, if
an earlier page has the same payload) and a metadata record; request and
metadata name the response in ``WARC-Concurrent-To``.  Records are built with SQL
functions and written by Spark's text sink with the record end (two CRLFs) as the
line separator, one gzip stream a file, to any store that Spark writes to.  Which
page is the response of a payload is a minimum over digests; only the digest
groups are aggregated, and the join back may split a payload that is hot.

**Reading.**  Files are read as pieces between CRLF pairs and put together by
``Content-Length``, record by record, so a payload may hold anything and memory
is bounded by the longest record.  Compressed files are never split.

**Assembly.**  Responses and revisits are joined with the request and metadata
records that are concurrent to them: one nested row per capture.  Columns that a
caller does not select (payloads, say) are pruned before the joins.

Every row is a capture of its own: rows get a key, written with them, that is part
of their record ids, so rows that repeat an id or everything stay apart.  Of rows
with equal payloads the one with the least id is the response (null ids come last;
of equal ids the first row).  A null payload is empty, a null URL an empty header,
a null id an empty field, line ends in URLs are escaped.  Extra columns are ignored;
an empty table gives an archive without records.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.storage import fresh_path, settle

LEAST_REVISIT = 100  # shorter payloads are stored each time
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
CRLF = "\r\n"
END = CRLF * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH_BYTES = 8 << 20


def _record_id(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", F.lit(kind), *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(block: Column, **headers: Column) -> Column:
    lines = [F.lit("WARC/1.1")]
    for name, value in headers.items():
        lines.append(F.concat(F.lit(name.replace("_", "-") + ": "), value))
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(END), block)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, date: str = DATE) -> None:
    """Write the captures of *pages* as WARC files under *path*."""
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "\r", "%0D"), "\n", "%0A")
    rows = pages.select(F.col(id_col).cast("long").alias("page"), url.alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html")).withColumn("row", F.monotonically_increasing_id())
    rows = settle(rows, "pages")  # the key of a row stays the same whenever a task is run again
    order = F.struct(F.col("page").isNull(), "page", "row")
    first = rows.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    first = settle(first.where("n > 1").select("digest", F.col("first.row").alias("first")), "payloads")  # a plain table: the join may split a hot payload
    rows = rows.join(first, "digest", "left")
    stored = F.col("first").isNull() | (F.col("first") == F.col("row"))
    own = _record_id("response", F.col("row").cast("string"), F.col("digest"))
    other = _record_id("response", F.col("first").cast("string"), F.col("digest"))
    http = F.concat(F.lit(CRLF.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "))), F.col("bytes").cast("string"), F.lit(END))
    about = {"WARC_Date": F.lit(date), "WARC_Target_URI": F.col("url")}
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    response = _record(F.concat(http, "html"), WARC_Type=F.lit("response"), WARC_Record_ID=own, **about, WARC_Payload_Digest=digest,
                       Content_Type=F.lit("application/http;msgtype=response"))
    revisit = _record(http, WARC_Type=F.lit("revisit"), WARC_Record_ID=own, **about, WARC_Payload_Digest=digest, WARC_Refers_To=other,
                      WARC_Profile=F.lit(PROFILE), Content_Type=F.lit("application/http;msgtype=response"))
    key = (F.col("row").cast("string"), F.col("digest"))
    request = _record(F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{END}")), WARC_Type=F.lit("request"), WARC_Record_ID=_record_id("request", *key),
                      **about, WARC_Concurrent_To=own, Content_Type=F.lit("application/http;msgtype=request"))
    metadata = _record(F.concat(F.lit("page-id: "), F.coalesce(F.col("page").cast("string"), F.lit("")), F.lit(CRLF)), WARC_Type=F.lit("metadata"),
                       WARC_Record_ID=_record_id("metadata", *key), **about, WARC_Concurrent_To=own, Content_Type=F.lit("application/warc-fields"))
    records = rows.select(F.explode(F.array(request, F.when(stored, response).otherwise(revisit), metadata)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").text(path)


_FIELDS = ("type", "record_id", "concurrent_to", "target_uri", "date", "refers_to", "http", "payload_digest")
_SCHEMA = pa.schema([(f, pa.string()) for f in _FIELDS] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _headers(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "replace").split(CRLF)
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _row(head: bytes, block: bytes) -> tuple:
    version, h = _headers(head)
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    kind, http, payload = h.get("warc-type"), None, block
    if h.get("content-type", "").startswith("application/http"):
        top, _, payload = block.partition(END.encode())
        http = top.decode("utf-8", "replace")
    size, digest = len(payload), f"sha256:{hashlib.sha256(payload).hexdigest()}"
    if kind == "revisit":  # the payload is the other record's
        size, digest = int(_headers((http or "").encode())[1].get("content-length", 0)), h.get("warc-payload-digest")
    return (kind, h.get("warc-record-id"), h.get("warc-concurrent-to"), h.get("warc-target-uri"), h.get("warc-date"), h.get("warc-refers-to"),
            http, digest, size, payload)


def _records(batches):
    held, need, head = bytearray(), None, b""
    rows, size = [], 0
    for batch in batches:
        for piece in batch.column(0):
            held += piece.as_buffer().to_pybytes()
            held += END.encode()
            while True:
                if need is None:
                    while held.startswith(CRLF.encode()):  # a record never begins so; the last piece of a file has no end of its own
                        del held[: len(CRLF)]
                    at = held.find(END.encode())
                    if at < 0:
                        break
                    head = bytes(held[:at])
                    need = int(_headers(head)[1].get("content-length", 0)) + len(END)
                    del held[: at + len(END)]
                if len(held) < need:
                    break
                rows.append(_row(head, bytes(held[: need - len(END)])))
                size += need
                del held[:need]
                need = None
            if size >= _BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
                rows, size = [], 0
    if held or need is not None:
        raise ValueError("the archive ends inside a record")
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under *path*; payload_digest and payload_bytes are of the payload as read
    (for a revisit: of the payload it stands for)."""
    pieces = spark.read.option("lineSep", END).text(path).select(F.col("value").cast("binary").alias("piece"))
    return pieces.mapInArrow(_records, ", ".join(f"{f} string" for f in _FIELDS) + ", payload_bytes long, payload binary")


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, record_type, target_uri, and the structs response, request and metadata."""
    main = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), F.col("type").alias("record_type"), "target_uri", F.col("date").alias("r_date"), "refers_to", "payload_digest",
        "payload_bytes", F.col("http").alias("r_http"), F.col("payload").alias("r_payload")).dropDuplicates(["capture_id"])
    request = records.where("type = 'request'").select(F.col("concurrent_to").alias("capture_id"), F.col("record_id").alias("q_id"),
                                                       F.col("http").alias("q_http")).dropDuplicates(["capture_id"])
    fields = F.decode("payload", "UTF-8")
    metadata = records.where("type = 'metadata'").select(F.col("concurrent_to").alias("capture_id"), F.col("record_id").alias("m_id"),
                                                         fields.alias("m_fields")).dropDuplicates(["capture_id"])
    joined = main.join(request, "capture_id", "left").join(metadata, "capture_id", "left")
    return joined.select(
        "capture_id", "record_type", "target_uri",
        F.struct(F.col("r_date").alias("date"), "refers_to", "payload_digest", "payload_bytes", F.col("r_http").alias("http"), F.col("r_payload").alias("payload")).alias("response"),
        F.struct(F.col("q_id").alias("record_id"), F.col("q_http").alias("http")).alias("request"),
        F.struct(F.col("m_id").alias("record_id"), F.col("m_fields").alias("fields")).alias("metadata"))


def round_trip(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Write *pages* to an archive (in the shared folder unless *path* is given), read it back and assemble the captures."""
    path = path or fresh_path(pages.sparkSession, "warc")
    write_archive(pages, path, **columns)
    return assemble(read_records(pages.sparkSession, path))
