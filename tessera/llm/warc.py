"""WARC archives: writing captures, reading records back, and joining the records of a transaction.

A capture is three records: the request, the response (or a revisit, if another capture has the same payload) and
metadata. Request and metadata name the response in WARC-Concurrent-To; a revisit names its response in
WARC-Refers-To and keeps only the HTTP head.

Spark's text writer makes the files: a row per record, and the record end of the format (two CRLF) as line separator.
A lost task is simply run again; only files of the attempt that was committed are there to be read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch
from tessera.session import work_path

CRLF = "\r\n"
# Payload per archive file, on average. A file is read as one row, so it has to fit a task.
FILE_BYTES = 16 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Captures carry the time they were made; the pages table has none.
DATE = "2024-01-01T00:00:00Z"


def _lines(*pairs: tuple[str, Column | str]) -> Column:
    """``Name: value`` lines; a line whose value is null is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v), F.lit(CRLF)), F.lit("")) for name, v in pairs])


def _record(kind: Column | str, rid: Column, block: Column, *headers: tuple[str, Column | str]) -> Column:
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    return F.concat(F.lit("WARC/1.1" + CRLF), _lines(("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", DATE), *headers,
                                                      ("Content-Length", F.octet_length(block).cast("string"))), F.lit(CRLF), block)


def _urn(part: str, uid: Column) -> Column:
    """A name-based id, 128 bits of the capture's number and the record's part."""
    h = F.md5(F.concat(F.lit(f"{part}:"), uid.cast("string")).cast("binary"))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _one_line(c: Column) -> Column:
    return F.regexp_replace(c, "[\\r\\n]", "")


def write_captures(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> None:
    """Write every row of ``pages`` as a capture into gzipped archives below ``path``.

    Of rows whose payloads are equal and have at least ``min_bytes`` bytes, the one with the largest key is the
    response; the others are revisits of it. Equal keys: the row read last. Smaller payloads are always responses. A null payload is
    empty; a null key is the smallest and stays null; a null url has no target line; line breaks in a url are left
    out. Repeated rows are captures of their own. Other columns are ignored; an empty table makes an archive without
    records.
    """
    scratch = Scratch(pages.sparkSession)
    # rows get their numbers once, in a table: all that follows agrees on them
    rows = scratch.cut(
        pages.select(F.col(key).cast("long").alias("key"), _one_line(F.col(url)).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
        .select("*", F.monotonically_increasing_id().alias("uid"), F.octet_length("payload").cast("long").alias("bytes"),
                F.sha2(body_of("payload"), 256).alias("same"), F.sha1(body_of("payload")).alias("sha1")))
    # one row per payload after a map-side combine; pages with a payload of their own need no join
    long_enough = rows.where(F.col("bytes") >= min_bytes)
    first = long_enough.groupBy("same").agg(F.max(F.struct("key", "uid")).alias("best"), F.count("*").alias("n"))
    first = scratch.cut(first.where("n > 1").select("same", F.col("best.uid").alias("first_uid")))
    copies = scratch.cut(long_enough.select("uid", "same").join(first, "same").select("uid", "first_uid"))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    files = max(1, -(-total // FILE_BYTES))
    # payloads are shuffled once, into the archives
    joined = rows.repartition(files, "uid").join(copies.repartition(files, "uid"), "uid", "left")
    joined.select(F.explode(_records(min_bytes)).alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)
    scratch.drop(rows, first, copies)


def body_of(name: str) -> Column:
    return F.col(name).cast("binary")


def _records(min_bytes: int) -> Column:
    """Request, response or revisit, and metadata of a numbered row."""
    uid, url = F.col("uid"), F.col("url")
    revisit = (F.col("bytes") >= min_bytes) & F.col("first_uid").isNotNull() & (F.col("first_uid") != uid)
    response = _urn("response", uid)
    head = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF), _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.col("bytes").cast("string"))), F.lit(CRLF))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    # SHA-1 as the format has it: base32 in upper case; 5 hex digits are 4 letters
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    digest = F.concat(*[F.substr(letters, (F.shiftright(F.conv(F.substring("sha1", 5 * i + 1, 5), 16, 10).cast("int"), 15 - 5 * j).bitwiseAND(31) + 1), F.lit(1))
                        for i in range(8) for j in range(4)])
    request = F.concat(F.lit("GET / HTTP/1.1" + CRLF), _lines(("Host", F.regexp_extract(url, "^[a-z]+://([^/?#]+)", 1))), F.lit(CRLF))
    return F.array(
        _record("request", _urn("request", uid), request, ("WARC-Target-URI", url), ("WARC-Concurrent-To", response), ("Content-Type", "application/http;msgtype=request")),
        _record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), response, block, ("WARC-Target-URI", url), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
                ("WARC-Refers-To", F.when(revisit, _urn("response", F.col("first_uid")))), ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
                ("Content-Type", "application/http;msgtype=response")),
        _record("metadata", _urn("metadata", uid), _lines(("page-id", F.col("key").cast("string"))), ("WARC-Target-URI", url), ("WARC-Concurrent-To", response),
                ("Content-Type", "application/warc-fields")))


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split(CRLF))
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def parse(archive: bytes) -> Iterator[dict]:
    """Records of an archive, gzipped or plain: headers as a dictionary, and the block.

    Blocks are found by Content-Length, so a payload may hold anything, even records.
    """
    data = gzip.decompress(archive) if archive[:2] == b"\x1f\x8b" else archive
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        head_end = data.index(b"\r\n\r\n", at)
        headers = _fields(data[data.index(b"\r\n", at) + 2:head_end])
        size = int(headers["content-length"])
        yield {"headers": headers, "block": data[head_end + 4:head_end + 4 + size]}
        at = head_end + 4 + size


RECORD = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("uri", pa.string()),
                    ("digest", pa.string()), ("payload_bytes", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``.

    digest and payload_bytes are those of the full payload: worked out from a response's payload, which must agree
    with the record's header, and taken from the headers of a revisit. ``fields`` are the lines of a metadata record.
    ``payloads=False`` leaves the payload column null, so that it need not be moved.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for content in batch.column(0):
                for record in parse(content.as_py()):
                    rows.append(_row(record, payloads))
                    held += len(rows[-1]["payload"] or b"") + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=RECORD)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(work, "record_id string, type string, concurrent_to string, refers_to string, uri string, digest string, "
                                  "payload_bytes bigint, fields map<string,string>, payload binary")


def _row(record: dict, payloads: bool) -> dict:
    h, block = record["headers"], record["block"]
    row = {"record_id": h["warc-record-id"], "type": h["warc-type"], "concurrent_to": h.get("warc-concurrent-to"), "refers_to": h.get("warc-refers-to"),
           "uri": h.get("warc-target-uri"), "digest": None, "payload_bytes": None, "fields": None, "payload": None}
    if h["warc-type"] == "metadata":
        row["fields"] = list(_fields(block).items())
    elif h["warc-type"] in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = h["warc-payload-digest"].removeprefix("sha1:")
        if h["warc-type"] == "response":
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if found != digest:
                raise ValueError(f"{row['record_id']}: payload digest is {found}, the header says {digest}")
            row["payload_bytes"], row["payload"] = len(payload), payload if payloads else None
        else:
            row["payload_bytes"] = int(_fields(head)["content-length"])
        row["digest"] = digest
    return row


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` (the response or revisit), ``request`` and ``metadata``.

    Requests and metadata join the response they name in concurrent_to; metadata that name a request join that
    request's response. Of several, the one with the smallest record id is taken, and n_requests and n_metadata say how
    many there are; the rest stay in ``records``. Missing ones are null. Records without a capture are not returned.
    """
    main = records.where("type in ('response', 'revisit')").select(F.col("record_id").alias("__id"), F.struct(*records.columns).alias("capture"))
    requests = records.where("type = 'request'").select(F.col("record_id").alias("__request"), F.col("concurrent_to").alias("__id"), F.struct(*records.columns).alias("it"))
    notes = records.where("type = 'metadata'").select(F.col("concurrent_to").alias("__to"), F.struct(*records.columns).alias("it"))
    via = requests.select(F.col("__request").alias("__to"), F.col("__id").alias("__via"))
    notes = notes.join(via, "__to", "left").select(F.coalesce("__via", "__to").alias("__id"), "it")

    def one(rows: DataFrame, name: str, count: str) -> DataFrame:
        return rows.groupBy("__id").agg(F.min_by("it", F.col("it.record_id")).alias(name), F.count("*").alias(count))

    joined = main.join(one(requests, "request", "n_requests"), "__id", "left").join(one(notes, "metadata", "n_metadata"), "__id", "left")
    return joined.select("capture", "request", "metadata", F.coalesce("n_requests", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"))


def captures(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages``, read the archives back and return a row per page.

    page_id, payload_bytes, payload_digest, record_type and refers_to as the archives have them; url as read.
    """
    path = work_path(spark, "warc")
    write_captures(pages, path)
    found = assemble(read_records(spark, path, payloads=False))
    page = F.col("metadata.fields")["page-id"].cast("long")
    rows = found.select(page.alias("page_id"), F.col("capture.payload_bytes").alias("payload_bytes"), F.col("capture.digest").alias("payload_digest"),
                        F.col("capture.type").alias("record_type"), F.col("capture.refers_to").alias("__to"), F.col("capture.record_id").alias("__id"), F.col("capture.uri").alias("url"))
    kept = work_path(spark, "read")
    rows.write.parquet(kept)
    rows = spark.read.parquet(kept)
    # only responses that are referred to; both inputs of the join are plain scans, so a much-visited one is split
    targets = rows.where("record_type = 'response'").select(F.col("__id").alias("__to"), F.col("page_id").alias("refers_to"))
    revisits = rows.where("record_type = 'revisit'").join(targets, "__to", "left")
    others = rows.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    return revisits.select(columns).unionByName(others.select(columns))
