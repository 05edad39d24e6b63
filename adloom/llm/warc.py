"""WARC archives of pages, and captures put together again from their records.

Writing: every page becomes a request, a response (or, for a payload that a lower page id
has already, a revisit) and a metadata record; the latter name the capture in
WARC-Concurrent-To. Spark's text writer writes the files (records end in two CRLF, which is its line
separator here), so any file system Spark reaches will do.

Reading: files are inflated member by member and parsed record by record by Content-Length, never by
searching for separators. Captures are hash-joined with what names them in WARC-Concurrent-To, giving one nested row
per capture with all of it. A file is read by one task; those written here end at ``FILE_BYTES`` of records.

A null html is an empty payload; null ids and urls are kept as such. Repeated rows give a
capture each, with an id of its own. Equal payloads are found by their SHA-1, and a payload shared by a third of all
pages is one row per task in that aggregate and a split join. An empty table gives none.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.textops import some_rows
from adloom.session import scratch_dir

END = "\r\n\r\n"
PAGES_PER_FILE = 4_000
FILE_BYTES = 64 << 20  # of records before compression, and those of one more page
_FEED = 16 << 10
_ROWS, _ROW_BYTES = 2_000, 16 << 20  # in a batch
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"  # the tables carry no capture time

RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
          "payload_digest string, content_type string, headers map<string,string>, payload_bytes long, found_digest string, payload binary")


def _record(kind: str, headers: list[tuple[str, str | None]], block: str) -> str:
    head = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers if v is not None), f"WARC-Date: {_DATE}",
            f"Content-Length: {len(block.encode())}"]
    return "WARC/1.1\r\n" + "\r\n".join(head) + END + block


def _capture_id(page: object, digest: str, number: int, part: str = "") -> str:
    """Of its own for each row, also where page ids are null or repeat."""
    return f"<urn:page:{'' if page is None else quote(str(page), safe='')}:{digest}:{number}{part}>"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, and the number of the file among those of the task."""
    file = size = 0
    for batch in some_rows(batches):
        out, files = [], []
        for page, number, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            html = html or ""
            base32 = base64.b32encode(bytes.fromhex(digest)).decode()
            capture, uri = _capture_id(page, base32, number), None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%")
            named = [("WARC-Target-URI", uri), ("WARC-Concurrent-To", capture)]
            payload = f"sha1:{base32}"
            response = first is None or first["_id"] == page
            out.append(_record("request", [("WARC-Record-ID", _capture_id(page, base32, number, ":request")), *named, ("Content-Type", "application/http; msgtype=request")],
                               f"GET {uri or '/'} HTTP/1.1{END}"))
            own = [("WARC-Record-ID", capture), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", payload),
                   ("Content-Type", "application/http; msgtype=response")]
            if response:
                out.append(_record("response", own, _HTTP + html))
            else:
                own += [("WARC-Refers-To", _capture_id(first["_id"], base32, first["_number"])), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                out.append(_record("revisit", own, _HTTP))
            out.append(_record("metadata", [("WARC-Record-ID", _capture_id(page, base32, number, ":metadata")), *named, ("Content-Type", "application/warc-fields")],
                               f"payloadLength: {len(html.encode())}\r\n"))
            files += [file] * 3
            size += sum(len(x.encode()) for x in out[-3:])
            if size >= FILE_BYTES:
                file, size = file + 1, 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(files, pa.int32())], ["value", "file"])


def write_archive(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  least_bytes: int = 0) -> None:
    """Writes gzipped WARC files below ``path``. Payloads of at least ``least_bytes`` that
    were met under a lower id become revisits."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_number"), F.col(url_col).cast("string").alias("_url"),
                        html.alias("_html"), F.sha1(html).alias("_digest"))
    named = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_number")  # a null id is first of its payload only if no other is
    firsts = (rows.where(F.octet_length("_html") >= least_bytes).groupBy("_digest").agg(F.min(named).alias("_first"))
              .repartition("_digest", "_first"))  # dealt anew, so that the join can split a hot payload
    known = rows.join(firsts, "_digest", "left").select("_id", "_number", "_url", "_html", "_digest", "_first")
    (known.mapInArrow(_records, "value string, file int").write.partitionBy("file").option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", 3 * PAGES_PER_FILE).text(path))


def _inflated(data: bytes) -> Iterator[bytes]:
    """The bytes of a plain file, or of all members of a gzipped one, in turn."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    member = None
    for at in range(0, len(data), _FEED):  # what follows a member is copied, so little is fed at a time
        part = data[at : at + _FEED]
        while part:
            if member is None:
                part = part.lstrip(b"\0")  # padding between members
                if not part:
                    break
                member = zlib.decompressobj(31)
            out = member.decompress(part)
            if out:
                yield out
            part = member.unused_data
            if member.eof:
                member = None
    if member is not None:
        raise ValueError("a gzip member is cut short")


def _parsed(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    chunks, buffer, at = iter(chunks), bytearray(), 0

    def more() -> bool:
        nonlocal at
        chunk = next(chunks, None)
        if chunk is None:
            return False
        del buffer[:at]
        at = 0
        buffer.extend(chunk)
        return True

    while True:
        while buffer[at : at + 1] in (b"\r", b"\n") or (at == len(buffer) and more()):  # record ends
            at += buffer[at : at + 1] in (b"\r", b"\n")
        if at == len(buffer):
            return
        seen = 0
        while (end := buffer.find(b"\r\n\r\n", at + seen)) < 0:
            seen = max(0, len(buffer) - at - 3)
            if not more():
                raise ValueError("a WARC header is cut short")
        version, *lines = buffer[at:end].decode(errors="replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at {version[:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers["content-length"])
        at = end + 4
        while len(buffer) - at < size:
            if not more():
                raise ValueError("a WARC block is cut short")
        yield headers, bytes(buffer[at : at + size])
        at += size


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    import hashlib

    fields = ["warc-record-id", "warc-type", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date", "warc-payload-digest", "content-type"]
    names = [x.strip().split(" ")[0] for x in RECORD.replace("map<string,string>", "map").split(", ")]
    kinds = [pa.string()] * 8 + [pa.map_(pa.string(), pa.string()), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for content in batch.column(0):
            rows: list[tuple] = []
            held = 0
            for headers, block in _parsed(_inflated(content.as_py())):
                kind, size, digest, payload = headers["warc-type"], None, None, None
                if kind == "response":
                    payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                elif kind == "metadata":
                    stated = dict(x.split(": ", 1) for x in block.decode(errors="replace").split("\r\n") if ": " in x)
                    size = int(stated["payloadLength"]) if "payloadLength" in stated else None
                more = [(k, v) for k, v in headers.items() if k not in fields and k != "content-length"]
                rows.append((*(headers.get(f) for f in fields), more, size, digest, payload if with_payload else None))
                held += len(payload or b"") if with_payload else 0
                if len(rows) == _ROWS or held >= _ROW_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Row per record, of plain or gzipped files. ``found_digest`` is computed from the payload."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(lambda b: _read(b, with_payload), RECORD)


def captures(records: DataFrame) -> DataFrame:
    """Nested row per capture: record_id, type, target_uri, date, payload_digest, found_digest,
    refers_to, payload_bytes, payload, and the requests and metadata that are concurrent to it: the
    least of each, and all in ``requests`` and ``metadata_records`` (in order; null if there are none)."""
    shown = ["record_id", "target_uri", "content_type", "payload_bytes"]
    others = (records.where(F.col("concurrent_to").isNotNull() & F.col("type").isin("request", "metadata"))
              .groupBy(F.col("concurrent_to").alias("capture"))
              .agg(*(F.array_sort(F.collect_list(F.when(F.col("type") == k, F.struct(*shown)))).alias(k) for k in ("request", "metadata")))
              .select("capture", *(F.get(k, F.lit(0)).alias(k) for k in ("request", "metadata")),
                      F.col("request").alias("requests"), F.col("metadata").alias("metadata_records"))
              .repartition("capture", "request"))
    found = records.where(F.col("type").isin("response", "revisit", "resource"))
    return found.alias("f").join(others.alias("o"), F.col("record_id") == F.col("capture"), "left").select(
        "record_id", "type", "target_uri", "date", "payload_digest", "found_digest", "refers_to",
        F.coalesce("f.payload_bytes", "o.metadata.payload_bytes").alias("payload_bytes"), "payload", "request", "metadata",
        "requests", "metadata_records")


def _page_of(capture: str, id_type: str) -> F.Column:
    inner = F.regexp_extract(capture, "^<urn:page:([^:]*):", 1)
    return F.when(F.col(capture).isNotNull() & (inner != ""), F.url_decode(inner)).cast(id_type)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = scratch_dir(spark, "warc")
    write_archive(pages, path)
    found = captures(read_records(spark, path, with_payload=False))
    stated = F.regexp_extract("payload_digest", "^sha1:(.*)$", 1)
    return found.select(_page_of("record_id", "long").alias("page_id"), "payload_bytes",
                        F.coalesce("found_digest", stated).alias("payload_digest"), F.col("type").alias("record_type"),
                        _page_of("refers_to", "long").alias("refers_to"))
