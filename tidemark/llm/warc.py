"""WARC archives of captures: writing, reading, and assembly of transactions.

A capture is three records: a response (or a revisit of an equal payload), the request, and metadata.
Request and metadata name the response in ``WARC-Concurrent-To``. Archives are gzip files with one
member for each record, as the format recommends.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import file_system
from tidemark.session import scratch_dir, stored

# Equal payloads of at least this many bytes are archived once.
REVISIT_BYTES = 100
# Bytes of payload in a batch that a reader passes on.
BATCH_BYTES = 4_000_000
# Captures that a writer has as Python objects at a time.
ROWS_AT_ONCE = 64
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

RECORD = (
    "record_id string, type string, concurrent_to string, target_uri string, date string, "
    "refers_to string, payload_digest string, payload_bytes long, payload_sha256 string, payload binary, "
    "fields map<string,string>"
)


def _record_id(kind: str, key: Column) -> Column:
    """A record id derived from the capture's key, so that a repeated task gives the same ids."""
    digest = F.md5(F.concat(F.lit(kind + ":"), key))
    parts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def captures_of(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = DATE
) -> DataFrame:
    """One row for each page with its digest, record ids and, for a revisit, the response it repeats.

    The response is the row with the least id (null last), then url. Record ids are made of id, url, digest and,
    for rows that agree in all three, a number, so they are the same however often and in whatever order the
    pages are computed. Only digests that occur twice meet the pages in a join; adaptive execution
    splits a payload that very many pages share.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("string").alias("name"),
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    narrow = stored(rows.select("id", "url", "digest", "size"), "digests")
    order = F.struct(F.col("id").isNull().alias("none"), "id", F.col("url").isNull().alias("no_url"), "url")
    first = (
        narrow.where(F.col("size") >= REVISIT_BYTES)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("of", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"))
    )
    own = ["id", "url", "digest"]
    again = stored(narrow.groupBy(*own).agg(F.count("*").alias("n")).where("n > 1"), "repeated-pages")
    numbered = rows.withColumn("number", F.lit(1))
    if not again.isEmpty():
        # Equal rows are one row and their number, until they are told apart by a count.
        twice = again.select(*(F.col(c).alias(f"a_{c}") for c in own), "n")
        same = [F.col(c).eqNullSafe(F.col(f"a_{c}")) for c in own]
        counted = rows.join(twice.hint("merge"), same[0] & same[1] & same[2], "left")
        many = counted.where("n IS NOT NULL").groupBy("name", *own, "size", "n").agg(F.any_value("payload").alias("payload"))
        many = many.withColumn("number", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
        numbered = counted.where("n IS NULL").withColumn("number", F.lit(1)).select(*rows.columns, "number")
        numbered = numbered.unionByName(many.select(*rows.columns, "number"))
    shared = F.when(F.col("size") >= REVISIT_BYTES, F.col("digest"))
    joined = numbered.join(first.hint("merge"), shared == F.col("of"), "left")
    is_first = F.col("id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url")) & (F.col("number") == 1)
    revisit = F.col("of").isNotNull() & ~is_first

    def key(id_: str, url: str, number) -> Column:
        return F.to_json(F.struct(F.col(id_).cast("string").alias("i"), F.col(url).alias("u"), "digest", number.alias("n")))

    mine = key("id", "url", F.col("number"))
    return joined.select(
        "name",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "digest",
        "size",
        F.lit(date).alias("date"),
        _record_id("response", mine).alias("response_id"),
        _record_id("request", mine).alias("request_id"),
        _record_id("metadata", mine).alias("metadata_id"),
        F.when(revisit, _record_id("response", key("first_id", "first_url", F.lit(1)))).alias("refers_to"),
    )


def _record(
    kind: str, record_id: str, date: str, block: bytes, content_type: str, **headers: str | None
) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    lines += [f"WARC-{name.replace('_', '-')}: {value}" for name, value in headers.items() if value is not None]
    lines += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    head = "\r\n".join(lines).encode()
    return gzip.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _line(value: str | None) -> str | None:
    """A header value on one line."""
    return None if value is None else value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(value: str | None) -> str | None:
    return None if value is None else value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _request(url: str | None) -> bytes:
    """The HTTP request that asks for ``url``; one that cannot be told apart asks for it as a whole."""
    try:
        parts = urlsplit(url or "")
    except ValueError:
        parts = urlsplit("")
    path = parts.path or ("/" if parts.netloc else url or "/")
    lines = [f"GET {path}{'?' + parts.query if parts.query else ''} HTTP/1.1"]
    lines += [f"Host: {parts.netloc}"] if parts.netloc else []
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _capture_records(row: dict) -> Iterator[bytes]:
    uri, response, date = _line(row["url"]), row["response_id"], row["date"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n"
    digest = "sha256:" + row["digest"]
    if row["refers_to"] is None:
        yield _record(
            "response", response, date, http.encode() + row["payload"], "application/http; msgtype=response",
            Target_URI=uri, Payload_Digest=digest,
        )
    else:
        yield _record(
            "revisit", response, date, http.encode(), "application/http; msgtype=response",
            Target_URI=uri, Payload_Digest=digest, Refers_To=row["refers_to"], Profile=PROFILE,
        )
    yield _record(
        "request", row["request_id"], date, _request(uri), "application/http; msgtype=request",
        Target_URI=uri, Concurrent_To=response,
    )
    fields = {} if row["name"] is None else {"page-id": _line(row["name"])}
    block = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode()
    yield _record(
        "metadata", row["metadata_id"], date, block, "application/warc-fields", Target_URI=uri, Concurrent_To=response
    )


def write_archives(captures: DataFrame) -> DataFrame:
    """Write one archive for each task; the result (path, n_records) names the files that count.

    A task repeated after a loss writes a new file; only files of committed attempts are listed.
    """
    root = scratch_dir(captures.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(root)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, written = None, 0
        for batch in batches:
            if out is None:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{folder.rstrip('/')}/{name}", compression=None)
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                for row in batch.slice(at, ROWS_AT_ONCE).to_pylist():
                    for record in _capture_records(row):
                        out.write(record)
                        written += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{root.rstrip('/')}/{name}"]), pa.array([written], pa.int64())],
                names=["path", "n_records"],
            )

    return stored(captures.mapInArrow(write, "path string, n_records long"), "warc-manifest")


def _parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the archive ends inside a record")
        yield headers, block


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode().splitlines() if ":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _row(headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    kind = headers["warc-type"]
    row = {
        "record_id": headers["warc-record-id"],
        "type": kind,
        "concurrent_to": headers.get("warc-concurrent-to"),
        "target_uri": _unline(headers.get("warc-target-uri")),
        "date": headers.get("warc-date"),
        "refers_to": headers.get("warc-refers-to"),
        "payload_digest": headers.get("warc-payload-digest", "").partition(":")[2] or None,
        "fields": [],
    }
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        row["fields"] = list(_fields(http).items())
        row["payload_bytes"] = int(dict(row["fields"]).get("content-length", len(payload)))
        if kind == "response":
            row["payload_sha256"] = hashlib.sha256(payload).hexdigest()
            row["payload"] = payload if payloads else None
    elif kind == "metadata":
        row["fields"] = [(k, _unline(v)) for k, v in _fields(block).items()]
    return row


def read_records(archives: DataFrame, *kinds: str, payloads: bool = True) -> DataFrame:
    """Records of the given types (all if none is given) in the archives that ``path`` names.

    ``payload_digest`` is what the record declares, ``payload_sha256`` that of the bytes that are there;
    a revisit has none. Without ``payloads`` the bytes themselves stay in the archive.
    """
    spread = archives.select("path").repartition(
        int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path"
    )
    schema = pa.schema(
        [(c, pa.string()) for c in ("record_id", "type", "concurrent_to", "target_uri", "date", "refers_to")]
        + [("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string())]
        + [("payload", pa.binary())]
        + [("fields", pa.map_(pa.string(), pa.string()))]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inside = file_system(path)
                rows, size = [], 0
                with system.open_input_stream(inside, compression=None) as raw, gzip.open(raw) as stream:
                    for headers, block in _parse(stream):
                        if kinds and headers["warc-type"] not in kinds:
                            continue
                        rows.append(_row(headers, block, payloads))
                        size += (len(block) if payloads else 0) + 500
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return spread.mapInArrow(read, RECORD)


def assemble(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row for each capture: nested ``response``, ``request`` and ``metadata``.

    The archives are read once, without payloads, and the records joined through their concurrent-to
    identifiers; ``payloads`` brings the bytes into the responses by one more read. A capture
    without a request or metadata has null there; of several, the one with the least record id is
    taken; requests and metadata that name no response of these archives have no capture and are
    left out.
    """
    records = stored(read_records(archives, payloads=False).drop("payload"), "records")

    def beside(kind: str) -> DataFrame:
        record = F.struct("record_id", "target_uri", "date", "concurrent_to", F.map_entries("fields").alias("entries"))
        one = (
            records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
            .groupBy(F.col("concurrent_to").alias("of"))
            .agg(F.min(record).alias("r"))
        )
        nested = F.struct(
            "r.record_id", "r.target_uri", "r.date", "r.concurrent_to", F.map_from_entries("r.entries").alias("fields")
        )
        # Neither side has a bound, so neither is broadcast.
        return one.select("of", nested.alias(kind)).hint("merge")

    shown = ["record_id", "type", "target_uri", "date", "refers_to", "payload_digest", "payload_bytes", "payload_sha256"]
    responses = records.where(F.col("type").isin("response", "revisit")).select("record_id", F.struct(*shown, "fields").alias("response"))
    if payloads:
        bodies = read_records(archives, "response").select(F.col("record_id").alias("of"), "payload").hint("merge")
        whole = responses.join(bodies, F.col("record_id") == F.col("of"), "left")
        responses = whole.select("record_id", F.col("response").withField("payload", F.col("payload")).alias("response"))
    same = F.col("record_id") == F.col("of")
    joined = responses.join(beside("request"), same, "left").drop("of").join(beside("metadata"), same, "left").drop("of")
    return joined.drop("record_id")
