"""WARC archives: written whole-file compressed, normalised to one gzip member
a record with an offset index, and read back by offset.

Writing is DataFrame work: a record is one string, and Spark's text sink with
gzip makes each file one monolithic stream.  The normaliser inflates each
such stream once, from front to back in constant memory, and rewrites every
record as a gzip member of its own beside a JSON index of offsets.  With the
index a reader takes any record by one seek.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelworks.llm.storage import broadcast_if_small, open_in, open_out, scratch_path, stored

#: Records a monolithic file holds at most; payloads from this size on are deduplicated.
FILE_RECORDS, REVISIT_BYTES = 5000, 1000
_CHUNK = 1 << 18
_CRLF = b"\r\n"
_INDEX = "archive string, offset long, length long, page_id long, record_type string, uri string"


def records(pages: DataFrame) -> DataFrame:
    """One string ``value`` a row of ``pages``: its WARC record but for the
    four closing bytes.  Of equal payloads of REVISIT_BYTES bytes or more,
    that of the largest page_id is a response and the others revisit it."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.sha1(F.col("payload").cast("binary"))})
    groups = rows.where((F.col("size") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).groupBy("sha1", "size")
    groups = groups.agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    groups = broadcast_if_small(stored(groups, "warc-groups"), 120)
    rows = rows.join(groups, ["sha1", "size"], "left")
    revisit = F.col("refers_to").isNotNull() & F.col("page_id").isNotNull() & (F.col("refers_to") != F.col("page_id"))

    def line(name: str, value) -> F.Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("size")), F.lit("\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")  # a header is one line
    urn = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        F.when(revisit, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        line("WARC-Record-ID", urn),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        line("WARC-Target-URI", url),
        line("X-Page-Id", F.col("page_id")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            revisit,
            F.concat(
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
            ),
        ).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(body)),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, body, F.lit("\r\n")).alias("value"))


def write_monolithic(pages: DataFrame, folder: str | None = None) -> str:
    """Whole-file gzip archives; each file at most FILE_RECORDS records."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    out = records(pages).write.option("compression", "gzip").option("lineSep", "\r\n")
    out.option("maxRecordsPerFile", FILE_RECORDS).text(folder)
    return folder


def _head(lines: bytes) -> dict[str, str]:
    pairs = (x.split(": ", 1) for x in lines.decode().split("\r\n")[1:] if x)
    return {k.lower(): v for k, v in pairs}


def split_records(stream):
    """(headers, bytes of the whole record) from an inflated stream given as
    chunks; holds one record and one chunk."""
    have = bytearray()
    chunks = iter(stream)

    def need(n: int) -> bool:
        while len(have) < n:
            more = next(chunks, None)
            if more is None:
                return False
            have.extend(more)
        return True

    while True:
        cut = have.find(b"\r\n\r\n")
        while cut < 0:
            if not need(len(have) + 1):
                if have.strip():
                    raise ValueError("the archive ends inside a header")
                return
            cut = have.find(b"\r\n\r\n")
        head = _head(bytes(have[:cut]))
        end = cut + 4 + int(head["content-length"]) + 4
        if not need(end):
            raise ValueError("the archive ends inside a record")
        yield head, bytes(have[:end])
        del have[:end]


def inflated(file):
    """Chunks of a gzip file of any number of members, read once."""
    z, begun = zlib.decompressobj(31), False
    while data := file.read(_CHUNK):
        while data:
            if z.eof:
                z = zlib.decompressobj(31)
            begun = True
            if out := z.decompress(data, _CHUNK):
                yield out
            data = z.unused_data if z.eof else z.unconsumed_tail
    if out := z.flush():
        yield out
    if begun and not z.eof:
        raise ValueError("the archive's compressed stream is cut off")


def normalise_file(source: str, target: str) -> int:
    """Rewrite one monolithic archive as members, with ``target``.idx.json."""
    n = offset = 0
    with open_out(f"{target}.idx.json") as index, open_in(source) as raw, open_out(target) as out:
        for head, record in split_records(inflated(raw)):
            member = gzip.compress(record, 4, mtime=0)
            out.write(member)
            page = head.get("x-page-id")
            entry = {"archive": target, "offset": offset, "length": len(member), "record_type": head["warc-type"]}
            entry |= {"page_id": int(page) if page is not None else None, "uri": head.get("warc-target-uri")}
            index.write(json.dumps(entry).encode() + b"\n")
            offset += len(member)
            n += 1
    return n


def _normalise(folder: str):
    def run(batches):
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = source.rsplit("/", 1)[-1].split(".")[0]
                n = normalise_file(source, f"{folder}/{name}.warc.gz")
                yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}.warc.gz"], "records": pa.array([n], pa.int64())})

    return run


def normalise(spark: SparkSession, monolithic: str, folder: str | None = None) -> str:
    """Normalise every archive of a folder, one task an archive."""
    folder = folder or scratch_path(spark, "warc-members")
    files = spark.read.format("binaryFile").load(monolithic).select("path")  # names only
    files = stored(files, "warc-files")
    n = files.count()
    if n:
        files = files.repartitionByRange(n, "path")
        stored(files.mapInArrow(_normalise(folder), "archive string, records long"), "warc-done").count()
    return folder


def _read_members():
    def run(batches):
        name, file = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if archive != name:
                    name, file = archive, open_in(archive)
                file.seek(offset)
                head, record = next(split_records([gzip.decompress(file.read(length))]))
                http = record[record.index(b"\r\n\r\n") + 4 : -4]
                cut = http.index(b"\r\n\r\n")
                payload = http[cut + 4 :]
                told = head["warc-payload-digest"].removeprefix("sha1:")
                page, refers = head.get("x-page-id"), head.get("warc-refers-to")
                if head["warc-type"] == "response":
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    if digest != told:
                        raise ValueError(f"{archive} at {offset}: the payload's digest differs")
                else:  # the payload is that of the response it refers to
                    size, digest = int(_head(http[: cut + 2])["content-length"]), told
                rows.append(
                    (
                        int(page) if page is not None else None, size, digest, head["warc-type"],
                        int(refers.removeprefix("<urn:page:").removesuffix(">")) if refers else None,
                        head.get("warc-target-uri"), payload if head["warc-type"] == "response" else None,
                    )
                )
                if sum(len(r[-1] or b"") for r in rows[-64:]) > 4 << 20 or len(rows) >= 512:
                    yield _members(rows)
                    rows = []
            yield _members(rows)

    return run


def _members(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of normalised archives, found by the index: page_id,
    payload_bytes, payload_digest, record_type, refers_to, url, payload (null
    for a revisit, whose size and digest are of the payload it refers to).
    As many tasks read as there are archives, each a range of members."""
    index = spark.read.schema(_INDEX).json(f"{folder}/*.idx.json")
    archives = max(1, index.agg(F.count_distinct("archive")).first()[0])  # the index is small, what it tells to read isn't
    index = index.select("archive", "offset", "length").repartitionByRange(archives, "archive", "offset")
    index = index.sortWithinPartitions("archive", "offset")
    return index.mapInArrow(
        _read_members(),
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary",
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (needs page_id, url, html; other columns are not read)
    to monolithic archives, normalise them and read the members back.

    Null or empty html: a response of zero bytes.  Null url: no URI.  Null
    page_id: a response that nothing refers to.  Rows that repeat the
    group's largest page_id are all responses.  Empty table: no rows.
    """
    spark = pages.sparkSession
    return read_records(spark, normalise(spark, write_monolithic(pages)))
