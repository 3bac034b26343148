"""Operator 7, converter of legacy ARC archives to WARC.

An ARC file is a version block (``filedesc://``; its second line gives the
version) and records of one header line, a declared length and that many
bytes.  Version 1 header lines have five fields (URL, IP address, date, type,
length); version 2 lines have ten (result code, checksum, location, offset and
file name before the length).  ``read_arc`` parses both by the version their
file declares.  ``to_warc`` synthesises what WARC asks for: record ids (UUIDs
from archive name and offset), ISO timestamps, types, block and payload
digests; of records with equal payloads of at least ``revisit_bytes`` bytes the
one with the smallest page_id is the response and the others become revisits
that refer to it.  ``read_warc`` parses WARC files by their declared lengths.

Archives are written by Spark's text sink (bytes of each record as a row), one
gzip file a task of about ``FILE_BYTES`` of payload, and read whole, one file a
row.  A record larger than that has a file to itself and its neighbours.

Records are dealt to archives by the place of their row, so any number of repeated
rows spreads over them.  A malformed record ends the job, or with
``errors="stop"`` its archive only: the records before it are converted, and
``arc_errors`` names archive, offset and reason.

Null URLs are written as ``-``, white space in URLs is percent-encoded, bytes of a URL
that are no UTF-8 become U+FFFD, null html is an empty payload, a null page_id stays
null (and is the last to be a response).  Repeated rows are records of their own.
Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm.common import row_places, stored
from stellate.session import scratch_path

FILE_BYTES, REVISIT_BYTES = 12 << 20, 100
EPOCH = 946684800  # 2000-01-01: pages carry no time, so their id counts seconds from here
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# Header fields of ARC versions 1 and 2.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _bytes(text: Column) -> Column:
    return F.octet_length(text)


def write_arc(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> int:
    """pages (page_id, url, html) as ARC files path/archive=N/; even N are version 1, odd N version 2.  Returns their number."""
    own = row_places(pages, F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    total = own.agg(F.sum(_bytes(F.col("html")))).first()[0] or 0
    files = max(2, -(-int(total) // file_bytes))
    when = F.from_unixtime(F.lit(EPOCH) + F.coalesce(F.pmod("page_id", F.lit(1 << 31)), F.lit(0)), "yyyyMMddHHmmss")
    url = F.coalesce(F.regexp_replace(F.nullif(F.col("url"), F.lit("")), r"[\x00-\x20\x7f]", "%20"), F.lit("-"))
    second = F.col("archive") % 2 == 1
    line = _text(url, " 0.0.0.0 ", when, " text/html ", F.when(second, "200 - - 0 pages.arc ").otherwise(""))
    block = _text(HTTP, "X-Page-Id: ", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "\r\nContent-Length: ", _bytes(F.col("html")).cast("string"), "\r\n\r\n", F.col("html"))
    # dealt by the row's place, not by content or identity: equal pages and repeated rows spread over the archives
    records = own.withColumn("archive", F.pmod(F.xxhash64("place_file", "place_row"), F.lit(files)).cast("int")).withColumn("block", block)
    records = records.select("archive", F.lit(1).alias("ord"), _text(line, _bytes(F.col("block")).cast("string"), "\n", F.col("block")).alias("value"))
    about = F.when(second, _text("2 0 stellate\n", FIELDS[2], "\n")).otherwise(_text("1 0 stellate\n", FIELDS[1], "\n"))
    name = _text("filedesc://pages-", F.col("archive").cast("string"), ".arc 0.0.0.0 20000101000000 text/plain ", F.when(second, "200 - - 0 pages.arc ").otherwise(""))
    head = pages.sparkSession.range(files).select(F.col("id").cast("int").alias("archive"))
    head = head.withColumn("about", about).select("archive", F.lit(0).alias("ord"), _text(name, _bytes(F.col("about")).cast("string"), "\n", F.col("about")).alias("value"))
    (head.unionByName(records).repartition(files, "archive").sortWithinPartitions("archive", "ord").select("archive", "value")
     .write.partitionBy("archive").options(**GZIP, lineSep="\n").text(path))
    return files


def archives(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: its archive's number and whole content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select(
        F.regexp_extract("path", r"archive=(\d+)/", 1).alias("archive"), "content")


def parse_arc(raw: bytes) -> Iterator[dict]:
    """Records of one ARC file, by the header fields its version block declares."""
    data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    at, version = 0, None
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        eol = data.find(b"\n", at)
        fields = data[at:eol].rstrip(b"\r").split(b" ")
        if eol < 0 or not fields[-1].isdigit():
            raise ValueError(f"ARC header at {at} declares no length")
        size = int(fields[-1])
        block = data[eol + 1 : eol + 1 + size]
        if len(block) != size:
            raise ValueError(f"ARC record at {at} is cut short")
        if fields[0].startswith(b"filedesc://"):
            version = int(block.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        else:
            names = FIELDS[version].split(" ") if version else []
            if len(names) != len(fields):
                raise ValueError(f"ARC header at {at} does not have the fields of version {version}")
            got = dict(zip(names, fields))
            head, _, payload = block.partition(b"\r\n\r\n")
            text = {k: v.decode("utf-8", "replace") for k, v in got.items()}
            yield {"offset": at, "version": version, "url": text["URL"], "ip": text["IP-address"], "date": text["Archive-date"],
                   "status": text.get("Result-code", "200"), "http": head, "payload": payload, "page_id": _page_id(head)}
        at = eol + 1 + size


def _records(raw: bytes, errors: str) -> Iterator[dict]:
    """Records of one file; with ``stop``, those before the first malformed one."""
    try:
        yield from parse_arc(raw)
    except ValueError:
        if errors == "raise":
            raise


def _page_id(http: bytes) -> int | None:
    for line in http.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == b"x-page-id":
            return int(value) if value.strip().lstrip(b"-").isdigit() else None
    return None


def _record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'pages-{archive}.arc/{offset}')}>"


def _arc_task(errors: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, raw in zip(batch.column(0), batch.column(1)):
                rows = [(archive.as_py(), r["offset"], r["version"], r["url"], r["page_id"], len(r["payload"]), hashlib.sha256(r["payload"]).hexdigest())
                        for r in _records(raw.as_py(), errors)]
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                          ["archive", "offset", "version", "url", "page_id", "payload_bytes", "payload_digest"])
    return run


def read_arc(spark: SparkSession, path: str, errors: str = "raise") -> DataFrame:
    """archive, offset, version, url, page_id, payload_bytes, payload_digest of every record."""
    return archives(spark, path).mapInArrow(_arc_task(errors), "archive string, offset long, version int, url string, page_id long, payload_bytes long, payload_digest string")


def _error_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, raw in zip(batch.column(0), batch.column(1)):
            good = 0
            try:
                for _ in parse_arc(raw.as_py()):
                    good += 1
            except ValueError as e:
                yield pa.record_batch([pa.array([archive.as_py()]), pa.array([good], pa.int64()), pa.array([str(e)])], ["archive", "records_before", "error"])


def arc_errors(spark: SparkSession, path: str) -> DataFrame:
    """archive, records_before, error of every archive with a malformed record."""
    return archives(spark, path).mapInArrow(_error_rows, "archive string, records_before long, error string")


def _warc(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.0", *(f"{k}: {v}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n"  # the sink ends it with another line end


def _iso(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def _convert_task(errors: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _converted(batches, errors)
    return run


def _converted(batches: Iterator[pa.RecordBatch], errors: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, raw, lists in zip(batch.column(0), batch.column(1), batch.column(2)):
            archive = archive.as_py()
            refers = {x["offset"]: x for x in lists.as_py() or []}
            about = f"software: stellate\r\nformat: WARC File Format 1.0\r\nconverted-from: pages-{archive}.arc\r\n".encode()
            out = [_warc([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(archive, -1)), ("WARC-Date", "2000-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], about)]
            size = 0
            for r in _records(raw.as_py(), errors):
                to = refers.get(r["offset"])
                head = r["http"] + b"\r\n\r\n"
                block = head if to else head + r["payload"]
                fields = [("WARC-Type", "revisit" if to else "response"), ("WARC-Record-ID", _record_id(archive, r["offset"])), ("WARC-Date", _iso(r["date"])),
                          ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"]), ("Content-Type", "application/http; msgtype=response"),
                          ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(r["payload"]).hexdigest()), ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest())]
                if to:
                    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(to["to_archive"], to["to_offset"]))]
                out.append(_warc(fields, block))
                size += len(block)
                if size > 1 << 21:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(out, pa.binary())], ["value"])


def to_warc(spark: SparkSession, arc_path: str, path: str, files: int, revisit_bytes: int = REVISIT_BYTES, errors: str = "raise") -> None:
    """Convert the ARC files under ``arc_path`` into WARC files under ``path``."""
    rows = stored(read_arc(spark, arc_path, errors), "arc-records")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "archive", "offset")
    first = rows.where(F.col("payload_bytes") >= revisit_bytes).groupBy("payload_digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = rows.where(F.col("payload_bytes") >= revisit_bytes).join(first, "payload_digest").where("not (archive = first.archive and offset = first.offset)")
    # one list an archive: no longer than the archive's records
    lists = again.groupBy("archive").agg(F.collect_list(F.struct("offset", F.col("first.archive").alias("to_archive"), F.col("first.offset").alias("to_offset"))).alias("lists"))
    both = archives(spark, arc_path).repartition(files, "archive").join(lists.repartition(files, "archive"), "archive", "left")
    both.select("archive", "content", "lists").mapInArrow(_convert_task(errors), "value binary").select(F.col("value").cast("string").alias("value")).write.options(
        **GZIP, lineSep="\r\n").text(path)


def parse_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of one WARC file, by declared length."""
    data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.0":
            raise ValueError(f"no WARC record at {at}")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head["content-length"])
        block = data[end + 4 : end + 4 + size]
        if data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"WARC record at {at} does not end where it says")
        yield head, block
        at = end + 8 + size


def _warc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column(1):
            rows = []
            for head, block in parse_warc(raw.as_py()):
                kind = head["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = head["warc-payload-digest"].removeprefix("sha256:")
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {head['warc-record-id']} does not have its digest")
                rows.append((_page_id(http), head["warc-record-id"], kind, len(payload) if kind == "response" else None, digest, head.get("warc-refers-to"),
                             head["warc-target-uri"], head["warc-date"]))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 4))],
                                      ["page_id", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_id", "url", "date"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_id, record_type, payload_bytes (null for revisits), payload_digest (checked), refers_id, url, date."""
    return archives(spark, path).mapInArrow(_warc_rows, "page_id long, record_id string, record_type string, payload_bytes long, payload_digest string, refers_id string, url string, date string")


def convert_pages(pages: DataFrame, file_bytes: int = FILE_BYTES, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages through ARC files to WARC files and back: page_id, payload_bytes, payload_digest, record_type, refers_to, url, date."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    files = write_arc(pages, arc, file_bytes)
    to_warc(spark, arc, warc, files, revisit_bytes)
    rows = stored(read_warc(spark, warc), "warc-records")
    held = rows.where("record_type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_full"))
    again = rows.where("record_type = 'revisit'").join(held, "refers_id")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "date"]
    return rows.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).select(*out).unionByName(
        again.withColumn("payload_bytes", F.col("_full")).select(*out))
