"""Legacy archives (ARC) to WARC.

An ARC file starts with a version block: a ``filedesc:`` record whose body names the version and
the fields of the header lines that follow. Version 1 lines have five fields, version 2 lines ten;
the last one is the declared length of the body, which alone tells where a record ends. The
converter reads lines by the fields that the file declares and writes what WARC asks for and ARC
does not have: record ids (a name-based UUID of the record's place, address and date), ISO
timestamps, record types and SHA-1 digests. Of records with equal bodies one is a response, the
others are revisits of it.

Files are written by Spark's committed text writer (one row per record, gzip), so nothing of a lost
task stays, and read back as binary files by any file system that Spark reads.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from limitlens.llm.tables import answer_groups, keep, scratch, text_bytes

# Header fields of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "limitlens/warc")
# Blanks and control characters cannot stand in a header line. The mark tells whether an address had any.
_UNFIT = re.compile(r"[\x00-\x20\x7f]")
_MARK, _ESCAPED_MARK = "#page_id=", "#escaped_page_id="


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _fit(address: str) -> tuple[str, bool]:
    """An address as a header can carry it: unchanged, or with what is unfit (and then every percent sign) escaped."""
    if not _UNFIT.search(address):
        return address, False
    return _UNFIT.sub(lambda c: f"%{ord(c[0]):02X}", address.replace("%", "%25")), True


def _unescaped(address: str) -> str:
    return re.sub("%([0-9A-F]{2})", lambda code: chr(int(code[1], 16)), address)


def _archive_url(url: str | None, page_id: int | None) -> str:
    """The address, and the page's number as a fragment."""
    address, escaped = _fit(url or "-")
    return address + (_ESCAPED_MARK if escaped else _MARK) + ("-" if page_id is None else str(page_id))


def _page_of(url: str) -> tuple[str, int | None]:
    """The address as it was, and the page's number; an address without a mark (of another archive) is left as it is."""
    for mark in (_MARK, _ESCAPED_MARK):
        address, found, page = url.rpartition(mark)
        if found and (page == "-" or page.lstrip("-").isdecimal()):
            return _unescaped(address) if mark == _ESCAPED_MARK else address, None if page == "-" else int(page)
    return url, None


def _write_arc(date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        version, name, place, started = 1 + number % 2, f"pages-{number:06d}.arc", 0, False

        def record(url: str, kind: str, body: bytes, digest: str) -> bytes:
            fields = [url, "0.0.0.0", date, kind]
            if version == 2:
                fields += ["200", digest, "-", str(place), name]
            return " ".join([*fields, str(len(body))]).encode() + b"\n" + body

        for batch in batches:
            rows = []
            if not started:
                body = f"{version} 0 limitlens\n{ARC_FIELDS[version]}\n".encode()
                rows.append(record(f"filedesc://{name}", "text/plain", body, "-"))
                place, started = len(rows[0]) + 1, True
            for page_id, url, payload in zip(*map(batch.column, ("page_id", "url", "payload")), strict=True):
                body = payload.as_py()
                digest = payload_digest(body) if version == 2 else "-"
                rows.append(record(_archive_url(url.as_py(), page_id.as_py()), "text/html", body, digest))
                place += len(rows[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    return write


def _write_rows(records: DataFrame, folder: str) -> None:
    rows = records.select(F.col("value").cast("string").alias("value"))  # the bytes stay as they are
    rows.write.option("lineSep", "\n").option("compression", "gzip").text(folder)


def write_arc(pages: DataFrame, folder: str, date: str = "20240101000000") -> None:
    """Archive ``page_id, url, html`` (null html: empty) as ARC files, both versions in turn."""
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), text_bytes("html").alias("payload")
    )
    _write_rows(rows.mapInArrow(_write_arc(date), "value binary"), folder)


def _unzipped(content: bytes) -> bytes:
    """All members of a gzip file; other files as they are."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


def arc_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, header fields by name, and body of every record after the version block."""
    content = _unzipped(content)
    names, place = ARC_FIELDS[1].split(), 0
    while True:
        while content[place : place + 1] in (b"\n", b"\r"):
            place += 1
        if place >= len(content):
            return
        line_end = content.index(b"\n", place)
        line = content[place:line_end].decode("utf-8", "replace").rstrip("\r")
        length = int(line.rpartition(" ")[2])
        body = content[line_end + 1 : line_end + 1 + length]
        if len(body) < length:
            raise ValueError(f"record at byte {place} declares {length} bytes, {len(body)} are left")
        if line.startswith("filedesc:"):
            version, declared = body.decode("utf-8", "replace").split("\n")[:2]
            names = (declared or ARC_FIELDS[int(version.split(" ")[0])]).split()
        else:
            # Old tools left blanks in addresses: the other fields are counted from the right.
            yield place, dict(zip(names, line.rsplit(" ", len(names) - 1), strict=True)), body
        place = line_end + 1 + length


def _parsed(with_payload: bool):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                file, rows, size = path.as_py(), [], 0
                for place, header, body in arc_records(content.as_py()):
                    url, page_id = _page_of(header["URL"])
                    row = (file, place, page_id)
                    if with_payload:
                        rows.append((*row, url, header["Archive-date"], header["Content-type"], body))
                        size += len(body)
                    else:
                        rows.append((*row, payload_digest(body), len(body)))
                    if size > 4 << 20 or len(rows) >= 10_000:
                        yield _batch(rows, with_payload)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, with_payload)

    return parse


_KEY = "file string, place long, page_id long"
_WITH_PAYLOAD = f"{_KEY}, url string, archive_date string, content_type string, payload binary"
_WITH_DIGEST = f"{_KEY}, payload_digest string, payload_bytes long"


def _batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    schema = _WITH_PAYLOAD if with_payload else _WITH_DIGEST
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*[part.split() for part in schema.split(", ")], strict=True)
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names)
    )


def _record_id(place: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, place)}>"


def _iso(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc_record(headers: list[tuple[str, str]], body: bytes) -> bytes:
    """A record without its last newline, which the writer adds."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(body)))])
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r"


def _write_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, started = TaskContext.get().partitionId(), False
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            date = _iso(row["archive_date"])
            if not started:
                info = b"software: limitlens\r\nformat: WARC File Format 1.0\r\n"
                out.append(_warc_record([
                    ("WARC-Type", "warcinfo"), ("WARC-Date", date),
                    ("WARC-Record-ID", _record_id(f"info {number}")),
                    ("WARC-Filename", f"pages-{number:06d}.warc.gz"),
                    ("Content-Type", "application/warc-fields"),
                ], info))
                started = True
            page = "-" if row["page_id"] is None else str(row["page_id"])
            address, escaped = _fit(row["url"])
            headers = [
                ("WARC-Type", row["record_type"]), ("WARC-Date", date),
                ("WARC-Record-ID", _record_id(f"{row['file'].rpartition('/')[2]} {row['place']} {row['url']} {page}")),
                ("WARC-Target-URI", address),
                ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
                ("Content-Type", row["content_type"]), ("X-Page-ID", page),
            ]
            if escaped:
                headers.append(("X-Escaped-URI", "yes"))
            if row["record_type"] == "revisit":
                headers += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page", str(row["refers_to"])),
                            ("X-Payload-Length", str(row["payload_bytes"]))]
            body = b"" if row["record_type"] == "revisit" else row["payload"]
            headers.append(("WARC-Block-Digest", f"sha1:{payload_digest(body)}"))
            out.append(_warc_record(headers, body))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, least_bytes: int = 0) -> None:
    """Write WARC files with one record per ARC record.

    Of records with equal bodies of at least ``least_bytes`` bytes the one with the largest
    page_id is the response. Repeated rows of that page are responses too. A record without page id
    is a response only where no equal body has one.
    """
    files = spark.read.format("binaryFile").load(arc_folder).select("path", "content")
    index = keep(files.mapInArrow(_parsed(False), _WITH_DIGEST), "arc-index")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    decided = answer_groups(
        index.withColumn("_spread", F.pmod(F.xxhash64("file", "place"), F.lit(partitions))),
        ["payload_digest", "payload_bytes"], "_spread",
        {"response": ("_largest", F.max("page_id"), "max")},
    )
    revisit = (
        (F.col("payload_bytes") >= least_bytes)
        & F.col("response").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("response"))
    )
    decided = decided.select(
        "file", "place", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response")).alias("refers_to"),
    )
    records = files.mapInArrow(_parsed(True), _WITH_PAYLOAD).join(decided, ["file", "place"])
    _write_rows(records.mapInArrow(_write_warc, "value binary"), warc_folder)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record."""
    content, place = _unzipped(content), 0
    while place < len(content):
        head_end = content.index(b"\r\n\r\n", place)
        lines = content[place:head_end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {place}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = head_end + 4
        stop = start + int(headers["Content-Length"])
        yield headers, content[start:stop]
        place = stop + 4


_RESULT = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "record_id string, url string, warc_date string"
)


def _read_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _RESULT.split(", ")]
    kinds = [pa.int64() if part.endswith("long") else pa.string() for part in _RESULT.split(", ")]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for head, block in warc_records(content.as_py()):
                if head["WARC-Type"] == "warcinfo":
                    continue
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                revisit = head["WARC-Type"] == "revisit"
                if not revisit and payload_digest(block) != digest:
                    raise ValueError(f"{head['WARC-Record-ID']}: the block does not have its digest")
                page, address = head["X-Page-ID"], head["WARC-Target-URI"]
                if "X-Escaped-URI" in head:
                    address = _unescaped(address)
                rows.append((
                    None if page == "-" else int(page),
                    int(head["X-Payload-Length"]) if revisit else len(block),
                    digest, head["WARC-Type"], int(head["X-Refers-To-Page"]) if revisit else None,
                    head["WARC-Record-ID"], address, head["WARC-Date"],
                ))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
                )


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record; blocks are checked against their digests."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(_read_warc, _RESULT)


def pages_through_archives(pages: DataFrame) -> DataFrame:
    """Pages to ARC, ARC to WARC, WARC back to rows; see :func:`convert` for the types.

    Null html counts as empty, a null or empty url is written as ``-``; any other url comes back as it was, percent
    signs included: only blanks and control characters are escaped on the way. Texts of any length are whole
    records; extra columns are ignored; no pages give no rows.
    """
    spark = pages.sparkSession
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc)
    return read_warc(spark, warc)
