"""WARC records of pages in ZIP-packaged archives, written and read back by Spark.

Writing: of pages with equal payloads of at least ``min_bytes`` bytes the one with the
largest id is a ``response``, the others are ``revisit`` records that name it; smaller
payloads are all responses.  The digest of a payload is counted and its largest id taken
with pre-aggregation, so a payload that a third of all pages share is one partial row
per task.  Each task streams its records into packages of about ``package_bytes``.

Reading takes two steps, so a large package is read by many tasks: its directory and
index become one row for each record, these rows are dealt out, and every record is
range-read and parsed.

Defined results: a null payload is empty; a null URL is written as the record's id alone;
pages with the same id and payload are one page of that id more than once; a row with a
null id has no digest of its own to be referred to but is written; an empty table gives no
rows; other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, saved, scratch
from .files import filesystem, write_bytes
from .zip_archive import Package, gzip_member, index_lines, parse_record, read_index, warc_record

_WARC, _INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
_DATE = "2024-01-01T00:00:00Z"
_ID = "urn:page:"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page, url, payload: bytes, kept) -> bytes:
    """A response or, if another page is kept for its payload, a revisit."""
    same = kept is None or kept == page
    headers = {"WARC-Type": "response" if same else "revisit", "WARC-Record-ID": f"<{_ID}{'' if page is None else page}>",
               "WARC-Date": _DATE}
    if url is not None:
        headers["WARC-Target-URI"] = " ".join(url.split())
    headers |= {"WARC-Payload-Digest": f"sha1:{_digest(payload)}", "X-Payload-Length": str(len(payload)),
                "Content-Type": "application/http;msgtype=response"}
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if same:
        return warc_record(headers, http + payload)
    headers |= {"WARC-Refers-To": f"<{_ID}{kept}>",
                "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    return warc_record(headers, http)


def _package(records: list[bytes], entries: list[dict]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, raw in ((_WARC, b"".join(records)), (_INDEX, index_lines(entries))):
            z.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), raw)
    return out.getvalue()


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, package_bytes: int = 64 << 20) -> DataFrame:
    """(path, size, records) of the packages written under ``folder``."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.sha2(F.encode(payload, "utf-8"), 256).alias("same"))
    kept = rows.where(F.octet_length("payload") >= min_bytes).groupBy("same").agg(
        F.max("page").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").select("same", "kept")
    whole = rows.join(kept, "same", "left").select("page", "url", "payload", "kept")

    def run(batches):
        records, entries, at = [], [], 0

        def close():
            path, raw = f"{folder}/{uuid.uuid4().hex}.zip", _package(records, entries)
            write_bytes(path, raw)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(raw)]), pa.array([len(records)])],
                                              names=["path", "size", "records"])

        for batch in batches:
            for page, url, text, keep in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "payload", "kept")), strict=True):
                raw = gzip_member(_record(page, url, text.encode("utf-8"), keep))
                records.append(raw)
                entries.append({"offset": at, "length": len(raw)})
                at += len(raw)
                if at >= package_bytes:
                    yield close()
                    records, entries, at = [], [], 0
        if records:
            yield close()

    return saved(whole.mapInArrow(run, "path string, size long, records long"), "packages")


def _reader(path: str):
    fs, name = filesystem(path)
    file = fs.open_input_file(name)

    def read(start: int, length: int) -> bytes:
        file.seek(start)
        return file.read(length)
    return read


def read_packages(packages: DataFrame) -> DataFrame:
    """One row for each record of ``packages`` (path, size): its headers and payload."""
    def locate(batches):
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
                p = Package(_reader(path), size)
                base = {n: p.start(n) for n in p.members if n.startswith("archive/")}
                for index in (n for n in p.members if n.startswith("indexes/")):
                    lines = read_index(p.member(index))
                    name = next(iter(base))
                    for lo in range(0, len(lines), 10_000):
                        some = lines[lo:lo + 10_000]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([path] * len(some)), pa.array([base[name] + e["offset"] for e in some], pa.int64()),
                            pa.array([e["length"] for e in some], pa.int64())], names=["path", "offset", "length"])

    def fetch(batches):
        opened: dict[str, object] = {}
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True):
                if path not in opened:
                    opened.clear()                       # rows come sorted by path: one file at a time
                    opened[path] = _reader(path)
                headers, block = parse_record(opened[path](offset, length))
                payload = block.partition(b"\r\n\r\n")[2]
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                if kind == "response" and _digest(payload) != digest:
                    raise ValueError(f"a record of {path} at {offset} is damaged")
                name = lambda k: headers.get(k, "").strip("<>").removeprefix(_ID) or None  # noqa: E731, B023
                for col, x in zip(out, (name("warc-record-id"), headers.get("warc-target-uri"), kind,
                                        int(headers["x-payload-length"]), digest, name("warc-refers-to"),
                                        payload if kind == "response" else None), strict=True):
                    col.append(x)
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)],
                                             names=["record_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])

    places = packages.select("path", "size").mapInArrow(locate, "path string, offset long, length long")
    dealt = places.repartition(partitions(packages.sparkSession), "path", F.floor(F.col("offset") / (1 << 22))).sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(fetch, "record_id string, url string, record_type string, payload_bytes long, "
                                   "payload_digest string, refers_to string, payload binary")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to packages in the shared folder and read all records back."""
    folder = scratch(pages.sparkSession, "warc")
    return read_packages(write_packages(pages, folder, id_col, url_col, payload_col, min_bytes))
