"""Reading and writing ZIP-packaged archives of WARC records by ranges.

A package is a ZIP file whose members are stored, not compressed: the WARC files under
``archive/`` (one gzip member for each record) and an index under ``indexes/``.  So a
record lies at a known place of the package and is read by its range, without taking
anything apart.

``Package`` reads the end record, its ZIP64 form where there is one, and the central
directory, then finds a member's bytes by its local header.  It needs only a function
that reads a range.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
_END_SIZE, _LOCATOR_SIZE, _LOCAL_SIZE, _CENTRAL_SIZE = 22, 20, 30, 46
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    stored: int             # bytes in the package
    crc: int
    header: int             # where its local header starts


class Package:
    """The directory of a ZIP file of ``size`` bytes behind ``read(start, length)``."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.size = read, size
        self.members = {m.name: m for m in self._directory()}

    def _end(self) -> tuple[int, int, int]:
        """(number of members, size of the directory, its start)."""
        tail_at = max(0, self.size - _END_SIZE - _FULL16)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(_END)
        while at >= 0:                  # a comment may hold the mark: the right one ends the file
            if at + _END_SIZE <= len(tail) and at + _END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end of a ZIP directory")
        _, _, _, count, length, start, _ = struct.unpack_from("<4H2LH", tail, at + 4)
        if _FULL16 == count or _FULL32 in (length, start):
            place = tail_at + at - _LOCATOR_SIZE
            locator = self.read(place, _LOCATOR_SIZE) if place >= 0 else b""
            if locator[:4] == _LOCATOR64:
                record = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
                if record[:4] != _END64:
                    raise ValueError("no ZIP64 end record where its locator points")
                count, length, start = struct.unpack_from("<QQQ", record, 32)
        return count, length, start

    def _directory(self):
        count, length, start = self._end()
        raw, at = self.read(start, length), 0
        for _ in range(count):
            if raw[at:at + 4] != _CENTRAL:
                raise ValueError("broken ZIP directory")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            crc, stored, size, n_name, n_extra, n_comment = struct.unpack_from("<3L3H", raw, at + 16)
            header, = struct.unpack_from("<L", raw, at + 42)
            name = raw[at + _CENTRAL_SIZE:at + _CENTRAL_SIZE + n_name]
            extra = raw[at + _CENTRAL_SIZE + n_name:at + _CENTRAL_SIZE + n_name + n_extra]
            size, stored, header = self._wide(extra, size, stored, header)
            yield Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, size, stored, crc, header)
            at += _CENTRAL_SIZE + n_name + n_extra + n_comment

    @staticmethod
    def _wide(extra: bytes, *values: int) -> list[int]:
        """Values of all ones stand in the ZIP64 field, in this order."""
        at, out = 0, list(values)
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                field = at + 4
                for i, v in enumerate(values):
                    if v == _FULL32 and field + 8 <= at + 4 + n:
                        out[i], = struct.unpack_from("<Q", extra, field)
                        field += 8
            at += 4 + n
        return out

    def start(self, name: str) -> int:
        """Where the bytes of a member start, which must be stored as they are."""
        m = self.members[name]
        if m.method != 0:
            raise ValueError(f"{name} is compressed: its ranges cannot be read")
        header = self.read(m.header, _LOCAL_SIZE)
        if header[:4] != _LOCAL:
            raise ValueError(f"no local header of {name}")
        n_name, n_extra = struct.unpack_from("<HH", header, 26)
        return m.header + _LOCAL_SIZE + n_name + n_extra

    def member(self, name: str) -> bytes:
        raw = self.read(self.start(name), self.members[name].stored)
        if zlib.crc32(raw) != self.members[name].crc:
            raise ValueError(f"{name} is damaged")
        return raw


def gzip_member(raw: bytes) -> bytes:
    return (c := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(raw) + c.flush()


def warc_record(headers: dict[str, str], body: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-case names, block) of one gzip member."""
    plain = zlib.decompress(raw, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return headers, rest[:int(headers["content-length"])]


def index_lines(entries) -> bytes:
    return "".join(json.dumps(e, separators=(",", ":")) + "\n" for e in entries).encode("utf-8")


def read_index(raw: bytes):
    return [json.loads(x) for x in raw.decode("utf-8").splitlines() if x]
