"""Token ids in files of range-coded blocks, in ascending order of document ids.

Writing:

1. Each text is tokenised once, in the task that reads it, and closed by the end id; ids are
   kept in the shared folder, as 16 bits each where the vocabulary allows.
2. One frequency table is counted over all ids (at most one row for each id of the vocabulary
   reaches the driver) and stored once in the folder of the files.
3. The documents are range-sorted by id over all tasks; each task codes its range into one file.
   Rows of equal ids are ordered among themselves by a stored row number, so one id that a third
   of all rows have is dealt over several files as well.

A file holds independent blocks of ``range_coder`` (32,768 ids, with checkpoints and checksums
inside), then an index (document ids, which of them are null, first token of each document, place of
each block) and a footer with the index's checksum.  It appears whole or not at all under a
name of its own, so a repeated task leaves at worst a file that no list names.  The list of the files, in
units of about ``UNIT`` ids that end at documents, is what readers are dealt.

Reading: a unit looks up its documents in the index, starts at the checkpoint before its first
token and decodes a bounded number of checkpoint parts at a time side by side, so a document of any
length is read in bounded memory; documents longer than a unit are a unit of their own.

Defined results: a null or empty text is the end id alone; a null document id comes first; rows of
equal ids are documents of their own, in any order among themselves; an empty table writes no
file and gives no rows; other columns are never read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from . import range_coder as R
from .byte_pairs import encoder
from .common import partitions, saved, scratch
from .files import filesystem, write_bytes
from .kneser_ney import slices
from .packing import END_ID

UNIT = 1 << 20                  # ids of a reading unit, about
GROUP = 16 * R.BLOCK            # ids that are coded or decoded at once
MAGIC = b"TOKRANS1"
_FOOT = struct.Struct("<5QI8s")  # documents, ids, blocks, place of the index, its size, its checksum, magic


# -- one file ---------------------------------------------------------------------------

class Writer:
    """Writes documents into one file; ``close`` gives the units (documents from, to, ids)."""

    def __init__(self, uri: str, table: R.Table):
        self.fs, self.path = filesystem(uri)
        self.partial = f"{self.path}.{uuid.uuid4().hex}"
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = self.fs.open_output_stream(self.partial)
        self.out.write(MAGIC)
        self.place, self.table = len(MAGIC), table
        self.held, self.n_held = [], 0
        self.doc_ids, self.nulls, self.starts, self.blocks = [], [], [0], []
        self.units, self.first = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.starts[-1] + len(ids) - self.starts[self.first] > UNIT and len(self.doc_ids) > self.first:
            self._unit()
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= GROUP:
            self._code(self.n_held // R.BLOCK * R.BLOCK)

    def _unit(self) -> None:
        self.units.append((self.first, len(self.doc_ids), self.starts[-1] - self.starts[self.first]))
        self.first = len(self.doc_ids)

    def _code(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for lo in range(0, n, GROUP):
            for raw in R.encode(ids[lo:min(lo + GROUP, n)], self.table):
                self.blocks.append(self.place)
                self.out.write(raw)
                self.place += len(raw)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> list[tuple[int, int, int]]:
        self._code(self.n_held)
        if len(self.doc_ids) > self.first:
            self._unit()
        index = b"".join((np.array(self.doc_ids, "<i8").tobytes(), np.array(self.starts, "<u8").tobytes(),
                          np.array([*self.blocks, self.place], "<u8").tobytes(), np.array(self.nulls, np.uint8).tobytes()))
        self.out.write(index)
        self.out.write(_FOOT.pack(len(self.doc_ids), self.starts[-1], len(self.blocks), self.place, len(index), zlib.crc32(index), MAGIC))
        self.out.close()
        self.fs.move(self.partial, self.path)
        return self.units


class Reader:
    """Reads documents of one file by their number in it."""

    def __init__(self, uri: str, table: R.Table, slots: np.ndarray):
        fs, path = filesystem(uri)
        self.file, self.table, self.slots = fs.open_input_file(path), table, slots
        size = self.file.size()
        foot = self._at(size - _FOOT.size, _FOOT.size)
        self.n_docs, self.n_ids, self.n_blocks, self.index, self.index_size, self.check, magic = _FOOT.unpack(foot)
        if magic != MAGIC or self.index + self.index_size + _FOOT.size != size:
            raise ValueError(f"{uri} is no whole file of token ids")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def _at(self, place: int, size: int) -> bytes:
        got = self.file.read_at(size, place)
        if len(got) != size:
            raise ValueError("the file ends too early")
        return got

    def verify_index(self) -> None:
        check = 0
        for lo in range(0, self.index_size, 1 << 22):
            check = zlib.crc32(self._at(self.index + lo, min(1 << 22, self.index_size - lo)), check)
        if check != self.check:
            raise ValueError("the index is damaged")

    def documents(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, which are null, first tokens and the end) of documents ``lo`` to ``hi``."""
        after = self.index + 8 * (2 * self.n_docs + 1) + 8 * (self.n_blocks + 1)
        return (np.frombuffer(self._at(self.index + 8 * lo, 8 * (hi - lo)), "<i8"),
                np.frombuffer(self._at(after + lo, hi - lo), np.uint8).astype(bool),
                np.frombuffer(self._at(self.index + 8 * (self.n_docs + lo), 8 * (hi - lo + 1)), "<u8").astype(np.int64))

    def ids(self, lo: int, hi: int):
        """Token ids ``lo`` to ``hi`` of the file in order, a bounded number at a time."""
        each, per = R.STEPS * R.LANES, R.BLOCK // (R.STEPS * R.LANES)
        parts, last = list(range(lo // each, -(-hi // each))), GROUP // each
        for k in range(0, len(parts), last):
            mine = parts[k:k + last]
            first, past = mine[0] // per, mine[-1] // per + 1
            place = np.frombuffer(self._at(self.index + 8 * (2 * self.n_docs + 1 + first), 8 * (past - first + 1)), "<u8").astype(np.int64)
            raw = memoryview(self._at(int(place[0]), int(place[-1] - place[0])))
            blocks = [R.Block(raw[a - place[0]:b - place[0]]) for a, b in zip(place[:-1], place[1:], strict=True)]
            got = np.concatenate(R.decode([(blocks[p // per - first], p % per) for p in mine], self.table, self.slots))
            begin = mine[0] * each
            yield got[max(lo - begin, 0):hi - begin]


# -- Spark ------------------------------------------------------------------------------------

@dataclass
class TokenFiles:
    """A written set of files: ``units`` lists (part, path, doc_from, doc_to, ids) of all files."""
    folder: str
    units: DataFrame


def tokenised(docs: DataFrame, vocabulary: str, ranks: str | None, id_col: str, text_col: str) -> DataFrame:
    """(id, ids) with the ids of each text and the end id as little-endian numbers of 16 or 32 bits."""
    def run(batches):
        encode = encoder(vocabulary, ranks, END_ID)
        for batch in batches:
            for some in slices(batch, "text"):
                out = [encode(t or "") for t in some.column("text").to_pylist()]
                wide = [x.max() >= 1 << 16 for x in out]
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), pa.array([(x if w else x.astype("<u2")).tobytes() for x, w in zip(out, wide, strict=True)], pa.binary()),
                     pa.array([4 if w else 2 for w in wide], pa.int8())], names=["id", "ids", "width"])
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "id long, ids binary, width byte")


def _numbers(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{width}").astype(np.uint32)


def frequencies(tokens: DataFrame) -> R.Table | None:
    """The frequency table of all ids; None without any."""
    def run(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for some in slices(batch, "ids"):
                raw, wide = some.column("ids"), np.asarray(some.column("width"))
                for width in (2, 4):
                    mine = raw.filter(pa.array(wide == width)).to_pylist()
                    got = np.bincount(_numbers(b"".join(mine), width))
                    if len(got) > len(total):
                        total = np.pad(total, (0, len(got) - len(total)))
                    total[:len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["symbol", "n"])
    counts = tokens.select("ids", "width").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    rows = counts.orderBy("symbol").collect()                            # at most as many as the vocabulary has
    return R.Table.of_counts(np.array([r.symbol for r in rows]), np.array([r.n for r in rows])) if rows else None


def write(docs: DataFrame, vocabulary: str, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          folder: str | None = None) -> TokenFiles:
    """Tokenise ``docs`` and write the files into ``folder`` (a new one in the shared folder)."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "token-files")
    path = scratch(spark, "token-ids")
    tokenised(docs, vocabulary, ranks, id_col, text_col).withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.schema("id long, ids binary, width byte, row long").parquet(path)
    table = frequencies(tokens)
    units = "part int, path string, doc_from long, doc_to long, ids long"
    if table is None:
        return TokenFiles(folder, spark.createDataFrame([], units))
    raw = table.to_bytes()
    write_bytes(f"{folder}/frequencies", raw)

    def run(batches):
        part, writer, uri = TaskContext.get().partitionId(), None, f"{folder}/tokens-{uuid.uuid4().hex}"
        for batch in batches:
            for doc_id, ids, width in zip(*(batch.column(c).to_pylist() for c in ("id", "ids", "width")), strict=True):
                writer = writer or Writer(uri, R.Table.from_bytes(raw))
                writer.add(doc_id, _numbers(ids, width))
        rows = [(part, uri, *u) for u in writer.close()] if writer else []
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "path", "doc_from", "doc_to", "ids"), r, strict=True)) for r in rows], pa.schema(
            [("part", pa.int32()), ("path", pa.string()), *((c, pa.int64()) for c in ("doc_from", "doc_to", "ids"))]))
    order = [F.asc_nulls_first("id"), F.asc("row")]
    sorted_ = tokens.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    return TokenFiles(folder, saved(sorted_.mapInArrow(run, units), "token-units"))


def read(spark: SparkSession, files: TokenFiles, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of each document from the files."""
    units = files.units
    sizes = units.groupBy("part").agg(F.sum("ids").alias("n"))            # one row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    folder = files.folder

    def run(batches):
        table = slots = None
        for batch in batches:
            for unit in batch.to_pylist():
                if table is None:
                    fs, path = filesystem(f"{folder}/frequencies")
                    with fs.open_input_file(path) as f:
                        table = R.Table.from_bytes(f.read())
                    slots = table.slots()
                with Reader(unit["path"], table, slots) as reader:
                    if unit["doc_from"] == 0:
                        reader.verify_index()
                    doc_ids, nulls, begin = reader.documents(unit["doc_from"], unit["doc_to"])
                    sizes, checks, texts = np.diff(begin), [], []
                    check, held, left = 0, [], int(sizes[0])
                    for some in reader.ids(int(begin[0]), int(begin[-1])):
                        at = 0
                        while at < len(some):
                            got = some[at:at + left]
                            check, at, left = zlib.crc32(got.astype("<u4"), check), at + len(got), left - len(got)
                            if with_ids:
                                held.append(got)
                            if not left:
                                checks.append(check)
                                if with_ids:
                                    texts.append(np.concatenate(held).astype(np.int32))
                                check, held = 0, []
                                left = int(sizes[len(checks)]) if len(checks) < len(sizes) else 0
                    cols = [pa.array(doc_ids, mask=nulls), pa.array(begin[:-1] + unit["before"]), pa.array(sizes), pa.array(checks, pa.int64())]
                    names = ["id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols, names = [*cols, pa.array(texts, pa.list_(pa.int32()))], [*names, "ids"]
                    yield pa.RecordBatch.from_arrays(cols, names=names)
    dealt = units.join(F.broadcast(starts), "part").repartition(partitions(spark))       # one row for each file
    return dealt.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
