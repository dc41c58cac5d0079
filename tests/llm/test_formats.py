import base64
import hashlib
import io
import random
import struct
import zipfile

import pytest

from feedlens.llm import quote_threads as T
from feedlens.llm import warc_packages as W
from feedlens.llm.zip_archive import Package, gzip_member, parse_record, warc_record


# -- packages ---------------------------------------------------------------------

def open_bytes(raw):
    return Package(lambda at, n: raw[at:at + n], len(raw))


def zipped(members, comment=b"", wide=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, raw in members.items():
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=wide) as f:
                f.write(raw)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("wide", [False, True])
def test_package_reads_stored_members(wide):
    members = {"archive/data.warc.gz": b"abc" * 1000, "indexes/é.jsonl": b"", "x": bytes(range(256))}
    p = open_bytes(zipped(members, b"a comment with PK\x05\x06 in it", wide))
    assert {n: p.member(n) for n in p.members} == members


def test_package_zip64_directory():
    """An end record of all ones, so that counts and places stand in the ZIP64 record."""
    raw = zipped({"a": b"1", "b": b"22"})
    at = raw.rfind(b"PK\x05\x06")
    count, length, start = struct.unpack_from("<HLL", raw, at + 10)
    end64 = struct.pack("<4sQHHLLQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, length, start)
    locator = struct.pack("<4sLQL", b"PK\x06\x07", 0, at, 1)
    end = b"PK\x05\x06" + struct.pack("<4H2LH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    p = open_bytes(raw[:at] + end64 + locator + end)
    assert (p.member("a"), p.member("b")) == (b"1", b"22")


def test_package_many_members():
    members = {f"m{k}": str(k).encode() for k in range(70_000)}          # more than 16 bits count
    p = open_bytes(zipped(members))
    assert len(p.members) == 70_000 and p.member("m69999") == b"69999"


def test_package_errors():
    with pytest.raises(ValueError):
        open_bytes(b"not a package")
    with pytest.raises(ValueError):
        open_bytes(b"")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    with pytest.raises(ValueError):
        open_bytes(out.getvalue()).member("a")
    raw = bytearray(zipped({"a": b"hello"}))
    raw[raw.index(b"hello")] ^= 1
    with pytest.raises(ValueError):
        open_bytes(bytes(raw)).member("a")


def test_record_round_trip():
    body = b"\r\n\r\nWARC/1.1\r\n" + bytes(range(256))
    headers, got = parse_record(gzip_member(warc_record({"WARC-Type": "response", "X-é": "ü: v"}, body)))
    assert got == body and headers["warc-type"] == "response" and headers["x-é"] == "ü: v"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_pages_round_trip(spark, min_bytes):
    rows = [(1, "u", "same"), (2, "u", "same"), (3, None, None), (4, "u\n v", ""), (5, "u", "é" * 100_000), (6, "u", "same"),
            (7, "u", "\r\n\r\nx"), (8, "u", "ab"), (9, "u", "ab"), (None, "u", "other"), (6, "u", "same")]
    pages = spark.createDataFrame([(i, u, h, "p") for i, u, h in rows], "page_id long, url string, html string, path string").repartition(3)
    got = W.round_trip(pages, min_bytes=min_bytes).collect()
    assert len(got) == len(rows)
    text = {i: h or "" for i, _, h in rows}
    for r in got:
        i = int(r.record_id) if r.record_id else None
        t = text[i]
        raw = t.encode()
        kept = max((k for k, h in text.items() if k is not None and h == t), default=None) if len(raw) >= min_bytes else i
        assert (r.payload_bytes, r.payload_digest) == (len(raw), digest(t))
        if i is None or kept == i:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, raw)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", str(kept), None)


def test_large_package_is_dealt(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, "u", "".join(rng.choices("abcdef", k=5000))) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    packages = W.write_packages(pages, str(tmp_path / "w"), package_bytes=200_000)
    assert packages.count() > 1
    assert {(int(r.record_id), bytes(r.payload).decode()) for r in W.read_packages(packages).collect()} == {(i, h) for i, _, h in rows}


def test_no_pages(spark):
    assert W.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# -- quotes -----------------------------------------------------------------------

def test_threads(spark):
    rows = [
        (1, 0, "Hello there\nsecond line"),
        (1, 1, "> Hello  THERE\n> second line\n\nFirst answer"),
        (1, 2, "ann wrote:\n> > Hello there\n> > second line\n>\n> First answer\n\nmine"),
        (1, 3, "> second line\n\nabout the second line only"),
        (1, 4, "nothing quoted"),
        (1, 5, "> not from here\nx"),
        (1, 6, ">>> deep\n>> Hello there\nonly deeper quotes"),
        (1, 7, "> nothing quoted\n\nmore"),
        (1, 8, "> about the second line only\n> nothing quoted"),
        (2, 0, "> Hello there\n> second line"),            # another conversation
        (2, 1, None), (2, 2, ""), (2, 3, "> same\n\nsame"), (2, 4, "> same"),
        (None, 0, "a"), (None, 1, "> a"), (3, None, "b"), (3, 1, "> b"),
    ]
    m = spark.createDataFrame([(c, p, t, "user", 0, "x") for c, p, t in rows],
                              "conv_id long, turn long, text string, role string, depth_ int, c string").repartition(3)
    out = {(r.conv_id, r.turn): r for r in T.thread(m).collect()}
    parent = {k: r.reply_to for k, r in out.items() if r.reply_to is not None}
    assert parent == {(1, 1): 0, (1, 2): 1, (1, 3): 0, (1, 7): 4, (2, 4): 3}
    assert [out[1, k].own for k in (1, 2, 3, 8)] == ["First answer", "mine", "about the second line only", ""]
    assert out[1, 2].depth == 2 and out[1, 2].root == 0 and out[1, 7].root == 4
    order = sorted((k for k in out if k[0] == 1), key=lambda k: out[k].reply_order)
    assert [k[1] for k in order] == [0, 1, 2, 3, 4, 7, 5, 6, 8]
    assert [(q.level, q.text) for q in out[1, 2].quotes][0] == (2, "Hello there\nsecond line")
    assert len(out) == len(rows)
    talk = {r.conv_id: [x.content for x in r.messages] for r in T.as_conversations(T.thread(m)).collect()}
    assert talk[1][:3] == ["Hello there\nsecond line", "First answer", "mine"]


def test_long_chain_and_repeats(spark):
    rows = [(1, 0, "m0")] + [(1, k, f"> m{k - 1}\n\nm{k}") for k in range(1, 300)] + [(1, 299, "> m298\n\nm299")]
    out = T.thread(spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(4)).collect()
    assert len(out) == 301
    assert all(r.depth == r.turn and r.root == 0 and r.reply_order == r.turn + 1 for r in out)


def test_one_passage_everywhere(spark):
    rows = [(1, k, "> thanks\n\nthanks") for k in range(3000)]
    out = {r.turn: r.reply_to for r in T.thread(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()}
    assert out[0] is None and all(out[k] == k - 1 for k in range(1, 3000))


def test_no_messages(spark):
    assert T.thread(spark.createDataFrame([], "conv_id long, turn long, text string")).count() == 0
