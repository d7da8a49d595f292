"""Archives: round trip, revisits, and what is recovered from damaged files."""

import gzip
import hashlib
import zlib

from metacurate.llm.warc import page_records, read_archives, salvage, warc_records, write_warc

SCHEMA = "page_id bigint, url string, html string, record string, digest string, refers_to string"
LONG = "<p>é</p>" * 30


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def round_trip(spark, tmp_path, rows, name="w"):
    path = str(tmp_path / name)
    write_warc(warc_records(pages(spark, rows)), path, per_file=3)
    got = page_records(read_archives(spark.read.format("binaryFile").load(path)))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def expected(rows):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None]
        revisit = len(raw) >= 100 and same and min(same) != page
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    rows = [
        (3, "http://a", LONG), (1, "http://b\r\nWARC-Type: evil", LONG), (2, None, LONG), (4, "", None), (5, "u", ""),
        (6, "u", "short"), (7, "u", "short"), (8, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9), (None, "u", LONG),
        (9, "u", "x" * 300_000 + "\r\n\r\n"), (10, "u", "\n" * 120), (11, "u", "\n" * 120), (1, "http://b", LONG),
    ]
    assert round_trip(spark, tmp_path, rows) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, tmp_path, []) == []


def record(page, text, kind="response"):
    block = text.encode()
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{page}>\r\nWARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def outline(data):
    return [(s, e, h and h["warc-record-id"][10:-1]) for s, e, h, _, _ in salvage(data)]


def test_salvage_plain():
    a, b, c = record(1, "one"), record(2, "two" * 50), record(3, "three")
    damaged = a + b[:-60] + b"?" * 17 + c  # b lost its end
    assert outline(damaged) == [(0, len(a), "1"), (len(a), len(damaged) - len(c), None), (len(damaged) - len(c), len(damaged), "3")]
    flipped = bytearray(a + b + c)
    flipped[len(a) + len(b) - 20] ^= 1
    assert outline(bytes(flipped)) == [(0, len(a), "1"), (len(a), len(a + b), None), (len(a + b), len(a + b + c), "3")]
    assert outline(b"junk" + a) == [(0, 4, None), (4, 4 + len(a), "1")]
    assert outline(a + b"\x00\x01") == [(0, len(a), "1"), (len(a), len(a) + 2, None)]
    assert outline(b"") == [] and outline(b"no archive") == [(0, 10, None)]
    assert outline(a.replace(b"Content-Length: 3", b"Content-Length: 9") + c)[-1][2] == "3"


def test_salvage_members():
    a, b, c = (gzip.compress(record(i, "text " * i)) for i in (1, 2, 3))
    broken = bytearray(b)
    broken[20] ^= 0xFF
    data = a + bytes(broken) + c + record(4, "plain")
    got = outline(data)
    assert [g[2] for g in got] == ["1", None, "3", "4"]
    assert got[1][:2] == (len(a), len(a) + len(b))
    assert [g[2] for g in outline(a + c[: len(c) // 2])] == ["1", None]
    assert sum(e - s for s, e, _ in got) == len(data)


def incompressible(page, n=3000):
    return record(page, "".join(hashlib.sha256(f"{page} {i}".encode()).hexdigest() for i in range(n // 64)))


def test_salvage_members_of_several_records():
    texts = [incompressible(i) for i in range(1, 21)]
    texts[7] = texts[7].replace(b"sha256:", b"sha256:0")
    after = gzip.compress(record(99, "after"))
    others = [str(i) for i in range(1, 21) if i != 8]
    whole = gzip.compress(b"".join(texts))
    got = list(salvage(whole + after))
    assert [h["warc-record-id"][10:-1] for _, _, h, _, _ in got if h] == [*others, "99"]
    gaps = [(s, e, why) for s, e, h, _, why in got if h is None]
    start = sum(map(len, texts[:7]))
    assert gaps == [(0, len(whole), f"in gzip member, bytes {start} to {start + len(texts[7])}: block digest differs")]
    # a wrong check sum: everything is there
    crc = bytearray(whole)
    crc[-6] ^= 1
    got = outline(bytes(crc) + after)
    assert [g[2] for g in got if g[2]] == [*others, "99"] and got[-2][2] is None and got[-2][1] == len(whole)
    # cut: all records before the cut
    content = b"".join(incompressible(i) for i in range(1, 21))
    packed = gzip.compress(content)
    for cut in (len(packed) - 1, len(packed) - 9, len(packed) // 2, len(packed) // 3):
        there = zlib.decompressobj(31).decompress(packed[:cut])
        n = there.count(b"WARC/1.1") - (not there.endswith(b"\r\n\r\n"))
        got = outline(packed[:cut])
        assert [g[2] for g in got] == [*(str(i) for i in range(1, n + 1)), None] and n > 4
        assert got[-1][0] == got[0][1] and got[-1][1] == cut
    # flipped bytes: every record that the stream still holds, none twice, and the next member
    for level in (0, 6):
        packed = gzip.compress(content, level)
        for at in range(2000, len(packed) - 10, len(packed) // 17):
            flipped = bytearray(packed)
            flipped[at] ^= 0x10
            got = [g[2] for g in outline(bytes(flipped) + after)]
            kept = [g for g in got if g]
            before = zlib.decompressobj(31).decompress(packed[:at - 8]).count(b"\r\n\r\nWARC/1.1")
            assert kept[:before] == [str(i) for i in range(1, before + 1)]
            assert len(set(kept)) == len(kept) < 21 and kept[-1] == "99" and None in got


def test_gaps_are_logged(spark):
    files = spark.createDataFrame([("f", bytearray(record(1, "a") + b"??" + record(2, "b"))), ("g", None)], "path string, content binary")
    got = sorted((r["start"], r["stop"], r["kind"], r["reason"]) for r in read_archives(files).collect())
    n = len(record(1, "a"))
    assert got == [(0, n, "record", None), (n, n + 2, "gap", "no version line"), (n + 2, 2 * n + 2, "record", None)]
