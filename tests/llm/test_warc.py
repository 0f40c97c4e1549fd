import gzip
import hashlib
import zlib

import pytest

from nightledger.llm.warc import gzip_member, END, pages_through_warc, read_warc, salvage, write_warc

SCHEMA = "page_id long, url string, html string"
LONG = "<p>é " * 400


def record(k, body=b"payload", digest=None, kind="resource"):
    digest = digest or hashlib.sha1(body).hexdigest()
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{k}>\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + END


def seen(data):
    found = list(salvage(data))
    return [f["record_id"] for f in found if f["kind"] == "record"], [
        (f.get("member"), f["start"], f["length"]) for f in found if f["kind"] == "gap"
    ]


def covered(data):
    """Records and gaps of plain bytes lie side by side, from the first byte to the last."""
    at = 0
    for f in salvage(data):
        assert f["start"] == at
        at += f["length"]
    assert at == len(data)


RECORDS = [record(k, b"body %d \r\nWARC/1.1\r\n inside" % k) for k in range(5)]
WHOLE = b"".join(RECORDS)


def test_whole_archives():
    assert seen(WHOLE) == ([f"urn:x:{k}" for k in range(5)], [])
    assert seen(b"".join(map(gzip.compress, RECORDS))) == ([f"urn:x:{k}" for k in range(5)], [])
    assert seen(gzip.compress(WHOLE)) == ([f"urn:x:{k}" for k in range(5)], [])
    assert seen(b"") == ([], [])


@pytest.mark.parametrize("at", range(0, len(WHOLE), 7))
def test_a_changed_byte_costs_no_other_record(at):
    data = bytearray(WHOLE)
    data[at] ^= 0xFF
    hit = next(k for k in range(5) if at < sum(map(len, RECORDS[: k + 1])))
    ids, gaps = seen(bytes(data))
    assert set(ids) >= {f"urn:x:{k}" for k in range(5) if k != hit}
    assert len(gaps) <= 1
    covered(bytes(data))


@pytest.mark.parametrize("cut", [(0, 5), (30, 40), (len(RECORDS[0]), len(RECORDS[0]) + 60), (len(WHOLE) - 9, len(WHOLE))])
def test_lost_bytes_of_a_plain_archive(cut):
    data = WHOLE[: cut[0]] + WHOLE[cut[1] :]
    ids, gaps = seen(data)
    assert len(ids) == 4 and len(gaps) == 1
    covered(data)


def test_garbage_between_records():
    junk = b"junk \r\nWARC/1.0 not a record\r\n"
    assert seen(RECORDS[0] + junk + RECORDS[1]) == (["urn:x:0", "urn:x:1"], [(None, len(RECORDS[0]), len(junk))])
    wrong = record(9, digest="0" * 40)
    assert seen(RECORDS[0] + wrong + RECORDS[1])[0] == ["urn:x:0", "urn:x:1"]


def test_damaged_members():
    members = [gzip.compress(r) for r in RECORDS]
    broken = bytearray(members[2])
    broken[len(broken) // 2] ^= 0xFF
    data = b"".join([*members[:2], bytes(broken), *members[3:]])
    ids, gaps = seen(data)
    assert ids == ["urn:x:0", "urn:x:1", "urn:x:3", "urn:x:4"]
    assert gaps == [(None, len(members[0] + members[1]), len(broken))]
    ids, gaps = seen(b"".join(members)[:-4])
    assert ids[:4] == [f"urn:x:{k}" for k in range(4)] and len(gaps) == 1
    ids, gaps = seen(members[0] + b"not a member" + members[1])
    assert ids == ["urn:x:0", "urn:x:1"] and gaps == [(None, len(members[0]), 12)]


def test_what_precedes_the_damage_in_a_large_member_counts():
    records = [record(k, bytes(hashlib.sha512(b"%d" % k).digest() * 40)) for k in range(200)]
    data = bytearray(gzip.compress(b"".join(records), 1))
    at = len(data) // 2
    data[at : at + 20] = b"\0" * 20
    try:
        zlib.decompress(bytes(data), 31)
        pytest.skip("not damaged")
    except zlib.error:
        pass
    ids, gaps = seen(bytes(data))
    assert len(ids) > 20 and len(gaps) == 1


def brute(rows):
    out = []
    for page_id, html in rows:
        body = (html or "").encode()
        same = [p for p, h in rows if (h or "") == (html or "") and p is not None]
        last = max(same) if len(body) >= 1000 and len(same) and sum((h or "") == (html or "") for _, h in rows) > 1 else None
        revisit = last is not None and page_id != last
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def test_pages(spark):
    rows = [(1, LONG), (2, LONG), (3, LONG + "x"), (4, "short"), (5, "short"), (6, None), (7, ""), (8, "a\r\n\r\nWARC/1.1\r\n\0b" * 80),
            (9, "y" * 1000), (10, "y" * 1000), (11, "z" * 999), (12, "z" * 999), (None, LONG), (2, LONG), (13, "w" * 300_000)]
    pages = spark.createDataFrame([(p, "http://x/ y\r\nz", h) for p, h in rows], SCHEMA)
    extra = pages.selectExpr("*", "1 AS payload", "2 AS kind", "3 AS record_type", "4 AS n")
    found = pages_through_warc(extra)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)
    assert pages_through_warc(spark.createDataFrame([(1, None, None)], SCHEMA)).count() == 1
    assert pages_through_warc(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_payloads_survive_and_damage_is_logged(spark, tmp_path, compression):
    rows = [(k, f"http://x/{k}", f"page {k} " * 300) for k in range(40)]
    path = tmp_path / "archives"
    write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"file://{path}", compression)
    found = read_warc(spark, f"file://{path}")
    assert {r.payload.decode() for r in found.collect()} == {h for _, _, h in rows}
    assert {r.target_uri for r in found.collect()} == {u for _, u, _ in rows}
    file = next(p for p in path.iterdir() if p.name.startswith("part-"))
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 0xFF
    (tmp_path / "damaged").mkdir()
    (tmp_path / "damaged" / "a.warc").write_bytes(bytes(data))
    kinds = [r.kind for r in read_warc(spark, f"file://{tmp_path}/damaged").collect()]
    assert "gap" in kinds and kinds.count("record") == 39
    # Archives are bounded by bytes, and each is whole.
    write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"file://{path}-small", compression, archive_bytes=5000)
    small = [p.read_bytes() for p in (tmp_path / "archives-small").iterdir() if p.name.startswith("part-")]
    assert len(small) >= (2 if compression == "gzip" else 10)
    assert sum(len(seen(data)[0]) for data in small) == 40 and all(not seen(data)[1] for data in small)
    if compression == "gzip":
        assert sum(gzip.decompress(data).count(b"WARC/1.1\r\n") for data in small) == 40


def test_a_plain_archive_may_hold_gzip_bodies():
    records = [record(k, gzip.compress(b"body %d" % k) if k == 20 else b"plain") for k in range(40)]
    assert seen(b"".join(records)) == ([f"urn:x:{k}" for k in range(40)], [])
    # Also with the first record lost, and a body that is an archive itself.
    inner = record(90, gzip.compress(RECORDS[0]))
    ids, gaps = seen((records[0] + inner + records[1])[5:])
    assert ids == ["urn:x:90", "urn:x:1"] and len(gaps) == 1
    # A compressed archive that begins with damage.
    members = [gzip.compress(r) for r in RECORDS]
    assert seen(b"\0" * 30 + members[0][30:] + b"".join(members[1:]))[0] == [f"urn:x:{k}" for k in range(1, 5)]


def test_members_end_as_the_sink_ends_them(monkeypatch):
    for size in (0, 10, (1 << 24) - 1, (1 << 24) + 5):
        data = gzip_member(bytes(size))
        assert data.endswith(b"\0") and gzip.decompress(data) == bytes(size)
