import gzip
import hashlib
import random
import zlib

from strandlake.llm import warc


def pages(spark):
    rng = random.Random(6)
    big = "".join(rng.choices("abcdef <>é", k=60_000))
    rows = [(5, "http://a/é\n", "x" * 100), (3, "u", "x" * 100), (9, None, "x" * 99), (8, "u", "x" * 99), (1, "u", None), (2, "u", ""), (4, "u", "é" * 50), (6, "u", "é" * 50), (7, "u", big), (10, "u", big), (11, "u", "WARC/1.1\r\n\r\n" + "\x1f\x8b\x08" * 40), (3, "u", "x" * 100), (None, "u", "x" * 100), (12, "u", "z" * 400)]
    return spark.createDataFrame([(a, b, c, "k") for a, b, c in rows], "page_id long, url string, html string, digest string"), rows


def brute(rows):
    first = {}
    for i, _, h in rows:
        if h is not None and len(h.encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        lead = first.get(h) if len(data) >= 100 else None
        revisit = lead is not None and lead != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", lead if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    frame, rows = pages(spark)
    for k, split in enumerate((700, 5000, 1 << 25)):
        found = warc.archive_and_read(frame.repartition(2), f"file://{tmp_path}/{k}", split).collect()
        assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_payloads(spark, tmp_path):
    frame, rows = pages(spark)
    files = warc.write_warc(warc.decide_types(frame), f"file://{tmp_path}/w")
    records = warc.read_warc(files, 1000, with_payload=True).collect()
    texts = {r["payload"].decode() for r in records if r["record_type"] == "response"}
    assert texts == {h or "" for _, _, h in rows}
    assert all(r["payload"] is None for r in records if r["record_type"] == "revisit")
    for path in (tmp_path / "w").glob("*.warc.gz"):  # any reader of gzip members can read it
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")


def test_every_range_finds_its_records():
    """Records are found once, whatever the ranges, among broken members, bare magic and other gzip members."""
    rng = random.Random(2)
    parts, starts, at = [], [], 0
    for i in range(30):
        kind = i % 5
        good = warc.record_bytes(f"urn:page:{i}", "u", bytes(rng.choices(range(256), k=rng.randint(0, 3000))), "d", 5, None, rng.choice([0, 6]))
        if kind == 1:
            data = b"\x1f\x8b\x08 not gzip" * 3
        elif kind == 2:
            data = gzip.compress(b"some other member")
        elif kind == 3:
            data = good[: len(good) // 2]
        else:
            data = good
            starts.append(at)
        parts.append(data)
        at += len(data)
    blob = b"".join(parts)
    import io

    for size in (97, 1000, len(blob)):
        found = [r["file_offset"] for s in range(0, len(blob), size) for r in warc.records_in(io.BytesIO(blob), s, min(s + size, len(blob)))]
        assert found == starts
    assert zlib.decompress(parts[0], 31).startswith(b"WARC")


def test_long_headers_and_blocks_without_http():
    import io

    rng = random.Random(8)
    url = "http://a/" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=120_000))
    long = warc.record_bytes("urn:page:1", url, b"page", "d", 4, None, 6)
    plain = {k: gzip.compress(b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Type: text/plain\r\nContent-Length: %d\r\n\r\n" % (k, len(b)) + b + b"\r\n\r\n") for k, b in ((2, b"short"), (3, b"x" * 200_000))}
    blob = long + plain[2] + plain[3]
    got = list(warc.records_in(io.BytesIO(blob), 0, len(blob), True))
    assert [(r["record_id"], r["payload_bytes"]) for r in got] == [("urn:page:1", 4), ("urn:page:2", 5), ("urn:page:3", 200_000)]
    assert got[0]["target_uri"] == url and got[1]["payload"] == b"short"


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_and_read(none, f"file://{tmp_path}/n").count() == 0
