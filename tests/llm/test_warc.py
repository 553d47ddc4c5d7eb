import gzip
import io
import random

import pytest

from staykit.llm import warc
from staykit.session import scratch_path

PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2\r\nX: y", "<p>same</p>"), (3, None, None), (4, "u", ""),
    (5, "u", "é漢😀\x00" * 10), (None, "u", "<p>same</p>"), (2, "again", "<p>same</p>"), (7, "u", "z" * 3_000_000),
    (8, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n"), (-9, "u", "only"), (None, "u", "nobody's"),
]


def pages_frame(spark, rows=PAGES):
    rows = [(*r, "x", "y") for r in rows]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, refers_to string")


def expected(rows, least=0):
    payloads = [(h or "").encode() for _, _, h in rows]
    out = []
    for (i, _, _), p in zip(rows, payloads):
        same = [r[0] for r, q in zip(rows, payloads) if q == p and r[0] is not None]
        revisit = len(p) >= least and payloads.count(p) > 1 and same and i != max(same)
        out.append((i, len(p), warc.base32_sha1(p), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", [500, 64 << 20])
def test_pages_come_back(spark, split):
    got = warc.archive_index(pages_frame(spark), split_bytes=split).collect()
    assert sorted(map(tuple, got), key=repr) == expected(PAGES)


def test_least_payload(spark):
    got = warc.archive_index(pages_frame(spark), least_bytes=100).collect()
    assert sorted(map(tuple, got), key=repr) == expected(PAGES, 100)


def test_empty_table(spark):
    assert warc.archive_index(pages_frame(spark, [])).collect() == []


def test_every_split_owns_each_record_once():
    rng = random.Random(1)
    raw, places = b"", []
    for i in range(40):
        raw += rng.choice([b"", b"junk" + warc.MAGIC + b"\x00junk", warc.MAGIC, gzip.compress(b"no record")])
        places.append(len(raw))
        raw += warc.record_bytes(i, f"u{i}", bytes(rng.randrange(256) for _ in range(rng.choice([0, 10, 3000, 70_000]))))
    for step in (1 << 30, 100_000, 997, 61):
        found = [(at, r["fields"]["warc-record-id"]) for s in range(0, len(raw), step)
                 for at, r in warc.records_in_range(io.BytesIO(raw), len(raw), s, s + step)]
        assert found == [(p, f"<urn:page:{i}>") for i, p in enumerate(places)]


def found_in(raw, step=1 << 30):
    return [(at, r["fields"]["warc-type"], r["fields"].get("warc-record-id"), r["block"]) for s in range(0, len(raw), step)
            for at, r in warc.records_in_range(io.BytesIO(raw), len(raw), s, s + step)]


def test_truncated_record_is_reported():
    a, b = warc.record_bytes(1, "u", b"one"), warc.record_bytes(2, "u", b"two" * 1000)
    got = found_in(a + b[:-20])
    assert [g[:3] for g in got] == [(0, "response", "<urn:page:1>"), (len(a), "damaged", None)]


def test_broken_member_does_not_hide_the_next():
    a, b = warc.record_bytes(1, "u", b"one" * 5000), warc.record_bytes(2, "u", b"two")
    broken = bytearray(a)
    broken[-8] ^= 1  # the check sum
    for step in (1 << 30, 50):
        assert [g[:3] for g in found_in(bytes(broken) + b, step)] == [(0, "damaged", None), (len(a), "response", "<urn:page:2>")]


def test_all_records_of_one_member():
    plain = [gzip.decompress(warc.record_bytes(i, "u", b"\r\n" * i + b"x" * (10 ** i))) for i in range(5)]
    raw = gzip.compress(b"".join(plain)) + warc.record_bytes(9, "u", b"nine")
    for step in (1 << 30, 97):
        got = found_in(raw, step)
        assert [g[2] for g in got] == [f"<urn:page:{i}>" for i in (0, 1, 2, 3, 4, 9)]
        assert [g[3].partition(b"\r\n\r\n")[2] for g in got[:5]] == [b"\r\n" * i + b"x" * (10 ** i) for i in range(5)]
    cut = gzip.compress(b"".join(plain)[:-3000])
    assert [g[1] for g in found_in(cut)] == ["response"] * 4 + ["damaged"]


def test_read_archives_of_a_folder(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write_archives(pages_frame(spark), folder).collect()
    rows = warc.read_archives(spark, folder, 1000).collect()
    assert len(rows) == len(PAGES)
    long = next(r for r in rows if r.record_id == "<urn:page:7>")
    assert bytes(long.block).endswith(b"z" * 3_000_000) and long.payload_bytes == 3_000_000
    assert {r.target_uri for r in rows if r.record_id == "<urn:page:2>"} == {"http://a/2%0D%0AX: y", "again"}
