import base64
import hashlib
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeshelf.llm import warc
from lakeshelf.llm.shared_files import created, opened_at


def record(i, body):
    sha1 = hashlib.sha1(body.encode()).hexdigest()
    return warc._record("response", i, f"http://a/{i} b", body, None, None, len(body.encode()), sha1, "2020-01-01T00:00:00Z")


def archive(gzipped, n=12):
    records = [record(i, f"<p>{'text ' * i * 40}é\r\nWARC/1.1\r\nno record\x1f\x8b\x08</p>") for i in range(n)]
    parts = [warc._member(r) if gzipped else r for r in records]
    starts = [sum(map(len, parts[:k])) for k in range(n + 1)]
    return b"".join(parts), starts


def read(data):
    found = list(warc.salvage(pa.BufferReader(bytes(data))))
    return [x[3]["warc-record-id"] for x in found if x[0] == "record"], [x[1:4] for x in found if x[0] == "gap"]


@pytest.mark.parametrize("gzipped", [True, False])
def test_whole_archive(gzipped):
    data, _ = archive(gzipped)
    ids, gaps = read(data)
    assert ids == [f"<urn:page:{i}>" for i in range(12)] and not gaps


@pytest.mark.parametrize("gzipped", [True, False])
def test_every_damaged_place_costs_its_record_only(gzipped):
    data, starts = archive(gzipped)
    for k in range(3, 9):
        for place in {starts[k], starts[k] + 1, (starts[k] + starts[k + 1]) // 2, starts[k + 1] - (1 if not gzipped else 5)}:
            bad = bytearray(data)
            bad[place] ^= 0x41
            ids, gaps = read(bad)
            assert set(ids) >= {f"<urn:page:{i}>" for i in range(12) if i != k}, (k, place)
            # a gap, if the damage matters, lies within the record
            assert all(starts[k] <= a < b <= starts[k + 1] for a, b, _ in gaps) and len(ids) + len(gaps) >= 12


def test_members_of_several_records():
    records = [record(i, f"<p>{hashlib.sha256(b'%d' % i).hexdigest() * 900}</p>") for i in range(8)]
    starts = [sum(map(len, records[:k])) for k in range(9)]
    ids = [f"<urn:page:{i}>" for i in range(8)]
    whole, after = warc._member(b"".join(records)), warc._member(record(99, "after"))
    assert read(whole + after) == ([*ids, "<urn:page:99>"], [])
    for k in range(8):
        for place in (0, 3, len(records[k]) // 2, len(records[k]) - 1):
            bad = bytearray(b"".join(records))
            bad[starts[k] + place] ^= 0x41
            member = warc._member(bytes(bad))
            found, gaps = read(member + after)
            assert set(found) >= {*ids, "<urn:page:99>"} - {ids[k]} and len(found) + len(gaps) >= 9
            assert all(g[:2] == (0, len(member)) and "of the member" in g[2] for g in gaps)
    for share in (0.3, 0.6, 0.9):  # damaged or cut late: what came before stays
        cut = whole[: int(len(whole) * share)]
        found, gaps = read(cut + after)
        assert found[:-1] == ids[: len(found) - 1] and len(found) >= 8 * share and found[-1] == "<urn:page:99>" and len(gaps) == 1
        found, gaps = read(cut)
        assert found == ids[: len(found)] and len(found) >= 8 * share - 1 and gaps[-1][1] == len(cut)
    torn = bytearray(whole)
    torn[-6] ^= 1  # the checksum of the member
    assert read(bytes(torn) + after)[0] == [*ids, "<urn:page:99>"] and len(read(torn)[1]) == 1


def test_junk_between_cut_end_and_mixed_forms():
    packed, p = archive(True, 3)
    plain, q = archive(False, 3)
    data = packed[: p[2]] + b"junk" * 5000 + plain[: q[2]] + packed[p[2] : -9]
    ids, gaps = read(data)
    assert ids == ["<urn:page:0>", "<urn:page:1>"] * 2
    assert [g[:2] for g in gaps] == [(p[2], p[2] + 20_000), (p[2] + 20_000 + q[2], len(data))]
    assert read(b"") == ([], []) and [g[:2] for g in read(b"nothing here")[1]] == [(0, 12)]


def test_round_trip(spark):
    rows = [(5, "http://x", "<p>é</p>"), (9, None, "<p>é</p>"), (2, "http://y z\r\n", "<p>é</p>"), (3, "u", None), (4, "u", ""), (7, "w", "once"), (None, "n", "none")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for least in (0, 1):
        archives = warc.write_archives(pages, min_bytes=least)
        found = warc.records(warc.read_archives(archives)).select(
            warc.page_of(F.col("record_id")).alias("id"), "record_type", warc.page_of(F.col("refers_to_id")).alias("of"), "payload_bytes", "payload_digest", "payload"
        ).collect()
        payload = {r[0]: (r[2] or "").encode() for r in rows}
        assert {(r["id"], r["record_type"], r["of"]) for r in found} == {
            (9, "response", None), (5, "revisit", 9), (2, "revisit", 9), (7, "response", None), (None, "response", None), (4, "response", None),
            (3, "response", None) if least else (3, "revisit", 4),
        }
        for r in found:
            data = payload[r["id"]]
            assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
            assert r["payload"] == (None if r["record_type"] == "revisit" else data)
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_gaps_are_logged(spark, tmp_path):
    data, starts = archive(True, 5)
    bad = bytearray(data)
    bad[starts[2] + 30] ^= 255
    with created(f"file://{tmp_path}/a.warc.gz") as out:
        out.write(bytes(bad))
    read_back = warc.read_archives(spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "path string"))
    assert warc.records(read_back).count() == 4
    gap = warc.gaps(read_back).first()
    assert (gap["start"], gap["stop"]) == (starts[2], starts[3]) and "damaged" in gap["gap_reason"]
    with opened_at(f"file://{tmp_path}/a.warc.gz") as file:
        assert file.size() == len(data) and zlib.decompress(data[: starts[1]], 31).startswith(b"WARC/1.1")
