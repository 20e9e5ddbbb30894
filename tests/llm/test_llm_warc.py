"""WARC archives: round trips, members at their offsets, odd payloads."""

import base64
import glob
import gzip
import hashlib
import json

from lantern.llm import warc

PAGES = [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (2, "http://c", "other"), (3, None, None), (4, "x y\r\nz", ""), (None, "n", "alone"),
         (None, "n", "<p>é</p>"), (7, "u", "WARC/1.1\r\n\r\n" + "q" * 100_000), (8, "r", "again"), (8, "r", "again")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 5) for r in rows], "page_id long, url string, html string, digest string, copies int")


def through(spark, folder, rows):
    warc.write_monolithic(warc.plan_records(frame(spark, rows)), f"{folder}/one")
    warc.normalise(spark, f"{folder}/one", f"{folder}/two")
    return warc.read_indexed(spark, f"{folder}/two")


def test_round_trip(spark, tmp_path):
    got = through(spark, tmp_path, PAGES).collect()
    want = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        keys = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        newest = max(keys, default=None)
        want.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if page == newest else "revisit", None if page == newest else newest))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == sorted(want, key=str)
    assert {r.payload for r in got if r.record_type == "response"} == {h or "" for _, _, h in PAGES}


def test_files_are_members_at_their_offsets(spark, tmp_path):
    through(spark, tmp_path, PAGES).count()
    archives = {f.split("part-")[1][:5]: open(f, "rb").read() for f in glob.glob(f"{tmp_path}/two/kind=warc/part-*")}
    assert b"" in {gzip.decompress(d) for d in archives.values()}
    lines = [json.loads(line) for f in glob.glob(f"{tmp_path}/two/kind=index/part-*") for line in open(f, "rb").read().split(b"\0") if line]
    assert len(lines) == len(PAGES)
    for part, data in archives.items():
        if gzip.decompress(data) == b"":
            continue
        own = sorted((x["offset"], x["length"], x["id"]) for x in lines if x["part"] == int(part))
        assert [o for o, _, _ in own] == [sum(n for _, n, _ in own[:i]) for i in range(len(own))] and sum(n for _, n, _ in own) == len(data)
        for offset, length, name in own:
            record = gzip.decompress(data[offset : offset + length])
            assert record.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {name}\r\n".encode() in record and record.endswith(b"\r\n\r\n")
        assert gzip.decompress(data).count(b"WARC-Record-ID") == len(own)


def test_large_records_end_with_an_empty_member():
    record = b"WARC/1.1\r\n" + bytes(17 << 20)
    made = warc.member(record, 1)
    assert made[-1] == 0 and gzip.decompress(made) == record + b"\r\n\r\n"


def test_least_size_and_empty_table(spark, tmp_path):
    plan = warc.plan_records(frame(spark, PAGES), least=6).collect()
    assert [r.refers_to for r in plan if r.payload == "again"] == [None, None]
    assert {r.refers_to for r in plan if r.payload == "<p>é</p>" and r.page_id == 1} == {2}
    assert [r.refers_to for r in warc.plan_records(frame(spark, [(1, "a", "b"), (2, "a", "b")]), least=6).collect()] == [None, None]
    assert through(spark, tmp_path, []).collect() == []
