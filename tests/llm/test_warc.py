import base64
import gzip
import hashlib

from msgmart.llm import warc
from msgmart.llm.scratch import Scratch


def archived(spark, rows, **options):
    scratch = Scratch(spark, "test")
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS uid", "'x' AS payload", "2 AS bytes")
    warc.write(frame, scratch.path("archives"), scratch, **options)
    return scratch.path("archives"), warc.read(spark, scratch.path("archives"), payloads=True).collect()


def test_round_trip(spark):
    same = "<p>same\r\n\r\nbody</p>"
    rows = [(5, "http://a", same), (3, "http://b", same), (9, None, same), (4, "http://c\r\nX: 1", "ünïcode 😀"), (7, "u", None), (8, "u", ""), (2, "u", "WARC/1.1\r\n")]
    rows += [(None, "n", "alone"), (6, "d", "twice"), (6, "d", "twice"), (11, "l", "z" * 3_000_000)]
    folder, got = archived(spark, rows, archive_mb=1)
    assert len(got) == len(rows)
    of = {r.page_id: r for r in got if r.page_id != 6}
    assert of[3].record_type == "response" and of[3].refers_to is None
    assert {(of[k].record_type, of[k].refers_to) for k in (5, 9)} == {("revisit", 3)}
    assert (of[7].record_type, of[8].record_type, of[8].refers_to) == ("response", "revisit", 7)
    assert of[None].record_type == "response"
    assert sorted((r.record_type, r.refers_to or 0) for r in got if r.page_id == 6) == [("response", 0), ("revisit", 6)]
    for page_id, _, html in rows:
        body = (html or "").encode()
        r = of.get(page_id) or next(r for r in got if r.page_id == 6)
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        if r.record_type == "response" and page_id != 6:
            assert bytes(r.payload) == body
    names = {r.record_id for r in got if r.record_type == "response"}
    assert all(r.refers_to_record in names for r in got if r.record_type == "revisit")


def test_short_payloads_stay(spark):
    _, got = archived(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], least=3)
    assert {r.page_id: (r.record_type, r.refers_to) for r in got} == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_archives_are_plain_records(spark, tmp_path):
    import glob

    folder, got = archived(spark, [(1, "u", "x"), (2, "u", "y")])
    content = b"".join(gzip.open(p).read() for p in glob.glob(folder.removeprefix("file:") + "/part-*"))
    assert content.count(b"WARC/1.1\r\n") == 2 and content.endswith(b"\r\n\r\n")
    assert len(list(warc._Records(content))) == 2


def test_empty(spark):
    assert archived(spark, [])[1] == []
