"""WARC round trips: revisits, framing, damage, odd payloads."""
import gzip
import hashlib

import pytest
from llm_support import SF001
from termflow.llm import warc

SCHEMA = "page_id long, url string, html string"


def test_round_trip_of_pages(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    want = {r.page_id: r.html.encode() for r in pages.collect()}
    got = warc.archive_and_read(pages).collect()
    assert len(got) == len(want) and all(r.valid for r in got)
    for r in got:
        assert (r.payload_bytes, r.payload_digest) == (len(want[r.page_id]), hashlib.sha256(want[r.page_id]).hexdigest())


def test_revisits_and_odd_rows(spark):
    big, small = "é" * 60, "x" * 99
    rows = [(7, "u7", big), (3, "u3", big), (9, "u9", big), (1, "s1", small), (2, "s2", small), (4, None, None),
            (5, "a\r\nb", ""), (None, "n", big), (None, "n", "q" * 200), (11, "u", "z" * 3_000_000), (3, "u3", big)]
    got = warc.archive_and_read(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows) and all(r.valid for r in got)
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=str)
    assert kinds == sorted([(7, "revisit", 3), (3, "response", None), (3, "revisit", 3), (9, "revisit", 3),
                            (None, "revisit", 3), (1, "response", None), (2, "response", None), (4, "response", None),
                            (5, "response", None), (None, "response", None), (11, "response", None)], key=str)
    by = {(r.page_id, r.record_type): r for r in got}
    assert by[(7, "revisit")].payload_bytes == 120 and by[(7, "revisit")].refers_to == 3
    assert by[(4, "response")].payload_bytes == 0
    assert warc.archive_and_read(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_are_one_response(spark):
    rows = [(1, "u", "p" * 200)] * 3 + [(None, "n", "q" * 200)] * 2 + [(None, None, "r" * 200)] * 2 + [(5, "v", "s" * 20)] * 2 + [
        (2, "w", "t" * 300)] * 2 + [(4, "w", "t" * 300)] * 2
    got = warc.archive_and_read(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert all(r.valid for r in got)
    assert sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=str) == sorted(
        [(1, "response", None, 200)] + [(1, "revisit", 1, 200)] * 2 + [(None, "response", None, 200)] * 2
        + [(None, "revisit", None, 200)] * 2 + [(5, "response", None, 20)] * 2 + [(2, "response", None, 300), (2, "revisit", 2, 300)]
        + [(4, "revisit", 2, 300)] * 2, key=str)


def test_bodies_are_shuffled_once(spark):
    """Repeated rows take the same way as others, not a second join of all
    bodies: of the exchanges only one carries html."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pages = spark.createDataFrame([(1, "u", "p" * 200)] * 2, SCHEMA)
        text = warc.plan_records(pages)._jdf.queryExecution().executedPlan().treeString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = text.split("\n")
    carried = [l for k, l in enumerate(lines) if "Exchange" in l and "html" in lines[k + 1]]
    assert len(carried) == 1, text


def test_payloads_come_back_and_files_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>\r\n\r\nWARC/1.1</p>"), (2, "v", "b" * 500)], SCHEMA)
    warc.write_archives(pages, str(tmp_path / "a"))
    table = spark.read.parquet(str(tmp_path / "a")).orderBy("archive", "seq")
    data = b"".join(bytes(r.content) for r in table.collect())
    assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: response") == 2
    (tmp_path / "f").mkdir()
    (tmp_path / "f/x.warc.gz").write_bytes(data)
    got = {r.page_id: bytes(r.payload) for r in warc.read_files(spark, str(tmp_path / "f")).collect()}
    assert got == {1: b"<p>\r\n\r\nWARC/1.1</p>", 2: b"b" * 500}


def test_members_cross_chunks_and_damage_is_seen():
    one = warc.encode_record(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None, False)
    two = warc.encode_record(2, "u", b"w" * 100_000, hashlib.sha256(b"w" * 100_000).hexdigest(), None, False)
    data = one + two
    cut = [data[i:i + 17] for i in range(0, len(data), 17)]
    assert [warc.decode_record(m)["page_id"] for m in warc.members(iter(cut))] == [1, 2]
    with pytest.raises(ValueError):
        list(warc.members(iter([data[:-5]])))
    wrong = gzip.decompress(one).replace(b"hello", b"hallo")
    assert not warc.decode_record(wrong)["valid"]
    assert not warc.decode_record(gzip.decompress(one)[:-6])["valid"]
    assert not warc.decode_record(b"junk")["valid"]
