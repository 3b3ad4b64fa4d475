import hashlib

from conftest import rows_of
from pyspark.sql import functions as F

from sparley.llm import warc
from sparley.llm.common import open_fs

LONG = "é" * 600


def pages(spark, rows, schema="page_id long, url string, html string, extra int"):
    return spark.createDataFrame(rows, schema)


def test_round_trip_and_revisits(spark, tmp_path):
    rows = [(1, "http://a/\r\nX: y", LONG, 1), (7, None, LONG, 2), (3, "u", LONG, 3), (4, "u", "short", 4), (5, "u", "short", 5), (6, "u", None, 6), (8, "u", "", 7), (None, "u", LONG, 8), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 200, 9)]
    folder = f"file://{tmp_path}/w"
    index = warc.write_archive(pages(spark, rows), folder, frame_bytes=2000)
    got = {r["page_id"]: r.asDict() for r in warc.read_archive(spark, folder).collect()}
    assert len(got) == len(rows)
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        assert got[page_id]["payload_bytes"] == len(data) and got[page_id]["payload_digest"] == hashlib.sha1(data).hexdigest()
        assert got[page_id]["refers_to"] == (7 if html == LONG and page_id != 7 else None)
        assert got[page_id]["record_type"] == ("revisit" if html == LONG and page_id != 7 else "response")
    entry = {r["page_id"]: r for r in index.collect()}[9]
    assert warc.read_payload(folder, entry["bundle"], entry["frame"], entry["offset"])["payload"] == rows[-1][2].encode()
    assert index.count() == len(rows)


def test_bundles_are_plain_zstandard(spark, tmp_path):
    import io

    import zstandard

    folder = f"file://{tmp_path}/w"
    index = warc.write_archive(pages(spark, [(k, "u", f"{k}" * 400, 0) for k in range(30)]), folder, frame_bytes=1000)
    for row in index.select("bundle").distinct().collect():
        files, path = open_fs(f"{folder}/{row['bundle']}")
        data = files.open_input_file(path).read()
        table = warc.read_seek_table(io_file := files.open_input_file(path))
        assert b"".join(warc.read_frame(io_file, e) for e in table) == zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert len(table) > 1


def test_ties_and_empty_table(spark, tmp_path):
    rows = [(1, "u", LONG, 0), (1, "u", LONG, 0), (0, "u", LONG, 0)]
    warc.write_archive(pages(spark, rows), f"file://{tmp_path}/a")
    assert rows_of(warc.read_archive(spark, f"file://{tmp_path}/a").select("page_id", "refers_to")) == [(0, 1), (1, None), (1, None)]
    warc.write_archive(pages(spark, []), f"file://{tmp_path}/b")
    assert warc.read_archive(spark, f"file://{tmp_path}/b").count() == 0


def test_ids_differ_and_archives_are_read_by_several_tasks(spark, tmp_path):
    rows = [(k % 40 if k % 5 else None, "u", f"{k % 50} " * 700, "clash", k) for k in range(120)] + [(7, "u", "long " * 400_000, "clash", 0)]
    table = pages(spark, rows, "page_id long, url string, html string, payload_digest string, refers_to int")
    folder = f"file://{tmp_path}/w"
    index = warc.write_archive(table, folder, frame_bytes=2000, bundle_bytes=3000)
    assert index.count() == index.select("record_id").distinct().count() == len(rows)
    read = warc.read_archive(spark, folder)
    assert read.count() == len(rows) and read.filter("payload_bytes = 2000000 AND page_id = 7").count() == 1
    assert read.select(F.spark_partition_id().alias("p")).distinct().count() > 1
