import struct

import pytest
import zstandard
from pyspark.errors import PythonException

from checks.compare import _rows, duck
from voicetide.llm import queries, warc

PAGES = "page_id long, url string, html string, payload string, refers_to string"
ROWS = [
    (3, "http://a/x", "same page", "clash", "clash"), (1, None, "same page", "clash", "clash"),
    (2, "http://a/\r\nWARC-Type: evil", "", "clash", "clash"), (9, "", None, "clash", "clash"),
    (None, "http://n", "same page", "c", "c"), (None, "http://n", "alone", "c", "c"),
    (5, "http://long", "<p>é\U0001f600</p>\r\n\r\n" * 40_000, "c", "c"),
    (7, "http://t", "twice", "c", "c"), (7, "http://t", "twice", "c", "c"),
]


def small_pages(spark):
    return spark.createDataFrame(ROWS, PAGES)


def test_round_trip(spark):
    found = warc.round_trip(small_pages(spark)).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.page_id, []).append(r)
    assert len(found) == len(ROWS)
    assert by_id[1][0].record_type == "response" and by_id[1][0].refers_to is None
    assert by_id[3][0].record_type == "revisit" and by_id[3][0].refers_to == 1 and by_id[3][0].payload is None
    assert by_id[2][0].record_type == "response" and by_id[9][0].refers_to == 2
    assert sorted(r.record_type for r in by_id[None]) == ["response", "revisit"]
    assert {r.record_type for r in by_id[7]} == {"response"}  # both have the smallest id
    assert bytes(by_id[5][0].payload) == ROWS[6][2].encode()
    assert by_id[5][0].payload_bytes == len(ROWS[6][2].encode())
    assert by_id[2][0].url == "http://a/%0D%0AWARC-Type: evil" and by_id[9][0].url is None


def test_small_payloads_may_be_spared_revisits(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(small_pages(spark), path, least=6)
    kinds = {(r.page_id, r.record_type) for r in warc.read_archives(spark, path).collect()}
    assert (9, "response") in kinds and (3, "revisit") in kinds


def test_frequent_payloads_are_dealt(spark):
    rows = [(i, f"http://{i}", "boiler" if i % 3 else f"own {i}", "c", "c") for i in range(1, 301)]
    pages = spark.createDataFrame(rows, PAGES).repartition(7)
    for hot_rows in (5, 10_000):  # the first takes the dealt way
        found = warc.with_first(pages, hot_rows=hot_rows).collect()
        assert len(found) == 300 and len({r.page_id for r in found}) == 300
        for r in found:
            again = r.page_id % 3 and r.page_id != 1
            assert r.refers_to == (1 if again else None) and bytes(r.payload) == rows[r.page_id - 1][2].encode()


def test_archives_end_after_a_number_of_frames(spark, small, tmp_path):
    pages = spark.read.parquet(f"{small}/pages.parquet").coalesce(1)
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, archive_rows=9)
    files = [bytes(f.content) for f in spark.read.format("binaryFile").load(f"{path}/part-*").collect()]
    assert len(files) == -(-pages.count() // 8)
    assert all(struct.unpack_from("<I", f)[0] == warc.DICTIONARY_FRAME for f in files)
    assert warc.read_archives(spark, path).count() == pages.count()


def test_empty_table(spark):
    assert warc.round_trip(small_pages(spark).limit(0)).count() == 0


def test_dictionary_leads_and_frames_hold_one_record(spark, small, tmp_path):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    files = spark.read.format("binaryFile").load(f"{path}/part-*").collect()
    records = 0
    for f in files:
        content = bytes(f.content)
        magic, size = struct.unpack_from("<II", content)
        assert magic == warc.DICTIONARY_FRAME and size > 1000
        with pytest.raises(zstandard.ZstdError):  # the frames need the dictionary
            first = 8 + size + len(warc.SEPARATOR)
            zstandard.ZstdDecompressor().decompress(content[first : warc.frame_end(memoryview(content), first)])
        records += sum(raw.startswith(b"WARC/1.1\r\n") for raw in warc.read_archive(content))
    assert records == pages.count()


def archive(records, dictionary=b"", compressed=False, size=True):
    lead, data = b"", None
    if dictionary:
        body = zstandard.ZstdCompressor().compress(dictionary) if compressed else dictionary
        lead = struct.pack("<II", warc.DICTIONARY_FRAME, len(body)) + body
        data = zstandard.ZstdCompressionDict(dictionary)
    coder = zstandard.ZstdCompressor(dict_data=data, write_content_size=size, write_checksum=size)
    return lead + b"".join(coder.compress(r) for r in records)


@pytest.mark.parametrize("compressed", [False, True])
@pytest.mark.parametrize("size", [False, True])
def test_archives_of_other_writers(compressed, size):
    records = [warc.record(i, f"http://h/{i}", bytes([65 + i]) * i * 9000, None) for i in range(6)]
    dictionary = zstandard.train_dictionary(
        2000, [warc.record(i, f"http://h/{i}", b"some words %d" % i * 20, None) for i in range(200)]
    ).as_bytes()
    data = archive(records, dictionary, compressed, size)
    assert list(warc.read_archive(data)) == records
    assert list(warc.read_archive(archive(records, size=size))) == records


@pytest.mark.parametrize("change", [
    lambda r: r[:-1], lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), lambda r: r + b"x",
    lambda r: r.replace(b"WARC-Date", b"WARC-Dato"), lambda r: r.replace(b"payload", b"Payload"),
    lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1", 1), lambda r: r + r,
])
def test_broken_records_are_found(change):
    good = warc.record(1, "http://a", b"the payload text", None)
    assert warc.parse(good)["payload"] == b"the payload text"
    with pytest.raises(ValueError):
        warc.parse(change(good))


def test_truncated_and_foreign_frames():
    data = archive([warc.record(1, "http://a", b"abc" * 100, None)])
    for broken in (data[:-3], data[: len(data) // 2], b"GZIP" + data, data + b"\0\0"):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_archive(broken))


def test_a_broken_archive_fails_the_job(spark, tmp_path):
    (tmp_path / "a.warc.zst").write_bytes(archive([b"WARC/1.1\r\nno headers\r\n\r\n"]))
    with pytest.raises(PythonException, match="a.warc.zst"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_sql_takes_the_same_view_of_nulls(spark, tmp_path):
    rows = [r for r in ROWS if r[0] not in (7, None)]
    spark.createDataFrame(rows, PAGES).coalesce(1).write.parquet(str(tmp_path / "p"))
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    cursor = con.execute(queries.OP8_SQL)
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    found = warc.round_trip(spark.createDataFrame(rows, PAGES)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
    assert _rows(found.columns, [tuple(r) for r in found.collect()]) == want
