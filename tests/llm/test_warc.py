from __future__ import annotations

import io

import pytest
import zstandard
from pyspark.errors import PythonException

from barwright.llm import warc
from barwright.sources.staging import stage


def records(n=40, size=400):
    return [warc.build_record(i, f"http://x/{i}", (p := b"<p>%d</p>" % i * (size // 8)), warc.digest(p), None, "1970-01-01T00:00:00Z") for i in range(n)]


def archive(rows, **kw):
    out = io.BytesIO()
    warc.write_archive(rows, out, **kw)
    return out.getvalue()


def test_round_trip_and_layout():
    rows = records()
    data = archive(rows)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and int.from_bytes(data[4:8], "little") > 0
    assert list(warc.read_archive(data)) == rows
    frames = data[8 + int.from_bytes(data[4:8], "little") :]
    with pytest.raises(zstandard.ZstdError):  # the frames need the dictionary
        zstandard.ZstdDecompressor().decompressobj().decompress(frames)
    big = [warc.build_record(1, None, b"x" * 3_000_000, warc.digest(b"x" * 3_000_000), None, "d")]
    assert list(warc.read_archive(archive(big))) == big
    assert list(warc.read_archive(archive([]))) == [] == list(warc.read_archive(b""))


def test_other_skippable_frames_and_compressed_dictionaries():
    rows = records()
    data = archive(rows)
    size = int.from_bytes(data[4:8], "little")
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    again = data[:4] + len(packed).to_bytes(4, "little") + packed + b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc" + data[8 + size :]
    assert list(warc.read_archive(again)) == rows


@pytest.mark.parametrize("cut", [3, 100, 1])
def test_damaged_archives_are_refused(cut):
    data = archive(records())
    with pytest.raises(ValueError, match="cut off|frame"):
        list(warc.read_archive(data[:-cut]))
    with pytest.raises(ValueError):
        list(warc.read_archive(data[:20]))


@pytest.mark.parametrize(
    "change",
    [
        (b"WARC/1.1", b"HTTP/1.1"), (b"WARC-Date", b"WARC-Data"), (b"Content-Length: 4", b"Content-Length: 5"), (b"<p>1</p>", b"<p>2</p>"),
        (b"WARC-Type: response", b"WARC-Type: request"), (b"sha1:", b"md5:"), (b"WARC-Record-ID: ", b"WARC-Record ID: "),
    ],
)
def test_bad_records_are_refused(change):
    good = records(2)[1]
    assert warc.parse_record(good)["page_id"] == 1 and change[0] in good
    with pytest.raises(ValueError):
        warc.parse_record(good.replace(*change))


def test_responses_and_revisits(spark, tmp_path):
    html = ["same", "same", "", None, "other", "same", "é" * 300_000]
    rows = [(i + 5, f"http://x/{i}\r\n é", h, "z") for i, h in enumerate(html)] + [(None, None, "same", "z"), (5, "http://again/", "same", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")

    def read(least):
        folder = f"{tmp_path}/{least}"
        assert stage(warc.write_archives(warc.plan_records(pages, least), folder)).groupBy().sum("records").first()[0] == len(rows)
        return {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_archives(spark, folder).collect()}

    one = {(5, "response", None, 4), (6, "revisit", 5, 4), (10, "revisit", 5, 4), (None, "revisit", 5, 4), (9, "response", None, 5), (11, "response", None, 600_000)}
    assert read(0) == one | {(7, "response", None, 0), (8, "revisit", 7, 0)}
    assert read(1) == one | {(7, "response", None, 0), (8, "response", None, 0)}


def test_empty_table_and_a_bad_file(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = f"{tmp_path}/none"
    assert stage(warc.write_archives(warc.plan_records(pages), folder)).count() == 0
    (tmp_path / "none").mkdir(exist_ok=True)
    assert warc.read_archives(spark, folder).count() == 0
    (tmp_path / "none" / "a.warc.zst").write_bytes(archive([b"no record"] * 9))
    with pytest.raises(PythonException, match="a.warc.zst, record 0"):
        warc.read_archives(spark, folder).collect()


def test_a_payload_that_most_pages_have_is_split(spark, tmp_path, monkeypatch):
    """80 % of the pages are equal, nothing is broadcast: the records are spread over the tasks all the same."""
    rows = [(i, f"http://x/{i}", "same " * 30 if i % 5 else f"own {i} " * 30) for i in range(8000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        listed = stage(warc.write_archives(warc.plan_records(pages), str(tmp_path))).toPandas()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert listed["records"].sum() == 8000 and listed["records"].max() < 2000
    found = warc.read_archives(spark, str(tmp_path)).groupBy("record_type").count().orderBy("record_type").collect()
    assert [tuple(r) for r in found] == [("response", 1601), ("revisit", 6399)]
