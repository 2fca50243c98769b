"""Image files, sequence files, compaction and result tables."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from skyframes.operators import stencil
from skyframes.sources import images as src

NAMES = {3: "04E670000001_01-05-2024_09-00-00.png", 1: "04E670000001_01-05-2024_09-00-10.png", 4: "04E670000002_01-06-2024_19-00-00.png"}


def png(high, wide, channels, pixel):
    kind = {1: 0, 3: 2, 4: 6}[channels]

    def chunk(tag, body):
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    rows = b"".join(b"\0" + b"".join(bytes(pixel(y, x)) for x in range(wide)) for y in range(high))
    head = struct.pack(">IIBBBBB", wide, high, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


@pytest.fixture()
def folder(tmp_path):
    path = tmp_path / "frames"
    path.mkdir()
    (path / NAMES[3]).write_bytes(png(3, 4, 3, lambda y, x: (10 + y, 100 + x, 200)))
    (path / NAMES[1]).write_bytes(png(2, 2, 1, lambda y, x: (50 + 2 * y + x,)))
    (path / NAMES[4]).write_bytes(png(1, 2, 4, lambda y, x: (1, 2, 3 + x, 128)))
    (path / "04E670000002_01-06-2024_19-00-05.png").write_bytes(b"not an image")
    return str(path)


def test_images_become_bgr_pixels(spark, folder):
    images = src.read_images(spark, folder)
    rows = {(r.device_id, r.tod): r for r in images.collect()}
    assert sorted(rows) == [("04E670000001", 32400), ("04E670000001", 32410), ("04E670000002", 68400)]
    assert rows["04E670000001", 32400].day == 19727
    pixels = {(p.tod, p.y, p.x): (p.b, p.g, p.r) for p in stencil.pixel_rows(images, "tod").collect()}
    assert len(pixels) == 12 + 4 + 2
    assert pixels[32400, 2, 3] == (200, 103, 12) and pixels[32410, 1, 0] == (52, 52, 52) and pixels[68400, 0, 1] == (4, 2, 1)


def test_files_without_a_frame_are_listed(spark, folder, tmp_path):
    (tmp_path / "frames" / "holiday.png").write_bytes(png(1, 1, 3, lambda y, x: (1, 2, 3)))
    got = {(r.path.rpartition("/")[2], r.reason) for r in src.rejected_files(spark, folder).collect()}
    assert got == {("holiday.png", "name"), ("04E670000002_01-06-2024_19-00-05.png", "broken")}


def test_compaction_keeps_every_file_and_its_bytes(spark, folder, tmp_path):
    target = str(tmp_path / "packed")
    src.compact_frames(spark, folder, target)
    back = spark.read.parquet(target)
    assert back.count() == 4 and back.where("device_id = '04E670000001' and day = 19727").count() == 2
    content = back.where(F.col("name") == NAMES[1]).first().content
    assert bytes(content) == png(2, 2, 1, lambda y, x: (50 + 2 * y + x,))


def test_sequence_files_are_imported(spark, tmp_path):
    path = str(tmp_path / "frames.seq")
    rows = [("a.jpg", bytearray(b"\x00\xff")), ("b.jpg", bytearray(b""))]
    spark.sparkContext.parallelize(rows, 2).saveAsSequenceFile(path)
    got = {r.name: bytes(r.content) for r in src.read_sequence_files(spark, path).collect()}
    assert got == {"a.jpg": b"\x00\xff", "b.jpg": b""}


def test_results_are_stored_by_day(spark, tmp_path):
    path = str(tmp_path / "sky_mask")
    table = spark.createDataFrame([("d", 1, 0, 0), ("d", 2, 0, 1)], "device_id string, day long, y int, x int")
    src.write_result(table, path)
    assert spark.read.parquet(path).where("day = 2").select("x").first().x == 1
    again = spark.createDataFrame([("d", 3, 5, 5), ("d", 1, 0, 7)], "device_id string, day long, y int, x int")
    for _ in range(2):  # day 1 anew and day 3, twice
        src.write_result(again, path)
    assert sorted((r.day, r.x) for r in spark.read.parquet(path).collect()) == [(1, 7), (2, 1), (3, 5)]
