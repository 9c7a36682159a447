"""Picture files written by the test, and pixel tables."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.functions.scalars import path_label
from millrace.operators import images as I
from millrace.sources.files import filter_classes, list_labeled_files, read_files


def png(width, height, pixels, colour):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    step = width * (3 if colour else 1)
    raw = b"".join(b"\0" + bytes(pixels[r * step : (r + 1) * step]) for r in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if colour else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("pictures")
    for name in ("meal", "drink", "other"):
        (root / name).mkdir()
    grey = [16 * i for i in range(16)]
    (root / "meal" / "grey.png").write_bytes(png(4, 4, grey, False))
    (root / "meal" / "SHOUT.PNG").write_bytes(png(4, 4, grey, False))
    red = [200, 100, 50] * 16
    (root / "drink" / "red.png").write_bytes(png(4, 4, red, True))
    (root / "drink" / "notes.txt").write_text("x")
    (root / "other" / "broken.png").write_bytes(png(4, 4, grey, False)[:40])
    (root / "other" / "cut.png").write_bytes(png(4, 4, grey, False)[:20])
    return str(root)


def test_file_lists(spark, folder):
    assert read_files(spark, folder).count() == 6
    assert read_files(spark, folder, "*.txt").first()["content"] == b"x"
    rows = list_labeled_files(spark, folder, ["meal", "drink"]).collect()
    assert {(r["path"].rsplit("/", 1)[1], r["label_str"]) for r in rows} == {("grey.png", "meal"), ("red.png", "drink")}
    assert not any(r["path"].startswith("file:") for r in rows)
    chosen = filter_classes(read_files(spark, folder).select("path"), ["meal", "drink"])
    assert sorted(r["label"] for r in chosen.collect()) == [0, 0, 1, 1]


def test_listing_does_not_read_content(spark, folder):
    plan = read_files(spark, folder).select("path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_broken_files_are_reported(spark, folder):
    good, bad = I.split_bad_records(I.read_images(spark, folder))
    assert good.count() == 3
    assert sorted(r["origin"].rsplit("/", 1)[1] for r in bad.collect()) == ["broken.png", "cut.png", "notes.txt"]


def test_decode_grey_and_colour(spark, folder):
    rows = I.read_images(spark, folder).withColumn("name", F.regexp_replace("origin", "^.*/", ""))
    colour = {r["name"]: r["pixels"] for r in I.decode_images(rows, 2, 3, "bicubic").collect()}
    assert len(colour["red.png"]) == 12
    assert colour["red.png"][:3] == pytest.approx([200 / 255, 100 / 255, 50 / 255])
    assert colour["grey.png"][0] == colour["grey.png"][1] == colour["grey.png"][2]
    grey = {r["name"]: r["pixels"] for r in I.decode_images(rows, 2, 1).collect()}
    # mean of each 2 x 2 block of 0, 16, 32, ...
    assert grey["grey.png"] == pytest.approx([40 / 255, 72 / 255, 168 / 255, 200 / 255])
    assert grey["red.png"] == pytest.approx([round(0.299 * 200 + 0.587 * 100 + 0.114 * 50) / 255] * 4)


def test_enlarging_repeats_the_edges(spark, folder):
    rows = I.read_images(spark, folder).filter(F.col("origin").endswith("grey.png"))
    pixels = I.decode_images(rows, 8, 1).first()["pixels"]
    assert pixels[:3] == pytest.approx([0.0, 4 / 255, 12 / 255])


def test_pixel_columns(spark):
    df = spark.createDataFrame([(3, 10, 20, 30)], "label int, pixel1 int, pixel2 int, pixel3 int")
    out = I.to_training_table(I.pixels_to_array(df, n=3), "features", "label").first()
    assert out["features"] == [10.0, 20.0, 30.0] and out["label"] == 3


def test_segment_needs_a_whole_folder(spark):
    df = spark.createDataFrame([("/a/not_fractured/x.png",)], "path string")
    assert df.select(path_label(F.col("path"), ["fractured"])).first()[0] == -1
