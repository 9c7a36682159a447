"""Files listed without reading them, those of length zero too."""

import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import images as I
from millrace.sources import listing as L
from millrace.sources.files import list_labeled_files, read_files


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root, r = tmp_path_factory.mktemp("tree"), random.Random(1)
    sizes = {}
    for i in range(60):
        folder = root.joinpath(*[f"d{r.randrange(3)}" for _ in range(r.randrange(5))])
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / f"f{i}.{r.choice(['png', 'txt', 'PNG'])}"
        path.write_bytes(b"x" * r.choice([0, 0, 1, 50]))
        sizes[str(path)] = path.stat().st_size
    (root / "_hidden").mkdir()
    (root / "_hidden" / "a.png").write_bytes(b"x")
    (root / ".crc.png").write_bytes(b"x")
    return str(root), sizes


@pytest.mark.parametrize("enough", [1, 4, 256])
@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_every_file_once_with_its_length(spark, tree, monkeypatch, enough, scheme):
    monkeypatch.setattr(L, "DIRECTORIES", enough)
    root, sizes = tree
    rows = L.list_files(spark, scheme + root).collect()
    assert {r["path"].removeprefix(scheme): r["length"] for r in rows} == sizes and len(rows) == len(sizes)
    pictures = L.list_files(spark, root, "*.{png,jpg}").collect()
    assert {r["path"] for r in pictures} == {p for p in sizes if p.endswith(".png")}
    flat = L.list_files(spark, root, recursive=False).collect()
    assert {r["path"] for r in flat} == {p for p in sizes if os.path.dirname(p) == root}


def test_given_files_and_missing_ones(spark, tree):
    root, sizes = tree
    one, two = sorted(sizes)[:2]
    assert {r["path"] for r in L.list_files(spark, [one, two]).collect()} == {one, two}
    with pytest.raises(Exception, match="nowhere"):
        L.list_files(spark, root + "/nowhere").collect()


def test_empty_files_are_files(spark, tree):
    root, sizes = tree
    files = read_files(spark, root)
    got = {r["path"].replace("file:///", "file:/").removeprefix("file:"): bytes(r["content"]) for r in files.collect()}
    assert {p: len(c) for p, c in got.items()} == sizes


def test_an_empty_picture_is_listed_and_unreadable(spark, tmp_path):
    (tmp_path / "meal").mkdir()
    (tmp_path / "meal" / "nothing.png").write_bytes(b"")
    (tmp_path / "meal" / "text.png").write_text("no picture")
    listed = list_labeled_files(spark, str(tmp_path), ["meal"]).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["label_str"]) for r in listed) == [("nothing.png", "meal"), ("text.png", "meal")]
    good, bad = I.split_bad_records(I.read_images(spark, str(tmp_path)))
    assert good.count() == 0
    assert sorted(r["origin"].rsplit("/", 1)[1] for r in bad.collect()) == ["nothing.png", "text.png"]


def test_pictures_of_mixed_shapes_in_small_slices(spark, monkeypatch):
    r = random.Random(2)
    shapes = [(r.choice([1, 3, 5]), r.choice([2, 4]), r.choice([1, 3, 4])) for _ in range(40)]
    rows = [(i, h, w, c, bytearray(r.randrange(256) for _ in range(h * w * c))) for i, (h, w, c) in enumerate(shapes)]
    df = spark.createDataFrame(rows, "id int, height int, width int, nChannels int, data binary").repartition(3)
    for method in ("bilinear", "bicubic"):
        for channels in (1, 3):
            whole = {x["id"]: x["pixels"] for x in I.decode_images(df, (3, 2), channels, method).collect()}
            monkeypatch.setattr(I, "PIXEL_BYTES", 200)
            cut = I.decode_images(df, (3, 2), channels, method, "float")
            assert cut.schema["pixels"].dataType.simpleString() == "array<float>"
            for x in cut.collect():
                assert len(x["pixels"]) == 6 * channels and x["pixels"] == pytest.approx(whole[x["id"]], abs=1e-6)
            monkeypatch.undo()
    same = spark.createDataFrame(rows[:1], df.schema)
    one = I.decode_images(same, shapes[0][:2], shapes[0][2] if shapes[0][2] == 1 else 3).select(F.size("pixels")).first()[0]
    assert one == shapes[0][0] * shapes[0][1] * (1 if shapes[0][2] == 1 else 3)
