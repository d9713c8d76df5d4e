"""Photo files, their manifest and scoring with failures."""

import os

import pytest

from parcelspark.session import scratch_path
from parcelspark.sources import photos


@pytest.fixture
def folder(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"p{i}.jpg").write_bytes(bytes([i]) * (10 + i))
    (tmp_path / "big.jpg").write_bytes(b"x" * 5000)
    (tmp_path / "bad.jpg").write_bytes(b"bad")
    return str(tmp_path)


def manifest(spark):
    rows = [(f"h{i}", f"https://host/a/p{i}.jpg", f"f{i}") for i in range(12)]
    rows += [("h1", "https://host/b/big.jpg", "big"), ("h2", "https://host/bad.jpg", "bad"),
             ("h3", "https://host/none.jpg", "none"), ("h4", None, "null"),
             ("h5", "https://host/p5.jpg", "again")]
    return spark.createDataFrame(rows, "property_hash string, photo_url string, photo_hash string")


def test_every_manifest_row_comes_out(spark, folder):
    files = photos.photo_files(spark, folder, manifest(spark), max_bytes=1000, task_bytes=40)
    got = {r.photo_hash: r for r in files.collect()}
    assert len(got) == 17 and got["big"].problem == photos.TOO_LARGE
    assert got["none"].problem == got["null"].problem == photos.MISSING
    assert got["f3"].length == 13 and got["f3"].problem is None
    load = {}
    for r in got.values():
        if r.problem is None:
            load[r.task] = load.get(r.task, 0) + r.length
    assert max(load.values()) <= 40 + 21


def test_failures_are_kept_and_tried_again(spark, folder):
    count = scratch_path(spark, "calls")
    os.makedirs(count)

    def scorer(image):
        name = "bad" if image == b"bad" else str(image[0])
        with open(f"{count}/{name}", "a") as f:
            f.write("x")
        if name == "bad":
            raise ValueError("no picture")
        if name == "7" and os.path.getsize(f"{count}/{name}") == 1:
            raise OSError("once")
        return f'{{"size": {len(image)}}}'

    files = photos.photo_files(spark, folder, manifest(spark), max_bytes=1000)
    out = photos.score_files(spark, folder, files, scorer, attempts=3, max_bytes=1000)
    got = {r.photo_hash: r for r in out.collect()}
    assert len(got) == 17
    assert got["bad"].error == "ValueError: no picture" and got["bad"].attempts == 3
    assert got["f7"].error is None and got["f7"].attempts == 2
    assert got["f3"].score_json == '{"size": 13}' and got["f3"].attempts == 1
    assert got["again"].score_json == got["f5"].score_json
    assert got["big"].error == photos.TOO_LARGE and got["big"].attempts == 0
    assert got["none"].error == photos.MISSING and got["none"].score_json is None
    # Only what failed was scored again.
    assert os.path.getsize(f"{count}/bad") == 3 and os.path.getsize(f"{count}/3") == 1


def test_one_listing_serves_sizes_and_scores(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from parcelspark.sources import photos, tables

    for i in range(4):
        (tmp_path / f"{i}.jpg").write_bytes(b"x" * (i + 1))
    listed = tables.binary_files(spark, str(tmp_path))
    monkeypatch.setattr(photos, "binary_files", None)
    sizes = tables.file_sizes(spark, str(tmp_path), listed=listed)
    manifest = sizes.select(F.col("path").alias("photo_url"), F.col("length").cast("string").alias("photo_hash"))
    files = photos.photo_files(spark, str(tmp_path), manifest, 3, listed=listed)

    def scorer(image):
        if len(image) == 2:
            raise ValueError("two")
        return str(len(image))

    out = photos.score_files(spark, str(tmp_path), files, scorer, max_bytes=3, listed=listed)
    assert "content" not in out.columns
    got = {r["photo_hash"]: (r["score_json"], r["error"], r["attempts"]) for r in out.collect()}
    assert got == {"1": ("1", None, 1), "2": (None, "ValueError: two", 2), "3": ("3", None, 1),
                   "4": (None, "too large", 0)}
