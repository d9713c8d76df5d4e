"""Photo files joined with their manifest, and scoring that keeps its failures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.operators.skew import lookup_join
from parcelspark.session import stage
from parcelspark.sources.tables import binary_files

#: Largest photo that is read, and bytes of photos that one task scores.
MAX_BYTES, TASK_BYTES = 32 << 20, 256 << 20
TOO_LARGE, MISSING = "too large", "missing"


def photo_files(spark: SparkSession, folder: str, manifest: DataFrame,
                max_bytes: int = MAX_BYTES, task_bytes: int = TASK_BYTES,
                listed: DataFrame | None = None) -> DataFrame:
    """``(manifest columns, length, task, problem)``: a row for each row of the manifest.

    A photo is found by its path, where ``photo_url`` is one, or by the last part of it. Sizes come from the listing; no content is
    read here. ``problem`` is set for photos without a file and for those above ``max_bytes``; the
    others are dealt into tasks of about ``task_bytes``. Rows that name one file have it each.
    ``listed`` is a listing of the folder by :func:`binary_files`; without it the folder is listed here.
    """
    name = F.element_at(F.split("path", "/"), -1)
    listed = ((binary_files(spark, folder) if listed is None else listed)
              .select(name.alias("_name"), "path", "length").filter(~F.col("_name").rlike("^[._]")))
    listed = stage(listed, "files")
    # Of several files with one name the first path counts.
    files = listed.groupBy("_name").agg(F.min_by(F.struct("path", "length"), "path").alias("_file"))
    named = manifest.withColumns({"_name": F.element_at(F.split("photo_url", "/"), -1),
                                  "_path": F.col("photo_url")})
    exact = listed.select(F.col("path").alias("_path"), F.struct("path", "length").alias("_own"))
    met = lookup_join(lookup_join(named, stage(files, "files"), ["_name"]), exact, ["_path"])
    found = F.coalesce("_own", "_file")
    met = met.select(*manifest.columns, found["path"].alias("path"), found["length"].alias("length"))
    problem = F.when(F.col("path").isNull(), MISSING).when(F.col("length") > max_bytes, TOO_LARGE)
    # The running sum is taken inside hashed groups, so that no task lines up all photos.
    group = F.pmod(F.xxhash64("path"), F.lit(64))
    line = Window.partitionBy(group).orderBy("path", *[c for c in ("property_hash", "photo_hash")
                                                       if c in manifest.columns])
    size = F.when(problem.isNull(), F.col("length")).otherwise(0)
    task = F.concat_ws("-", group, F.floor((F.sum(size).over(line) - size) / task_bytes))
    return met.withColumns({"problem": problem, "task": task})


def _scored(photos: DataFrame, scorer: Callable[[bytes], str | None]) -> DataFrame:
    """Columns of ``photos`` with ``score_json`` and ``error``; content stays only where the scorer raised."""
    keep = [c for c in photos.columns if c != "content"]
    schema = T.StructType([photos.schema[c] for c in keep] + [
        T.StructField("score_json", T.StringType()), T.StructField("error", T.StringType()),
        T.StructField("content", T.BinaryType())])

    def attempt(image) -> tuple[str | None, str | None]:
        try:
            return scorer(bytes(image)), None
        except Exception as problem:  # a caller's scorer may raise anything; the row says what
            return None, f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [attempt(image) for image in batch["content"]]
            yield batch[keep].assign(
                score_json=[j for j, _ in found], error=[e for _, e in found],
                content=[None if e is None else image for (_, e), image in zip(found, batch["content"])])

    return photos.mapInPandas(run, schema)


def score_files(spark: SparkSession, folder: str, files: DataFrame,
                scorer: Callable[[bytes], str | None], attempts: int = 2,
                max_bytes: int = MAX_BYTES, listed: DataFrame | None = None) -> DataFrame:
    """Score the photos of :func:`photo_files`: its columns, ``score_json``, ``error``, ``attempts``.

    Every row of ``files`` comes out once. ``error`` is the photo's problem, or what the scorer raised
    at its last attempt; only rows that raised are tried again. Each attempt is written down, so a
    lost executor repeats no scored photo of an earlier one. The content of photos that raised is
    written with it, so the folder is read once. Content above ``max_bytes`` isn't read. ``listed`` as in
    :func:`photo_files`.
    """
    files = stage(files, "photos")
    content = ((binary_files(spark, folder) if listed is None else listed)
               .filter(F.col("length") <= max_bytes).select(F.col("path").alias("_path"), "content"))
    done = files.filter("problem IS NOT NULL").withColumns({
        "score_json": F.lit(None).cast("string"), "error": F.col("problem"), "attempts": F.lit(0)})
    left = files.filter("problem IS NULL").join(content, F.col("path") == F.col("_path")).drop("_path")
    for turn in range(1, attempts + 1):
        out = _scored(left.repartition("task"), scorer).withColumn("attempts", F.lit(turn))
        out = stage(out if turn < attempts else out.drop("content"), "scores")
        again = out.filter("error IS NOT NULL") if turn < attempts else None
        done = done.unionByName((out if again is None else out.filter("error IS NULL"))
                                .select(*done.columns))
        if again is None or again.select("path").isEmpty():
            break
        left = again.select(*files.columns, "content")
    return done.drop("task", "problem")
