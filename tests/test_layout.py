"""Hash trees, curve layout, compaction and stored profiles."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelspark.operators import profiles
from parcelspark.session import scratch_path, stage
from parcelspark.sources import hashtree, tables


@pytest.fixture(scope="module")
def rows(spark):
    return stage(spark.range(40_000).select(
        F.concat(F.lit("k"), "id").alias("key"), (F.col("id") * 31 % 97).alias("a"),
        F.when(F.col("id") % 7 > 0, F.col("id") * 17 % 101).alias("b"),
        (F.col("id") / 3).alias("price")), "rows")


def trees(spark, *tables_, keys=("key",)):
    paths = [scratch_path(spark, "tree") for _ in tables_]
    for df, path in zip(tables_, paths):
        hashtree.write_with_tree(df, path, list(keys), files=6)
    return paths


def test_equal_tables_are_told_by_their_roots(spark, rows):
    out = hashtree.compare_trees(spark, *trees(spark, rows, rows.repartition(3)), ["key"])
    assert out.rows.count() == 0 and out.nodes == 1 and out.leaves == []


def test_only_differing_leaves_are_read(spark, rows):
    changed = rows.withColumn("price", F.when(F.col("key") == "k77", -1.0).otherwise(F.col("price")))
    changed = changed.filter("key <> 'k123'").unionByName(rows.filter("key = 'k9'")).unionByName(
        rows.filter("key = 'k5'").withColumn("key", F.lit("new")))
    # A value that moves to an empty column is a change as well.
    changed = changed.withColumn("b", F.when(F.col("key") == "k14", F.lit(0)).otherwise(F.col("b")))
    out = hashtree.compare_trees(spark, *trees(spark, rows, changed), ["key"])
    assert {r.key: r.change for r in out.rows.collect()} == {
        "k77": "changed", "k123": "lost", "k9": "changed", "new": "added", "k14": "changed"}
    assert 1 <= len(out.leaves) <= 5
    # Sixteen children of each differing node, and no more.
    assert out.nodes <= 1 + 16 + 5 * 16 + 5 * 16
    plan = out.rows._jdf.queryExecution().toString()
    assert "PushedFilters: [In(_leaf" in plan or "PushedFilters: [EqualTo(_leaf" in plan or "In(_leaf" in plan


def test_null_and_repeated_keys_and_other_columns(spark):
    schema = "key string, day int, v string"
    a = spark.createDataFrame([(None, 1, "x"), (None, 1, "x"), ("a", None, None), ("b", 2, "y")], schema)
    b = spark.createDataFrame([(None, 1, "x"), ("a", None, None), ("c", 2, "y")], schema)
    out = hashtree.compare_trees(spark, *trees(spark, a, b, keys=("key", "day")), ["key", "day"])
    assert {(r.key, r.day): r.change for r in out.rows.collect()} == {
        (None, 1): "changed", ("b", 2): "lost", ("c", 2): "added"}
    out = hashtree.compare_trees(spark, *trees(spark, a, a.drop("v"), keys=("key", "day")), ["key", "day"])
    assert {r.change for r in out.rows.collect()} == {"changed"} and out.rows.count() == 3
    none = a.limit(0)
    out = hashtree.compare_trees(spark, *trees(spark, none, b, keys=("key", "day")), ["key", "day"])
    assert {r.change for r in out.rows.collect()} == {"added"}
    assert hashtree.compare_trees(spark, *trees(spark, none, none, keys=("key", "day")),
                                  ["key", "day"]).rows.count() == 0


def test_rows_of_both_sides_meet_in_one_shuffle(spark, rows, monkeypatch):
    seen, real = [], hashtree.setting
    monkeypatch.setattr(hashtree, "setting", lambda s, name, value: (seen.append((name, value)),
                                                                     real(s, name, value))[1])
    paths = trees(spark, rows, rows.withColumn("price", F.when(F.col("a") == 5, 0.0).otherwise(F.col("price"))))
    # The shuffle files of each table go when it is written.
    assert [v for _, v in seen] == ["true", "true"] and {"fileCleanup" in n for n, _ in seen} == {True}
    out = hashtree.compare_trees(spark, *paths, ["key"])
    changed = out.rows
    assert changed.count() == rows.filter("a = 5").count()
    plan = changed._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan.replace("BroadcastHashJoin", "")
    whole = changed._jdf.queryExecution().executedPlan().toString()
    assert whole.count("Exchange hashpartitioning(key") == 1
    names = [n for p in paths for n in glob.glob(f"{p}/rows/*.parquet")]
    assert names and all(pq.ParquetFile(n).metadata.row_group(0).column(0).compression == "ZSTD" for n in names)


def files_with(path, column, value):
    """Files whose statistics allow the value."""
    hits = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                col = meta.row_group(g).column(c)
                if col.path_in_schema == column and col.statistics.min <= value <= col.statistics.max:
                    hits += 1
    return hits


def test_curve_skips_files_for_every_column(spark, rows):
    rng = random.Random(2)
    wide = stage(rows.select("a", F.col("b"), (F.xxhash64("key") % 89).alias("c"), "price"), "wide")
    sorted_, curve = scratch_path(spark, "sorted"), scratch_path(spark, "curve")
    tables.write_clustered(wide, sorted_, ["a", "b", "c"], files=64)
    tables.write_on_curve(wide, curve, ["a", "b", "c"], files=64)
    assert spark.read.parquet(curve).exceptAll(wide).count() == 0
    assert wide.exceptAll(spark.read.parquet(curve)).count() == 0
    for column in ("b", "c"):
        values = [rng.randint(0, 80) for _ in range(5)]
        assert (sum(files_with(curve, column, v) for v in values)
                < 0.7 * sum(files_with(sorted_, column, v) for v in values))


def test_curve_of_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1), ("x", None), (None, None)], "a string, b int")
    for part in (df, df.limit(0)):
        path = scratch_path(spark, "curve")
        tables.write_on_curve(part, path, ["a", "b"])
        assert spark.read.schema(df.schema).parquet(path).count() == part.count()


def test_compaction_packs_small_files(spark, rows):
    base = scratch_path(spark, "base")
    df = rows.withColumn("part", F.col("a") % 3)
    small = scratch_path(spark, "small")
    df.repartition(40).write.partitionBy("part").parquet(small)
    spark.range(1).select(F.lit("2026.05.12").alias("version"), F.lit(small).alias("folder"),
                          F.current_timestamp().alias("published_at")).write.parquet(f"{base}/manifest")
    jobs = tables.compaction_jobs(tables.file_sizes(spark, small), 200_000)
    sizes = [r.s for r in jobs.groupBy("folder", "job").agg(F.sum("length").alias("s")).collect()]
    assert max(sizes) < 2 * 200_000 and jobs.select("path").distinct().count() == 120
    folder = tables.compact(spark, base, 200_000, partition_by=["part"])
    assert tables.snapshot_folder(spark, base) == folder
    back = tables.read_snapshot(spark, base).select(*df.columns)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    files = tables.file_sizes(spark, folder).count()
    assert files <= len(sizes) + 3 < 40


def test_profiles_roll_up_like_raw_rows(spark):
    log = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "blue").otherwise("green").alias("served_by"),
        F.timestamp_seconds(F.col("id") * 7).alias("ts"),
        F.when(F.col("id") % 50 == 0, F.lit(float("nan"))).when(F.col("id") % 51 == 0, None).otherwise(
            (F.col("id") * 7919 % 10_007).cast("double")).alias("latency_ms"),
        (F.col("id") % 10 == 0).cast("int").alias("is_error"))
    minutes = stage(profiles.profile(log), "minutes")
    days = profiles.roll_up(stage(profiles.roll_up(minutes, "hour"), "hours"), "day")
    got = {(r.served_by, r.slot): r for r in profiles.health(days).collect()}
    sound = "latency_ms IS NOT NULL AND NOT isnan(latency_ms)"
    want = log.groupBy("served_by", F.date_trunc("day", "ts").alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("is_error").alias("e"), F.expr(
            f"percentile(latency_ms, array(0.47, 0.53, 0.92, 0.98)) FILTER (WHERE {sound})").alias("p"))
    for r in want.collect():
        own = got[(r.served_by, r.slot)]
        assert own.requests == r.n and own.error_rate == pytest.approx(r.e)
        assert r.p[0] <= own.p50 <= r.p[1] and r.p[2] <= own.p95 <= r.p[3]
    base = profiles.roll_up(minutes, "year")
    calm = profiles.profile_drift(base, days).collect()
    assert calm and all(r.psi < 0.05 and not r.alert for r in calm)
    slow = profiles.roll_up(profiles.profile(log.withColumn("latency_ms", F.col("latency_ms") * 3)), "day")
    assert all(r.alert for r in profiles.profile_drift(base, slow).collect())
    none = profiles.profile(log.filter("latency_ms IS NULL"))
    assert all(r.p95 is None for r in profiles.health(none).collect())
    assert all(r.psi is None for r in profiles.profile_drift(base, none).collect())
