"""Anonymization, sampling, sources, enrichment and features on small rows."""

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parcelspark.functions.geo import hex_cell
from parcelspark.functions.scalars import fine_band, half_even, month_index, size_band
from parcelspark.operators import enrich, features, privacy, sampling
from parcelspark.session import scratch_path
from parcelspark.sources import landing, synthetic, tables

SALT = "s" * 32


def values(df, col):
    return [r[col] for r in df.collect()]


def test_size_band_edges(spark):
    df = spark.createDataFrame([(39.9,), (40.0,), (99.9,), (100.0,), (199.9,), (200.0,), (None,)],
                               "s double")
    assert values(df.select(size_band(F.col("s")).alias("b")), "b") == [
        "<40", "40-100", "40-100", "100-200", "100-200", "200+", None]
    assert values(df.select(fine_band(F.col("s")).alias("b")), "b") == [
        30, 40, 90, 100, 190, 200, None]


def test_half_even(spark):
    df = spark.createDataFrame([(150.0,), (250.0,), (251.0,), (-250.0,)], "x double")
    assert values(df.select(half_even(F.col("x")).alias("y")), "y") == [200, 200, 300, -200]


def test_pseudonym(spark):
    df = spark.createDataFrame([("p1", "Ann", 5), (None, "Bob", 6)],
                               "property_id string, owner_name string, x int")
    out = privacy.pseudonymize(df, "property_id", SALT)
    assert set(out.columns) == {"property_hash", "x"}
    want = hashlib.sha256((SALT + "p1").encode()).hexdigest()[:16]
    assert values(out, "property_hash") == [want, None]
    for bad in (None, "short"):
        with pytest.raises(ValueError):
            privacy.pseudonymize(df, "property_id", bad)


def test_hex_cells(spark):
    df = spark.createDataFrame([(48.86, 2.34), (48.8601, 2.3401), (43.3, 5.4), (None, 1.0)],
                               "lat double, lon double")
    a, b, c, d = values(df.select(hex_cell(F.col("lat"), F.col("lon")).alias("h")), "h")
    assert a == b and a != c and d is None


def test_hex_cell_is_the_nearest_centre(spark):
    import math
    edge = math.sqrt(2 * 0.737 / (3 * math.sqrt(3)))
    df = spark.range(2000).select((F.rand(1) * 160 - 80).alias("lat"),
                                  (F.rand(2) * 340 - 170).alias("lon"))
    df = df.withColumn("h", hex_cell(F.col("lat"), F.col("lon")))
    for lat, lon, cell in df.toPandas().itertuples(index=False):
        x, y = math.radians(lon) * 6371.0088, math.sin(math.radians(lat)) * 6371.0088
        q, r = map(int, cell.split("_"))

        def gap(q, r):
            return math.hypot(x - edge * math.sqrt(3) * (q + r / 2), y - edge * 1.5 * r)

        near = [gap(q + i, r + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        assert gap(q, r) == min(near)


def groups(spark, sizes, null_rows=0):
    rows = [(f"c{i}", "house", "2021-01", "<40", i * 1000 + j)
            for i, n in enumerate(sizes) for j in range(n)]
    rows += [(None, "house", "2021-01", "<40", -j) for j in range(null_rows)]
    return spark.createDataFrame(rows, "geo_h3_r8 string, property_type string, "
                                       "sale_month string, size_band string, id int")


def test_k_anonymity_boundary_and_nulls(spark):
    df = groups(spark, [9, 10, 11], null_rows=15)
    kept = privacy.k_anonymize(df)
    assert {r["geo_h3_r8"]: r["count"] for r in kept.groupBy("geo_h3_r8").count().collect()} == {
        "c1": 10, "c2": 11}
    assert privacy.k_anonymize(kept).count() == kept.count()


def test_k_report(spark):
    df = groups(spark, [9, 10, 11], null_rows=5)
    r = privacy.k_report(df).first()
    assert (r["total_rows"], r["kept_rows"], r["dropped_rows"]) == (35, 21, 14)
    assert (r["size_min"], r["size_p50"], r["size_max"], r["size_mean"]) == (9, 10, 11, 10)
    assert r["size_std"] == pytest.approx(1.0)
    assert r["dropped_share"] == pytest.approx(14 / 35)


def test_privacy_report(spark):
    df = groups(spark, [9, 12]).withColumn("email", F.lit("e"))
    out = privacy.k_anonymize(df).drop("email")
    got = {r["item"]: r["value"] for r in privacy.privacy_report(df, out).collect()}
    assert got["rows_dropped"] == "9" and got["smallest_group"] == "12"
    assert got["k_holds"] == "true" and got["columns_removed"] == "email"
    assert got["direct_ids_left"] == "" and "id:int" in got["schema"]


def test_laplace_noise_is_repeatable_and_small(spark):
    df = spark.range(2000).select("id", F.lit(1000.0).alias("p"))
    a = privacy.laplace_noise(df, "p", ["id"], "k").toPandas()["p"]
    b = privacy.laplace_noise(df.repartition(3), "p", ["id"], "k").toPandas()["p"]
    assert sorted(a) == sorted(b)
    assert abs(a.mean() - 1000) < 1 and (a - 1000).abs().mean() == pytest.approx(5, rel=0.1)


def months(spark, n, rows_each=3):
    return spark.createDataFrame([(f"2021-{m:02d}", m * 10 + i) for m in range(1, n + 1)
                                  for i in range(rows_each)], "sale_month string, id int")


@pytest.mark.parametrize("n", [6, 7])
def test_time_split_is_complete_and_disjoint(spark, n):
    train, holdout = sampling.time_split(months(spark, n))
    assert holdout.select("sale_month").distinct().count() == 6
    assert train.count() + holdout.count() == n * 3 and train.count() == (n - 6) * 3


def test_time_split_needs_enough_months(spark):
    with pytest.raises(ValueError, match="6 distinct months, found 5"):
        sampling.time_split(months(spark, 5))


def test_time_split_prunes_partitions(spark):
    path = scratch_path(spark, "split")
    tables.write_table(months(spark, 9), path)
    df = spark.read.schema("id int, sale_month string").parquet(path)
    plan = sampling.time_split(df)[1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_month" in plan.replace("#", "#") and "Cartesian" not in plan


def test_folds_train_only_on_the_past(spark):
    out = sampling.rolling_origin_folds(months(spark, 12, 1), folds=5, horizon=2).toPandas()
    for _, g in out.groupby("fold"):
        train, test = (g[g.role == r].sale_month for r in ("train", "test"))
        assert len(test) == 2 and train.max() < test.min()
    assert sorted(out[out.role == "test"].sale_month) == [f"2021-{m:02d}" for m in range(3, 13)]


def test_stratified_sample_sizes(spark):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("region_code"),
        F.lit("house").alias("property_type"),
        F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 600).cast("int")).alias("sale_date"),
        F.lit(50.0).alias("size_sqm"), F.when(F.col("id") > 20, 1.0).alias("sale_price"))
    out = sampling.stratified_sample(df, "2002-12-31", ["id"])
    known = df.filter("sale_price is not null").withColumn("y", F.year("sale_date"))
    want = known.groupBy("region_code", "y").count().selectExpr("sum(ceil(count * 0.1D)) AS n").first()[0]
    assert out.count() == want
    assert "rn" not in out.columns and "bucket_size" not in out.columns


def test_partition_columns_survive_landing(spark):
    path = scratch_path(spark, "land")
    tables.write_table(months(spark, 3), path)
    back = landing.read_landing(spark, path, None)
    assert back.schema["sale_month"].dataType.typeName() == "string"
    pruned = back.filter("sale_month = '2021-02'")
    assert pruned.count() == 3 and len(pruned.inputFiles()) == 1 or "PartitionFilters" in str(
        pruned._jdf.queryExecution())
    stamped = landing.stamp_ingest(back)
    assert stamped.filter("source_file like '%sale_month=2021-0%' and ingested_at is not null"
                          ).count() == 9


def test_dynamic_overwrite_keeps_other_months(spark):
    path = scratch_path(spark, "overwrite")
    tables.write_table(months(spark, 3), path)
    tables.write_table(months(spark, 1, 1), path)
    assert spark.read.parquet(path).count() == 7


def test_clustered_files_have_narrow_ranges(spark):
    import glob

    import pyarrow.parquet as pq
    path = scratch_path(spark, "clustered")
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("c"))
    tables.write_clustered(df, path, ["c"], files=4)
    spans = []
    for f in glob.glob(path.replace("file:", "") + "/*.parquet"):
        s = pq.ParquetFile(f).metadata.row_group(0).column(0).statistics
        spans.append((s.min, s.max))
    spans.sort()
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_snapshots(spark):
    base = scratch_path(spark, "snap")
    tables.publish_snapshot(spark.range(1), base, "2026.04.12")
    tables.publish_snapshot(spark.range(2), base, "2026.05.12")
    tables.publish_snapshot(spark.range(3), base, "2026.04.12")
    assert tables.read_snapshot(spark, base).count() == 2
    assert tables.read_snapshot(spark, base, "2026.04.12").count() == 3
    with pytest.raises(ValueError):
        tables.read_snapshot(spark, base, "2020.01.01")
    with pytest.raises(ValueError):
        tables.publish_snapshot(spark.range(1), base, "latest")


def test_reconcile_finds_a_changed_row(spark):
    a = months(spark, 3)
    b = a.withColumn("id", F.when(F.col("id") == 20, 99).otherwise(F.col("id")))
    bad = landing.reconcile(a, b, ["sale_month"]).filter("not matches")
    assert values(bad, "sale_month") == ["2021-02"]
    missing = landing.reconcile(a, a.filter("sale_month > '2021-01'"), ["sale_month"])
    assert values(missing.filter("not matches"), "sale_month") == ["2021-01"]


def test_reconcile_sees_moved_nulls_lost_columns_and_null_partitions(spark):
    kind = "m string, a string, b string"
    src = spark.createDataFrame([("1", "x", None), (None, "y", "z")], kind)
    moved = spark.createDataFrame([("1", None, "x"), (None, "y", "z")], kind)
    got = {r["m"]: r["matches"] for r in landing.reconcile(src, moved, ["m"]).collect()}
    assert got == {"1": False, None: True}
    assert landing.reconcile(src, src, ["m"]).filter("matches").count() == 2
    assert landing.reconcile(src, src.drop("b"), ["m"]).filter("matches").count() == 0
    wide = src.withColumn("b", F.lit(1))
    assert landing.reconcile(src, wide, ["m"]).filter("matches").count() == 0


def test_retention_edges(spark):
    df = spark.createDataFrame([("2025-06-01",), ("2025-05-31",), ("2019-06-01",), ("2019-05-31",),
                                (None,)], "d string").withColumn("d", F.to_date("d"))
    assert values(landing.retention_tier(df, "d", "2026-06-01"), "tier") == [
        "hot", "cold", "cold", "expired", None]


def test_manifest_by_suffix(spark):
    df = spark.createDataFrame([("h", "u", "007")], "property_hash string, photo_url string, photo_hash string")
    base = scratch_path(spark, "manifest")
    df.write.parquet(base)
    df.write.option("header", True).csv(base + ".csv")
    for path in (base, base + ".csv"):
        assert landing.read_manifest(spark, path).first().asDict() == df.first().asDict()


def test_append_files_fills_missing_columns(spark):
    out = enrich.append_files(spark.range(1).toDF("id"), spark.range(1).withColumn("x", F.lit(1)))
    assert sorted(values(out, "x"), key=str) == [1, None]


def test_row_count_without_a_second_pass(spark):
    df, seen = enrich.with_row_count(spark.range(12), "rows")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 12


def test_table_or_none(spark):
    assert tables.table_or_none(spark, "silver_property_vision") is None


def test_enrich_keeps_rows_and_checks_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("a", 1.0)], "k string, v double")
    out = enrich.enrich(facts, [(dim, ["k"])])
    assert {r["id"]: r["v"] for r in out.collect()} == {1: 1.0, 2: None, 3: None}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    large = enrich.enrich(facts, [(dim, ["k"])], max_bytes=0)
    assert {r["id"]: r["v"] for r in large.collect()} == {1: 1.0, 2: None, 3: None}
    with pytest.raises(ValueError, match="not unique"):
        enrich.enrich(facts, [(dim.union(dim), ["k"])])


SILVER = ("property_hash string, postcode_prefix string, size_sqm double, year_built int")


def test_gold_schema_does_not_depend_on_vision(spark):
    silver = spark.createDataFrame([("p", "750", 75.0, 1965), ("q", "750", 50.0, 2000)], SILVER)
    vision = spark.createDataFrame([("p", 0.8, 0.7, 0.9, 1)], "property_hash string, "
                                   "condition_score double, roof_condition double, "
                                   "curb_appeal double, renovation_flag int")
    bare = features.gold_features(silver)
    full = features.gold_features(silver, vision)
    assert {f.name: f.dataType for f in bare.schema} == {f.name: f.dataType for f in full.schema}
    assert bare.filter("has_vision_score = 0 and condition_score = 0.6 and renovation_flag = 0"
                       ).count() == 2
    rows = {r["property_hash"]: r for r in full.collect()}
    assert rows["p"]["condition_score"] == 0.8 and rows["p"]["has_vision_score"] == 1
    assert rows["q"]["condition_score"] == 0.6 and rows["q"]["has_vision_score"] == 0
    assert rows["p"]["age_years"] == 61
    regional = {r["property_hash"]: r for r in
                features.gold_features(silver, vision, impute="regional").collect()}
    assert regional["q"]["condition_score"] == 0.8 and regional["q"]["renovation_flag"] == 1


def test_comparables_ignore_the_future(spark):
    rows = [("c", "2021-01", 100.0, 10.0), ("c", "2021-03", 300.0, 10.0), ("c", "2021-09", 5.0, 1.0)]
    schema = "geo_h3_r8 string, sale_month string, sale_price double, size_sqm double"
    got = {r["sale_month"]: (r["recent_sales_h3"], r["price_per_sqm_h3"]) for r in
           features.recent_comparables(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"2021-01": (0, None), "2021-03": (1, 10.0), "2021-09": (1, 30.0)}
    changed = rows[:2] + [("c", "2021-09", 9e9, 1.0)]
    again = {r["sale_month"]: r["price_per_sqm_h3"] for r in
             features.recent_comparables(spark.createDataFrame(changed, schema)).collect()}
    assert again["2021-03"] == 10.0 and again["2021-01"] is None


def test_month_index(spark):
    df = spark.createDataFrame([("2021-12",), ("2022-01",)], "m string")
    a, b = values(df.select(month_index(F.col("m")).alias("i")), "i")
    assert b - a == 1


def test_synthetic_does_not_depend_on_partitions(spark):
    a = synthetic.synthetic_valuations(spark, 500, 7)
    b = synthetic.valuations_for(spark.range(0, 500, 1, 3), "id", 7)
    assert a.exceptAll(b).count() == 0
    pdf = a.toPandas()
    assert pdf.sale_price.between(25_000, 5_000_000).all() and (pdf.sale_price % 100 == 0).all()
    assert pdf.size_sqm.between(18, 350).all() and pdf.rooms.between(1, 8).all()
    assert set(pdf.property_type) == {"apartment", "house", "studio", "duplex"}
    assert pdf.sale_month.min() >= "2021-01" and pdf.sale_month.max() <= "2026-04"


def test_errors_are_pyspark_or_value_errors(spark):
    with pytest.raises((ValueError, PySparkException)):
        features.gold_features(spark.createDataFrame([("p", "750", 7.0, 1900)], SILVER),
                               impute="mean")


SMALL = "/root/testdata/sf0.001"


def test_enriched_and_landed_rows_are_joined_once(spark):
    """What is left to run reads staged rows, none of the given tables again."""
    from parcelspark.plans import refine

    for query in (refine.silver_enrich, refine.landing_reconcile):
        left = query(spark, SMALL).inputFiles()
        assert left and not [f for f in left if SMALL in f]


def test_matrix_and_differences_stage_their_rows_once(spark, monkeypatch):
    from parcelspark.plans import refine, retrain

    staged = []
    for module in (refine, retrain):
        monkeypatch.setattr(module, "stage", lambda df, label, real=module.stage: (
            staged.append(label), real(df, label))[1])
    retrain.model_matrix(spark, SMALL)
    assert staged == ["rows", "matrix"]
    staged.clear()
    refine.landing_differences(spark, SMALL)
    assert staged == []
