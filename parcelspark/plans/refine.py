"""Queries: anonymization, sampling, sources and the bronze, silver and gold layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelspark.functions.scalars import fine_band, size_band
from parcelspark.operators import enrich as E
from parcelspark.operators import features, privacy, sampling
from parcelspark.plans.fixtures import (AS_OF, DIMENSIONS, SALT, bronze, dimension, photo_scores,
                                        table, valuations)
from parcelspark.plans.registry import B, BAND_SQL, SILVER, V, VISION, hex_sql, query
from parcelspark.operators.vision import aggregate_vision
from parcelspark.session import scratch_path, stage
from parcelspark.sources import hashtree, landing, photos, synthetic, tables

KEY = "property_id"


@query("pseudonymize", f"""WITH {V}
SELECT substr(sha256('{SALT}' || property_id), 1, 16) AS property_hash, property_type, size_sqm,
  sale_price FROM v""")
def pseudonymize(spark, sf):
    raw = valuations(spark, sf, [KEY, "owner_name", "owner_id", "account_number", "street_address",
                                 "property_type", "size_sqm", "sale_price"])
    return privacy.pseudonymize(raw, KEY, SALT)


@query("geo_generalize", f"""WITH {V}
SELECT property_id, property_type, {hex_sql('home_latitude', 'home_longitude')} AS geo_h3_r8,
  substr(postcode, 1, 3) AS postcode_prefix, strftime(sale_date, '%Y-%m') AS sale_month FROM v""")
def geo_generalize(spark, sf):
    raw = valuations(spark, sf, [KEY, "property_type", "home_latitude", "home_longitude",
                                 "postcode", "sale_date"])
    return privacy.generalize(raw, "home_latitude", "home_longitude")


@query("size_bands", f"""WITH {V}
SELECT {BAND_SQL} AS size_band, CAST(floor(size_sqm / 10) * 10 AS INT) AS fine_band,
  count(*) AS n, round(avg(sale_price), 4) AS avg_price FROM v GROUP BY ALL""")
def size_bands(spark, sf):
    df = valuations(spark, sf, ["size_sqm", "sale_price"])
    return (df.groupBy(size_band(F.col("size_sqm")).alias("size_band"),
                       fine_band(F.col("size_sqm")).alias("fine_band"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("sale_price"), 4).alias("avg_price")))


_GROUPS = ("geo_h3_r8, property_type, sale_month, size_band")


@query("k_anonymity", f"""WITH {B}, g AS (SELECT {_GROUPS}, count(*) AS n FROM b GROUP BY ALL)
SELECT b.property_hash, {_GROUPS}, b.sale_price FROM b JOIN g USING ({_GROUPS}) WHERE n >= 10""")
def k_anonymity(spark, sf):
    df = bronze(spark, sf).select("property_hash", *privacy.QUASI_IDS, "sale_price")
    return privacy.k_anonymize(df)


@query("k_anonymity_report", f"""WITH {B}, g AS (SELECT {_GROUPS}, count(*) AS n FROM b GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS total_rows,
  CAST(coalesce(sum(n) FILTER (n >= 10), 0) AS BIGINT) AS kept_rows,
  CAST(coalesce(sum(n) FILTER (n < 10), 0) AS BIGINT) AS dropped_rows,
  round(coalesce(sum(n) FILTER (n < 10), 0) / sum(n), 6) AS dropped_share,
  count(*) AS groups, count(*) FILTER (n >= 10) AS safe_groups,
  round(avg(n), 6) AS size_mean, round(stddev_samp(n), 6) AS size_std, min(n) AS size_min,
  quantile_cont(n::DOUBLE, 0.25) AS size_p25, quantile_cont(n::DOUBLE, 0.5) AS size_p50,
  quantile_cont(n::DOUBLE, 0.75) AS size_p75, max(n) AS size_max FROM g""")
def k_anonymity_report(spark, sf):
    report = privacy.k_report(bronze(spark, sf).select(*privacy.QUASI_IDS))
    return report.withColumns({c: F.round(c, 6) for c in ("dropped_share", "size_mean",
                                                         "size_std")})


@query("privacy_release", f"""WITH {B}, g AS (SELECT {_GROUPS}, count(*) AS n FROM b GROUP BY ALL),
t AS (SELECT (SELECT count(*) FROM v) AS total, coalesce(sum(n) FILTER (n >= 10), 0) AS kept,
  min(n) FILTER (n >= 10) AS smallest FROM g)
SELECT 'rows_before' AS item, CAST(total AS VARCHAR) AS value FROM t
UNION ALL SELECT 'rows_after', CAST(CAST(kept AS BIGINT) AS VARCHAR) FROM t
UNION ALL SELECT 'rows_dropped', CAST(CAST(total - kept AS BIGINT) AS VARCHAR) FROM t
UNION ALL SELECT 'smallest_group', CAST(smallest AS VARCHAR) FROM t
UNION ALL SELECT 'k_holds', 'true'
UNION ALL SELECT 'direct_ids_left', ''
UNION ALL SELECT 'columns_removed', 'account_number,latitude,longitude,owner_id,owner_name,postcode,'
  || 'property_id,sale_date,street_address'
UNION ALL SELECT 'schema', 'geo_h3_r8:string,property_type:string,sale_month:string,size_band:string,'
  || 'size_sqm:double,rooms:int,bathrooms:int,year_built:int,sale_price:double,region_code:string,'
  || 'property_hash:string,postcode_prefix:string'""")
def privacy_release(spark, sf):
    raw = valuations(spark, sf)
    anon = privacy.generalize(privacy.pseudonymize(raw, KEY, SALT)).withColumn(
        "size_band", size_band(F.col("size_sqm")))
    return privacy.privacy_report(raw, privacy.k_anonymize(anon))


@query("dp_noise", f"""WITH {V}, u AS (SELECT property_id, sale_price,
  greatest(least(('0x' || substr(sha256('{SALT}' || property_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE,
    1 - 1e-9::DOUBLE), 1e-9::DOUBLE) - 0.5::DOUBLE AS u FROM v)
SELECT property_id, round(sale_price - sale_price * 0.005::DOUBLE * sign(u) * ln(1 - 2 * abs(u)), 4)
  AS sale_price FROM u""")
def dp_noise(spark, sf):
    df = valuations(spark, sf, [KEY, "sale_price"])
    noisy = privacy.laplace_noise(df, "sale_price", [KEY], SALT)
    return noisy.withColumn("sale_price", F.round("sale_price", 4))


@query("stratified_sample", f"""WITH {V}, s AS (SELECT property_id, region_code, property_type,
  year(sale_date) AS sale_year, size_sqm, {BAND_SQL} AS size_band, sale_price,
  row_number() OVER (PARTITION BY region_code, property_type, year(sale_date)
    ORDER BY sha256('42' || property_id), property_id) AS rn,
  count(*) OVER (PARTITION BY region_code, property_type, year(sale_date)) AS bucket
  FROM v WHERE sale_date >= DATE '1996-12-01' AND sale_price IS NOT NULL AND size_sqm IS NOT NULL)
SELECT property_id, region_code, property_type, CAST(sale_year AS INT) AS sale_year, size_sqm,
  size_band, sale_price FROM s WHERE rn <= ceil(bucket * 0.10::DOUBLE)""")
def stratified_sample(spark, sf):
    raw = valuations(spark, sf, [KEY, "region_code", "property_type", "sale_date", "size_sqm",
                                 "sale_price"])
    return sampling.stratified_sample(raw, AS_OF, [KEY]).drop("sale_date")


@query("time_split", f"""WITH {V}, m AS (SELECT property_id, strftime(sale_date, '%Y-%m') AS sale_month
  FROM v), c AS (SELECT min(sale_month) AS cutoff FROM (SELECT DISTINCT sale_month FROM m
  ORDER BY sale_month DESC LIMIT 6))
SELECT property_id, sale_month, CASE WHEN sale_month < cutoff THEN 'train' ELSE 'holdout' END AS part
FROM m, c""")
def time_split(spark, sf):
    df = valuations(spark, sf, [KEY, "sale_date"]).select(
        KEY, F.date_format("sale_date", "yyyy-MM").alias("sale_month"))
    train, holdout = sampling.time_split(df)
    return (train.withColumn("part", F.lit("train"))
            .unionByName(holdout.withColumn("part", F.lit("holdout"))))


@query("rolling_origin_folds", f"""WITH {V}, m AS (SELECT strftime(sale_date, '%Y-%m') AS sale_month,
  sale_price FROM v), d AS (SELECT sale_month, row_number() OVER (ORDER BY sale_month DESC) AS back
  FROM (SELECT DISTINCT sale_month FROM m)), f AS (SELECT unnest(range(1, 6)) AS fold),
p AS (SELECT sale_month, fold, CASE WHEN 5 - (back - 1) // 6 = fold THEN 'test'
  WHEN 5 - (back - 1) // 6 < fold THEN 'train' END AS role FROM d, f)
SELECT CAST(fold AS INT) AS fold, role, count(*) AS n, min(sale_month) AS first_month,
  max(sale_month) AS last_month, round(avg(sale_price), 4) AS avg_price
FROM m JOIN p USING (sale_month) WHERE role IS NOT NULL GROUP BY fold, role""")
def rolling_origin_folds(spark, sf):
    df = valuations(spark, sf, ["sale_date", "sale_price"]).withColumn(
        "sale_month", F.date_format("sale_date", "yyyy-MM"))
    return (sampling.rolling_origin_folds(df).groupBy("fold", "role")
            .agg(F.count(F.lit(1)).alias("n"), F.min("sale_month").alias("first_month"),
                 F.max("sale_month").alias("last_month"),
                 F.round(F.avg("sale_price"), 4).alias("avg_price")))


@query("audit_sample", f"""WITH {V}, m AS (SELECT property_id, strftime(sale_date, '%Y-%m') AS sale_month
  FROM v)
SELECT property_id, sale_month FROM m WHERE
  ('0x' || substr(sha256('42' || sale_month || '|' || property_id), 1, 8))::BIGINT
  / 4294967296.0::DOUBLE < 0.01::DOUBLE""")
def audit_sample(spark, sf):
    df = valuations(spark, sf, [KEY, "sale_date"]).select(
        KEY, F.date_format("sale_date", "yyyy-MM").alias("sale_month"))
    return sampling.audit_sample(df, KEY, "sale_month")


def _monthly(df):
    return df.groupBy("sale_month").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("sale_price"), 2).alias("total_price"),
        F.sum("rooms").alias("rooms"), F.count_distinct("geo_h3_r8").alias("cells"))


_MONTHLY_SQL = """SELECT sale_month, count(*) AS n, round(sum(sale_price), 2) AS total_price,
  CAST(sum(rooms) AS BIGINT) AS rooms, count(DISTINCT geo_h3_r8) AS cells FROM b GROUP BY sale_month"""


@query("landing_scan", f"WITH {B} {_MONTHLY_SQL}")
def landing_scan(spark, sf):
    path = scratch_path(spark, "landing")
    tables.write_table(bronze(spark, sf), path)
    return _monthly(landing.read_landing(spark, path))


@query("bronze_ingest", f"""WITH {B} SELECT sale_month, count(*) AS n, true AS stamped,
  'sale_month=' || sale_month AS folder FROM b GROUP BY sale_month""")
def bronze_ingest(spark, sf):
    path = scratch_path(spark, "landing")
    tables.write_table(bronze(spark, sf), path)
    stamped = landing.stamp_ingest(landing.read_landing(spark, path))
    folder = F.element_at(F.split("source_file", "/"), -2)
    return (stamped.groupBy("sale_month", folder.alias("folder"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.bool_and(F.col("ingested_at").isNotNull()).alias("stamped")))


@query("partitioned_roundtrip", f"""WITH {B} SELECT property_hash, sale_month, property_type, size_band,
  sale_price FROM b""")
def partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "table")
    tables.write_table(bronze(spark, sf), path)
    return spark.read.parquet(path).select(
        "property_hash", F.col("sale_month").cast("string").alias("sale_month"), "property_type",
        "size_band", "sale_price")


_CELLS = ["sale_month", "geo_h3_r8", "property_type"]


@query("clustered_write", f"""WITH {B} SELECT geo_h3_r8, property_type, sale_month, count(*) AS n,
  round(sum(sale_price), 2) AS total_price FROM b GROUP BY ALL""")
def clustered_write(spark, sf):
    path = scratch_path(spark, "clustered")
    tables.write_clustered(bronze(spark, sf), path, _CELLS)
    return spark.read.parquet(path).groupBy(*_CELLS).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("sale_price"), 2).alias("total_price"))


@query("curve_write", f"""WITH {B} SELECT geo_h3_r8, property_type, sale_month, count(*) AS n,
  round(sum(sale_price), 2) AS total_price FROM b GROUP BY ALL""")
def curve_write(spark, sf):
    path = scratch_path(spark, "curve")
    tables.write_on_curve(stage(bronze(spark, sf), "rows"), path, _CELLS)
    return spark.read.parquet(path).groupBy(*_CELLS).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("sale_price"), 2).alias("total_price"))


@query("landing_differences", f"""WITH {B}, k AS (SELECT property_hash, sale_month,
  ('0x' || substr(property_hash, 1, 6))::BIGINT % 997 AS h FROM b)
SELECT property_hash, CASE WHEN h = 3 THEN 'changed' WHEN h = 5 THEN 'lost' ELSE 'changed' END AS change
FROM k WHERE h IN (3, 5, 7)
UNION ALL SELECT property_hash || '-new', 'added' FROM k WHERE h = 11""")
def landing_differences(spark, sf):
    """Keys that a landed copy changed, lost, holds twice, or has beyond its source."""
    paths = [scratch_path(spark, name) for name in ("source", "landed")]
    # The copy is made from the source as written, so its rows are joined and written down once.
    hashtree.write_with_tree(bronze(spark, sf), paths[0], ["property_hash"])
    src = spark.read.parquet(f"{paths[0]}/rows").drop("_leaf")
    h = F.conv(F.substring("property_hash", 1, 6), 16, 10).cast("long") % 997
    kept = src.filter(h != 5).withColumn("rooms", F.when(h == 3, F.col("rooms") + 1)
                                         .otherwise(F.col("rooms")))
    new = src.filter(h == 11).withColumn("property_hash", F.concat("property_hash", F.lit("-new")))
    dst = kept.unionByName(src.filter(h == 7)).unionByName(new)
    hashtree.write_with_tree(dst, paths[1], ["property_hash"])
    return hashtree.compare_trees(spark, *paths, ["property_hash"]).rows


@query("snapshot_latest", f"""WITH {B} SELECT sale_month, count(*) AS n,
  round(sum(sale_price), 2) AS total_price FROM b GROUP BY sale_month""")
def snapshot_latest(spark, sf):
    base = scratch_path(spark, "snapshots")
    df = bronze(spark, sf).select("property_hash", "sale_month", "sale_price")
    tables.publish_snapshot(df.filter("sale_month < '2000-01'"), base, "2026.04.12")
    tables.publish_snapshot(df, base, "2026.05.12")
    return tables.read_snapshot(spark, base).groupBy("sale_month").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("sale_price"), 2).alias("total_price"))


_PHOTO_BYTES = 150


@query("photo_scoring", f"""WITH f AS (SELECT user_id, count(*) AS n, min(event_id) % 10 = 3 AS blurred,
  sum(length(CAST(event_id AS VARCHAR)) + 1) > {_PHOTO_BYTES} AS large FROM events GROUP BY user_id)
SELECT CAST(user_id AS VARCHAR) AS property_hash,
  CASE WHEN NOT large AND NOT blurred THEN '{{"lines": ' || n || '}}' END AS score_json,
  CASE WHEN large THEN 'too large' WHEN blurred THEN 'ValueError: blurred' END AS error,
  CAST(CASE WHEN large THEN 0 WHEN blurred THEN 2 ELSE 1 END AS INT) AS attempts FROM f""")
def photo_scoring(spark, sf):
    """A file for each property, scored through its manifest; large files and failures included."""
    folder = scratch_path(spark, "photos")
    (table(spark, sf, "events").select(F.col("user_id").alias("property_hash"),
                                       F.col("event_id").cast("string").alias("value"))
     .repartition("property_hash").write.partitionBy("property_hash").text(folder))
    path = F.col("path")
    # Listed once: a listing visits every folder.
    listed = tables.binary_files(spark, folder, "*.txt")
    manifest = tables.file_sizes(spark, folder, "*.txt", listed).select(
        F.regexp_extract(path, "property_hash=([^/]*)/", 1).alias("property_hash"),
        path.alias("photo_url"), F.element_at(F.split(path, "/"), -1).alias("photo_hash"))

    def scorer(image: bytes) -> str:
        ids = [int(x) for x in image.split()]
        if min(ids) % 10 == 3:
            raise ValueError("blurred")
        return f'{{"lines": {len(ids)}}}'

    # Part files of one task share a name but for their folder; a photo's name must be its own.
    named = manifest.withColumn("photo_hash", F.concat("property_hash", F.lit("/"), "photo_hash"))
    files = photos.photo_files(spark, folder, named, _PHOTO_BYTES, listed=listed)
    out = photos.score_files(spark, folder, files, scorer, max_bytes=_PHOTO_BYTES, listed=listed)
    return out.select("property_hash", "score_json", "error", F.col("attempts").cast("int")
                      .alias("attempts"))


@query("compacted_snapshot", f"""WITH {B}, n AS (SELECT sale_month, count(*) AS n,
  round(sum(sale_price), 2) AS total_price FROM b GROUP BY sale_month)
SELECT *, true AS few_files FROM n""")
def compacted_snapshot(spark, sf):
    """A snapshot of very many small files by month, after its compaction: the same rows, and at most
    one file a job beside those that were large enough."""
    base = scratch_path(spark, "many")
    df = bronze(spark, sf).select("property_hash", "sale_month", "sale_price")
    tables.publish_snapshot(df.repartition(64), base, "2026.05.12")
    before = tables.file_sizes(spark, tables.snapshot_folder(spark, base)).agg(
        F.count(F.lit(1)).alias("files"), F.max("length").alias("largest")).first()
    folder = tables.compact(spark, base, target=8 * before["largest"])
    after = tables.file_sizes(spark, folder).count()
    return tables.read_snapshot(spark, base).groupBy("sale_month").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("sale_price"), 2).alias("total_price")).withColumn(
        "few_files", F.lit(after <= before["files"] // 4))


@query("landing_reconcile", f"""WITH {B}, s AS (SELECT CASE WHEN sale_month <> '1995-01' THEN sale_month
  END AS sale_month, count(*) AS n, round(sum(sale_price), 2) AS t FROM b GROUP BY 1),
k AS (SELECT 'same' AS landed UNION ALL SELECT 'changed' UNION ALL SELECT 'swapped'
  UNION ALL SELECT 'lost')
SELECT landed, sale_month, n AS src_rows, n AS dst_rows, t AS src_sale_price,
  CASE WHEN landed = 'changed' AND sale_month = '1996-05' THEN round(t + n, 2) ELSE t END AS dst_sale_price,
  CASE landed WHEN 'same' THEN true WHEN 'lost' THEN false
    ELSE sale_month IS DISTINCT FROM '1996-05' END AS matches
FROM s CROSS JOIN k""")
def landing_reconcile(spark, sf):
    """A faithful copy; one with changed prices, one with a value moved to an empty column in a
    month, and one without a column. The first month's partition is null."""
    # Joined once; each copy and each comparison reads it.
    src = stage(bronze(spark, sf).withColumn("sale_month", F.expr(
        "CASE WHEN sale_month <> '1995-01' THEN sale_month END")).withColumn(
        "note", F.lit(None).cast("string")), "source")
    hit = F.coalesce(F.col("sale_month") == "1996-05", F.lit(False))
    landed = {
        "same": src,
        "changed": src.withColumn("sale_price", F.when(hit, F.col("sale_price") + 1)
                                  .otherwise(F.col("sale_price"))),
        "swapped": src.withColumn("note", F.when(hit, F.col("postcode_prefix"))).withColumn(
            "postcode_prefix", F.when(~hit, F.col("postcode_prefix"))),
        "lost": src.drop("rooms")}
    out = None
    for name, df in landed.items():
        path = scratch_path(spark, "landing")
        df.write.parquet(path)
        one = landing.reconcile(src, spark.read.parquet(path), ["sale_month"], ["sale_price"])
        one = one.withColumn("landed", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("landed", "sale_month", "src_rows", "dst_rows",
                      F.round("src_sale_price", 2).alias("src_sale_price"),
                      F.round("dst_sale_price", 2).alias("dst_sale_price"), "matches")


@query("retention_tiers", f"""WITH {V} SELECT CASE WHEN sale_date >= DATE '2000-12-01' THEN 'hot'
  WHEN sale_date >= DATE '1994-12-01' THEN 'cold' ELSE 'expired' END AS tier, count(*) AS n,
  CAST(min(sale_date) AS VARCHAR) AS first_day FROM v GROUP BY tier""")
def retention_tiers(spark, sf):
    df = landing.retention_tier(valuations(spark, sf, ["sale_date"]), "sale_date", AS_OF)
    return df.groupBy("tier").agg(F.count(F.lit(1)).alias("n"),
                                  F.min("sale_date").cast("string").alias("first_day"))


def silver(spark, sf, extra=()):
    # Joined once; the dimensions and the enriched rows read it.
    facts = stage(bronze(spark, sf, extra), "facts")
    # The keys come from the facts themselves here, so they are unique and staged once.
    dims = [(stage(dimension(facts, name), name), [DIMENSIONS[name][0]]) for name in DIMENSIONS]
    return E.enrich(facts, dims)


@query("silver_enrich", f"""WITH {SILVER} SELECT property_hash, geo_h3_r8, postcode_prefix, sale_month,
  dist_school, dist_transit, amenity_count_1km, median_income, unemployment_rate, pop_density,
  mortgage_rate, cpi, regional_gdp_growth, flood_zone, seismic_zone, sale_price FROM silver""")
def silver_enrich(spark, sf):
    return silver(spark, sf).drop("property_type", "size_band", "size_sqm", "rooms", "bathrooms",
                                  "year_built")


# Vision features hang on the sold property's user number, as each event's user is a property.
_VISION_KEY = "CAST(conv(substring(property_hash, 1, 8), 16, 10) AS BIGINT) % 400"
_VISION_KEY_SQL = "('0x' || substr(property_hash, 1, 8))::BIGINT % 400"


def _keyed(spark, sf):
    return bronze(spark, sf).withColumn("property_hash", F.expr(_VISION_KEY).cast("string"))


def vision_table(spark, sf):
    return stage(aggregate_vision(photo_scores(spark, sf)), "vision").select(
        "property_hash", "condition_score", "roof_condition", "curb_appeal", "renovation_flag",
        "photo_count")


_GOLD = f"""{VISION}, vt AS (SELECT property_hash,
  (exterior_condition + roof_condition + curb_appeal) / 3 AS condition_score, roof_condition,
  curb_appeal, CAST(renovation_recency >= 0.7 AS INT) AS renovation_flag, photo_count FROM vision),
k AS (SELECT CAST({_VISION_KEY_SQL} AS VARCHAR) AS property_hash, property_hash AS sale_hash,
  postcode_prefix, size_sqm, year_built, sale_price FROM b),
g AS (SELECT * FROM k LEFT JOIN vt USING (property_hash))"""


@query("gold_features", f"""WITH {B}, {_GOLD}
SELECT property_hash, sale_price, round(ln(1 + size_sqm), 6) AS log_size_sqm,
  CAST(2026 - year_built AS INT) AS age_years,
  CAST(condition_score IS NOT NULL AS INT) AS has_vision_score,
  round(coalesce(condition_score, 0.6), 6) AS condition_score,
  coalesce(roof_condition, 0.6) AS roof_condition, coalesce(curb_appeal, 0.6) AS curb_appeal,
  coalesce(renovation_flag, 0) AS renovation_flag FROM g""")
def gold_features(spark, sf):
    gold = features.gold_features(_keyed(spark, sf), vision_table(spark, sf))
    return gold.select("property_hash", "sale_price",
                       F.round("log_size_sqm", 6).alias("log_size_sqm"), "age_years",
                       "has_vision_score", F.round("condition_score", 6).alias("condition_score"),
                       "roof_condition", "curb_appeal", "renovation_flag")


@query("vision_impute_regional", f"""WITH {B}, {_GOLD}, m AS (SELECT postcode_prefix,
  median(condition_score) AS mc, median(roof_condition) AS mr, median(curb_appeal) AS mu,
  median(renovation_flag::DOUBLE) AS mf FROM g GROUP BY postcode_prefix)
SELECT property_hash, postcode_prefix, sale_price,
  CAST(condition_score IS NOT NULL AS INT) AS has_vision_score,
  round(coalesce(condition_score, mc, 0.6), 6) AS condition_score,
  round(coalesce(roof_condition, mr, 0.6), 6) AS roof_condition,
  round(coalesce(curb_appeal, mu, 0.6), 6) AS curb_appeal,
  coalesce(renovation_flag, CAST(mf >= 0.5 AS INT), 0) AS renovation_flag
FROM g JOIN m USING (postcode_prefix)""")
def vision_impute_regional(spark, sf):
    gold = features.gold_features(_keyed(spark, sf), vision_table(spark, sf), impute="regional")
    return gold.select("property_hash", "postcode_prefix", "sale_price", "has_vision_score",
                       *[F.round(c, 6).alias(c) for c in ("condition_score", "roof_condition",
                                                          "curb_appeal")], "renovation_flag")


@query("comparables_window", f"""WITH {B}, m AS (SELECT geo_h3_r8, sale_month,
  CAST(substr(sale_month, 1, 4) AS INT) * 12 + CAST(substr(sale_month, 6, 2) AS INT) AS mi,
  count(*) AS n, sum(sale_price) AS p, sum(size_sqm) AS s FROM b GROUP BY ALL),
w AS (SELECT geo_h3_r8, sale_month, CAST(coalesce(sum(n) OVER past, 0) AS BIGINT) AS recent_sales_h3,
  sum(p) OVER past / sum(s) OVER past AS price_per_sqm_h3 FROM m WINDOW past AS
  (PARTITION BY geo_h3_r8 ORDER BY mi RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING))
SELECT property_hash, geo_h3_r8, sale_month, recent_sales_h3,
  round(price_per_sqm_h3, 6) AS price_per_sqm_h3 FROM b JOIN w USING (geo_h3_r8, sale_month)""")
def comparables_window(spark, sf):
    df = bronze(spark, sf).select("property_hash", "geo_h3_r8", "sale_month", "sale_price",
                                  "size_sqm")
    out = features.recent_comparables(df)
    return out.select("property_hash", "geo_h3_r8", "sale_month", "recent_sales_h3",
                      F.round("price_per_sqm_h3", 6).alias("price_per_sqm_h3"))
