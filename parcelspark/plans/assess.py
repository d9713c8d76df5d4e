"""Queries: photo scores, comparables, evaluation, gates, scoring and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelspark.functions.scalars import half_even
from parcelspark.operators import evaluate, monitor, profiles, similar, vision
from parcelspark.operators.scoring import batch_score, conformal_bands
from parcelspark.plans.fixtures import (CACHE_UNTIL, bronze, feedback, photo_json, photo_scores,
                                        request_log, table, valuations)
from parcelspark.plans.registry import B, LOG, PHOTOS, V, VISION, query
from parcelspark.session import stage
from parcelspark.sources import synthetic

EPS_SQL = "2.220446049250313e-16::DOUBLE"


@query("synthetic_market", """WITH d AS (SELECT property_id, sha256('42a' || property_id) AS a,
  sha256('42b' || property_id) AS b FROM (SELECT concat_ws('-', CAST(l_orderkey AS STRING),
  CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS property_id
  FROM lineitem)),
u AS (SELECT property_id, list_transform(range(0, 8), lambda i:
    ('0x' || substr(a, 1 + 8 * i::INT, 8))::BIGINT / 4294967296.0::DOUBLE) AS a,
  list_transform(range(0, 8), lambda i:
    ('0x' || substr(b, 1 + 8 * i::INT, 8))::BIGINT / 4294967296.0::DOUBLE) AS b FROM d),
n AS (SELECT property_id, a, b,
  sqrt(-2 * ln(greatest(a[5], 1e-12::DOUBLE))) * cos(6.283185307179586::DOUBLE * a[6]) AS n_size,
  sqrt(-2 * ln(greatest(a[7], 1e-12::DOUBLE))) * cos(6.283185307179586::DOUBLE * a[8]) AS n_rooms,
  sqrt(-2 * ln(greatest(b[1], 1e-12::DOUBLE))) * cos(6.283185307179586::DOUBLE * b[2]) AS n_bath,
  sqrt(-2 * ln(greatest(b[3], 1e-12::DOUBLE))) * cos(6.283185307179586::DOUBLE * b[4]) AS n_price
  FROM u),
s AS (SELECT *, 1 + floor(a[1] * 6)::INT AS region, 1 + floor(a[2] * 4)::INT AS kind,
  1900 + floor(a[3] * 124)::INT AS year_built,
  DATE '2021-01-01' + to_months(floor(a[4] * 64)::INT) AS day,
  round_even(least(greatest(75.0::DOUBLE + n_size * 35, 18), 350), 0) AS size_sqm FROM n),
r AS (SELECT *, least(greatest(round_even(size_sqm / 22 + n_rooms * 0.7::DOUBLE, 0), 1), 8)::INT
  AS rooms FROM s)
SELECT substr(sha256('poc-' || property_id), 1, 16) AS property_hash,
  ['750', '130', '690', '330', '440', '310'][region] AS postcode_prefix,
  ['apartment', 'house', 'studio', 'duplex'][kind] AS property_type,
  strftime(day, '%Y-%m') AS sale_month, size_sqm, rooms,
  least(greatest(round_even(rooms / 2.5::DOUBLE + n_bath * 0.4::DOUBLE, 0), 1), 4)::INT AS bathrooms,
  year_built, round_even(least(greatest([11000, 4500, 5500, 4800, 4200, 3900][region] * size_sqm
    * [1.0, 1.15, 0.85, 1.25][kind]::DOUBLE * pow(1.06::DOUBLE, year(day) - 2021)
    * least(greatest(1.0::DOUBLE - (2026 - year_built) * 0.002::DOUBLE, 0.5), 1.0)
    * (1.0::DOUBLE + n_price * 0.18::DOUBLE), 25000), 5000000) / 100, 0) * 100 AS sale_price
FROM r""")
def synthetic_market(spark, sf):
    ids = valuations(spark, sf, ["property_id"])
    return synthetic.valuations_for(ids, "property_id").drop("geo_h3_r8", "size_band")


@query("rubric_parse", f"""WITH {PHOTOS}
SELECT property_hash, photo_hash, exterior_condition, roof_condition, curb_appeal,
  renovation_recency, confidence, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS defects FROM photos""")
def rubric_parse(spark, sf):
    return (vision.parse_scores(photo_json(spark, sf))
            .withColumn("defects", F.size("visible_defects")).drop("visible_defects"))


@query("vision_aggregate", f"""WITH {VISION}
SELECT property_hash, round(exterior_condition, 6) AS exterior_condition,
  round(roof_condition, 6) AS roof_condition, round(curb_appeal, 6) AS curb_appeal,
  round(renovation_recency, 6) AS renovation_recency,
  CAST(renovation_recency >= 0.7 AS INT) AS renovation_flag,
  round((exterior_condition + roof_condition + curb_appeal) / 3, 6) AS condition_score, photo_count
FROM vision""")
def vision_aggregate(spark, sf):
    out = vision.aggregate_vision(photo_scores(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in (
        "exterior_condition", "roof_condition", "curb_appeal", "renovation_recency",
        "condition_score")})


@query("vision_min_photos", f"""WITH {VISION}
SELECT property_hash, CASE WHEN photo_count >= 40 THEN round(roof_condition, 6) END AS roof_condition,
  CASE WHEN photo_count >= 40 THEN CAST(renovation_recency >= 0.7 AS INT) END AS renovation_flag,
  photo_count FROM vision""")
def vision_min_photos(spark, sf):
    out = vision.aggregate_vision(photo_scores(spark, sf), min_photos=40)
    return out.select("property_hash", F.round("roof_condition", 6).alias("roof_condition"),
                      "renovation_flag", "photo_count")


@query("rescore_candidates", f"""WITH p AS (SELECT CAST(user_id AS STRING) AS property_hash,
  CAST(event_id // 3 AS STRING) AS photo_hash, ts FROM events)
SELECT DISTINCT property_hash, photo_hash FROM p m WHERE NOT EXISTS (SELECT 1 FROM p c
  WHERE c.ts < TIMESTAMP '{CACHE_UNTIL}' AND c.property_hash = m.property_hash
  AND c.photo_hash = m.photo_hash)""")
def rescore_candidates(spark, sf):
    photos = table(spark, sf, "events").selectExpr(
        "CAST(user_id AS STRING) AS property_hash", "CAST(event_id DIV 3 AS STRING) AS photo_hash",
        "ts")
    cache = photos.filter(F.col("ts") < F.lit(CACHE_UNTIL).cast("timestamp_ntz"))
    return vision.rescore_candidates(photos.drop("ts"), cache)


_SCORES = ["exterior_condition", "roof_condition", "curb_appeal"]


@query("score_cache_upsert", """WITH s AS (SELECT CAST(user_id AS STRING) AS property_hash,
  CAST(event_id % 1000 AS STRING) AS photo_hash, ts, event_id,
  CAST(event_id * 13 % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS exterior_condition FROM events)
SELECT property_hash, photo_hash, max(event_id) AS event_id, arg_max(exterior_condition, ts)
  AS exterior_condition, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_scored_at
FROM s GROUP BY property_hash, photo_hash""")
def score_cache_upsert(spark, sf):
    scores = table(spark, sf, "events").selectExpr(
        "CAST(user_id AS STRING) AS property_hash",
        "CAST(event_id % 1000 AS STRING) AS photo_hash",
        "event_id", "ts AS last_scored_at",
        "CAST(event_id * 13 % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS exterior_condition")
    old = F.col("last_scored_at") < F.lit(CACHE_UNTIL).cast("timestamp_ntz")
    merged = vision.upsert_scores(scores.filter(old), scores.filter(~old))
    return merged.withColumn("last_scored_at",
                             F.date_format("last_scored_at", "yyyy-MM-dd HH:mm:ss"))


_AUDIT_SQL = f"""{PHOTOS}, a AS (SELECT roof_condition AS rubric, confidence,
  least(greatest(roof_condition + CAST(event_id % 41 - 20 AS DOUBLE) / CAST(100 AS DOUBLE), 0), 1)
    AS human, CAST(renovation_recency >= 0.7 AS INT) AS rubric_flag,
  CAST(renovation_recency + CAST(event_id % 31 - 15 AS DOUBLE) / CAST(100 AS DOUBLE) >= 0.7 AS INT)
    AS human_flag FROM photos)"""


@query("vision_audit", f"""WITH {_AUDIT_SQL}
SELECT 'correlation' AS metric, CAST(NULL AS INT) AS bin, round(corr(rubric, human), 6) AS value,
  count(*) AS n FROM a
UNION ALL SELECT 'freeze', NULL, CAST(corr(rubric, human) < 0.7 AS INT)::DOUBLE, count(*) FROM a
UNION ALL SELECT 'false_renovation_rate', NULL, round(avg(1.0 - human_flag), 6), count(*) FROM a
  WHERE rubric_flag = 1
UNION ALL SELECT 'within_tenth', CAST(least(floor(confidence * 10), 9) AS INT),
  round(avg(CAST(abs(rubric - human) <= 0.1::DOUBLE + 1e-9::DOUBLE AS INT)), 6), count(*) FROM a
  GROUP BY 2""")
def vision_audit(spark, sf):
    scores = photo_scores(spark, sf, "event_id")
    offset = (F.col("event_id") % 41 - 20).cast("double") / 100
    flip = (F.col("event_id") % 31 - 15).cast("double") / 100
    audit = scores.select(
        F.col("roof_condition").alias("rubric"), "confidence",
        F.least(F.greatest(F.col("roof_condition") + offset, F.lit(0.0)), F.lit(1.0))
        .alias("human"), (F.col("renovation_recency") >= 0.7).cast("int").alias("rubric_flag"),
        (F.col("renovation_recency") + flip >= 0.7).cast("int").alias("human_flag"))
    out = vision.vision_audit(audit, "rubric", "human", "rubric_flag", "human_flag")
    return out.withColumn("value", F.round("value", 6))


@query("visual_comparables", """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v,
  CAST(100000 + vec_id * 7919 % 900001 AS DOUBLE) AS price FROM embeddings),
s AS (SELECT a.label, a.vec_id, b.price, row_number() OVER (PARTITION BY a.vec_id ORDER BY
  round(list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)),
  9) DESC, b.vec_id) AS rn FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT label, vec_id, count(*) AS comp_count, median(price) AS comp_median_price,
  round(stddev_samp(price), 4) AS comp_price_std FROM s WHERE rn <= 10 GROUP BY label, vec_id""")
def visual_comparables(spark, sf):
    emb = table(spark, sf, "embeddings")
    prices = emb.selectExpr("vec_id",
                            "CAST(100000 + vec_id * 7919 % 900001 AS DOUBLE) AS sale_price")
    out = similar.visual_comparables(emb, prices, "label", "vec_id", "embedding")
    return out.withColumn("comp_price_std", F.round("comp_price_std", 4))


# ---- evaluation -------------------------------------------------------------------------------

def _scored(spark, sf, model="challenger"):
    extra = ["champion_pred", "challenger_pred"]
    df = bronze(spark, sf, extra)
    return df.withColumn("pred", F.col(f"{model}_pred")).drop(*extra)


def _by_model(spark, sf):
    df = bronze(spark, sf, ["champion_pred", "challenger_pred"])
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"{m}_pred").alias("pred"))
                       for m in ("champion", "challenger")])
    return df.select("property_type", "postcode_prefix", "year_built", "sale_price",
                     F.inline(models))


_MAPE = f"avg(abs(sale_price - pred) / greatest(abs(sale_price), {EPS_SQL}))"
_S = B + ", s AS (SELECT *, challenger_pred AS pred FROM b)"
_M = (B + ", m AS (SELECT *, 'champion' AS model, champion_pred AS pred FROM b UNION ALL"
          " SELECT *, 'challenger', challenger_pred FROM b)")


@query("eval_global", f"""WITH {_S} SELECT count(*) AS n, round({_MAPE}, 6) AS mape,
  round(1 - sum((sale_price - pred) * (sale_price - pred)) / (var_pop(sale_price) * count(*)), 6) AS r2,
  round(avg(pred) / avg(sale_price), 6) AS calibration_ratio FROM s""")
def eval_global(spark, sf):
    out = evaluate.global_metrics(_scored(spark, sf))
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("mape", "r2", "calibration_ratio")])


@query("slice_mape", f"""WITH {_S}, x AS (SELECT 'property_type' AS slice_kind,
  property_type AS slice_value, sale_price, pred FROM s UNION ALL
  SELECT 'postcode_prefix', postcode_prefix, sale_price, pred FROM s)
SELECT slice_kind, slice_value, count(*) AS n, round({_MAPE}, 6) AS mape FROM x GROUP BY ALL
HAVING count(*) >= 30""")
def slice_mape(spark, sf):
    out = evaluate.slice_mape(_scored(spark, sf), ["property_type", "postcode_prefix"])
    return out.withColumn("mape", F.round("mape", 6))


@query("eval_slices_full", f"""WITH {_S}, e AS (SELECT quantile_cont(sale_price,
  [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM s),
d AS (SELECT s.*, 1 + len(list_filter(edges, lambda q: q < sale_price)) AS decile FROM s, e),
x AS (SELECT 'property_type' AS slice_kind, property_type AS slice_value, sale_price, pred FROM d
UNION ALL SELECT 'postcode_prefix', postcode_prefix, sale_price, pred FROM d
UNION ALL SELECT 'price_decile', CAST(decile AS VARCHAR), sale_price, pred FROM d
UNION ALL SELECT 'vintage_decade', CAST(CAST(year_built // 10 * 10 AS INT) AS VARCHAR), sale_price,
  pred FROM d
UNION ALL SELECT 'vision', CASE WHEN rooms % 3 = 0 THEN 'available' ELSE 'missing' END, sale_price,
  pred FROM d)
SELECT slice_kind, slice_value, count(*) AS n, round({_MAPE}, 6) AS mape FROM x GROUP BY ALL
HAVING count(*) >= 30""")
def eval_slices_full(spark, sf):
    scored = _scored(spark, sf).withColumn("has_vision_score",
                                           (F.col("rooms") % 3 == 0).cast("int"))
    scored = stage(scored.drop("property_hash", "geo_h3_r8", "sale_month", "size_band"), "scored")
    sliced, slices = evaluate.with_error_slices(scored)
    return evaluate.slice_mape(sliced, slices).withColumn("mape", F.round("mape", 6))


_REPORT = f"""{_M}, g AS (SELECT model, {_MAPE} AS mape, 1 - sum((sale_price - pred) *
  (sale_price - pred)) / (var_pop(sale_price) * count(*)) AS r2,
  avg(pred) / avg(sale_price) AS cal FROM m GROUP BY model),
rep AS (SELECT model, 'global' AS slice_kind, 'all' AS slice_value, 'mape' AS metric, mape AS value FROM g
UNION ALL SELECT model, 'global', 'all', 'r2', r2 FROM g
UNION ALL SELECT model, 'global', 'all', 'calibration_ratio', cal FROM g
UNION ALL SELECT model, 'property_type', property_type, 'mape', {_MAPE} FROM m
  GROUP BY model, property_type HAVING count(*) >= 30
UNION ALL SELECT model, 'postcode_prefix', postcode_prefix, 'mape', {_MAPE} FROM m
  GROUP BY model, postcode_prefix HAVING count(*) >= 30)"""


@query("eval_report", f"""WITH {_REPORT} SELECT model, slice_kind, slice_value, metric,
  round(value, 6) AS value FROM rep""")
def eval_report(spark, sf):
    return evaluate.eval_report(_by_model(spark, sf)).withColumn("value", F.round("value", 6))


_GATES = f"""WITH {_REPORT}, {LOG}, lat AS (SELECT
  quantile_cont(latency_ms, 0.95) FILTER (served_by = 'blue') AS champion,
  quantile_cont(latency_ms, 0.95) FILTER (served_by = 'green') AS challenger FROM log),
w AS (SELECT slice_kind, slice_value, metric, max(value) FILTER (model = 'champion') AS champion,
  max(value) FILTER (model = 'challenger') AS challenger FROM rep GROUP BY ALL),
gates AS (SELECT 'global_improvement' AS gate, slice_kind, slice_value, champion, challenger,
  (champion - challenger) / greatest(champion, 1e-9::DOUBLE) AS figure, 0.02 AS threshold,
  (champion - challenger) / greatest(champion, 1e-9::DOUBLE) >= 0.02 AS passed
  FROM w WHERE slice_kind = 'global' AND metric = 'mape'
UNION ALL SELECT 'slice_regression', slice_kind, slice_value, champion, challenger,
  (challenger - champion) / greatest(champion, 1e-9::DOUBLE), 0.05,
  (challenger - champion) / greatest(champion, 1e-9::DOUBLE) <= 0.05
  FROM w WHERE slice_kind <> 'global' AND champion IS NOT NULL AND challenger IS NOT NULL
UNION ALL SELECT 'calibration', slice_kind, slice_value, champion, challenger, challenger, 1.03,
  challenger BETWEEN 0.97 AND 1.03 FROM w WHERE metric = 'calibration_ratio'
UNION ALL SELECT 'latency_p95', 'global', 'all', champion, challenger, challenger - champion, 50,
  challenger - champion <= 50 FROM lat)"""


def _gates(spark, sf):
    log = request_log(spark, sf)
    latency = monitor.ab_latency(log).select(
        F.when(F.col("served_by") == "blue", "champion").otherwise("challenger").alias("model"),
        "p95")
    return evaluate.promotion_gates(evaluate.eval_report(_by_model(spark, sf)), latency)


@query("promotion_gates", f"""{_GATES} SELECT gate, slice_kind, slice_value,
  round(champion, 6) AS champion, round(challenger, 6) AS challenger, round(figure, 6) AS figure,
  threshold::DOUBLE AS threshold, passed FROM gates""")
def promotion_gates(spark, sf):
    return _gates(spark, sf).withColumns({c: F.round(c, 6) for c in ("champion", "challenger",
                                                                     "figure")})


@query("promotion_decision", f"""{_GATES} SELECT bool_and(passed) AS promote,
  count(*) FILTER (NOT passed) AS failed, count(*) AS checks FROM gates""")
def promotion_decision(spark, sf):
    return evaluate.promote(_gates(spark, sf))


@query("batch_score", f"""WITH {V}, p AS (SELECT property_id, exp(ln(1 + challenger_pred)) - 1 AS p FROM v)
SELECT property_id, round_even(round(p, 6) / 100, 0) * 100 AS price,
  round_even(round(p, 6) * 0.92::DOUBLE / 100, 0) * 100 AS price_low_q10,
  round_even(round(p, 6) * 1.08::DOUBLE / 100, 0) * 100 AS price_high_q90,
  'EUR' AS currency, 0.6::DOUBLE AS condition_score, '2.3.1' AS model_version FROM p""")
def batch_score_query(spark, sf):
    df = valuations(spark, sf, ["property_id", "challenger_pred"])
    predicted = df.select("property_id", F.log1p("challenger_pred").alias("prediction"))
    return batch_score(predicted, version="2.3.1", keep=["property_id"], digits=6)


@query("batch_score_coarse", f"""WITH {V} SELECT property_id,
  round_even(challenger_pred / 500, 0) * 500 AS price FROM v""")
def batch_score_coarse(spark, sf):
    df = valuations(spark, sf, ["property_id", "challenger_pred"])
    predicted = df.withColumnRenamed("challenger_pred", "prediction")
    return batch_score(predicted, target_transform="none", round_to=500,
                       keep=["property_id"]).select("property_id", "price")


@query("conformal_bands", f"""WITH {B}, r AS (SELECT *, champion_pred AS pred,
  sale_price / champion_pred AS ratio, sale_month < '2000-01' AS calib FROM b),
q AS (SELECT region_code, quantile_cont(ratio, 0.1) AS lo, quantile_cont(ratio, 0.9) AS hi FROM r
  WHERE calib GROUP BY region_code HAVING count(*) >= 30)
SELECT region_code, count(*) AS n, round(avg(pred * lo), 4) AS price_low_q10,
  round(avg(pred * hi), 4) AS price_high_q90 FROM r JOIN q USING (region_code) WHERE NOT calib
GROUP BY region_code""")
def conformal_bands_query(spark, sf):
    df = bronze(spark, sf, ["champion_pred", "region_code"]).withColumnRenamed("champion_pred",
                                                                               "pred")
    df = stage(df.select("property_hash", "region_code", "sale_month", "pred", "sale_price"), "scored")
    calib = df.filter("sale_month < '2000-01'")
    out = conformal_bands(calib, df.filter("sale_month >= '2000-01'"), "region_code")
    return out.groupBy("region_code").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("price_low_q10"), 4).alias("price_low_q10"),
        F.round(F.avg("price_high_q90"), 4).alias("price_high_q90"))


# ---- monitoring -------------------------------------------------------------------------------

_JOINED = """p AS (SELECT user_id AS property_hash, ts AS pred_ts, value AS price FROM events
  WHERE event_type = 'view'), a AS (SELECT event_id AS sale_id, user_id AS property_hash,
  ts AS sale_ts, value AS sale_price FROM events WHERE event_type = 'purchase'),
j AS (SELECT a.sale_id, a.property_hash, a.sale_ts, a.sale_price, p.pred_ts, p.price
  FROM a ASOF LEFT JOIN p ON a.property_hash = p.property_hash AND a.sale_ts >= p.pred_ts)"""


def _joined(spark, sf):
    preds, actuals = feedback(spark, sf)
    return monitor.join_actuals(preds, actuals, "property_hash", "pred_ts", "sale_ts", ["price"])


@query("feedback_asof", f"""WITH {_JOINED} SELECT sale_id, property_hash, sale_price, price,
  strftime(pred_ts, '%Y-%m-%d %H:%M:%S') AS pred_ts FROM j""")
def feedback_asof(spark, sf):
    return _joined(spark, sf).select(
        "sale_id", "property_hash", "sale_price", "price",
        F.date_format("pred_ts", "yyyy-MM-dd HH:mm:ss").alias("pred_ts"))


@query("quality_monitor", f"""WITH {_JOINED} SELECT strftime(date_trunc('week', sale_ts), '%Y-%m-%d')
  AS week, count(*) AS n, round(avg(abs(sale_price - price) / greatest(abs(sale_price), {EPS_SQL})), 4)
  AS mape, avg(abs(sale_price - price) / greatest(abs(sale_price), {EPS_SQL})) > 9.0 + 0.05 AS alert
FROM j WHERE price IS NOT NULL GROUP BY 1""")
def quality_monitor(spark, sf):
    out = monitor.quality_monitor(_joined(spark, sf), 9.0, "sale_ts")
    return out.select(F.col("week").cast("string").alias("week"), "n",
                      F.round("mape", 4).alias("mape"), "alert")


@query("ab_latency", f"""WITH {LOG} SELECT served_by, count(*) AS requests,
  round(avg(is_error), 6) AS error_rate, round(quantile_cont(latency_ms, 0.5), 6) AS p50,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99
FROM log GROUP BY served_by""")
def ab_latency(spark, sf):
    out = monitor.ab_latency(request_log(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("error_rate", "p50", "p95", "p99")})


@query("latency_profiles", f"""WITH {LOG} SELECT served_by, strftime(date_trunc('week', ts), '%Y-%m-%d')
  AS week, count(*) AS requests, CAST(sum(is_error) AS BIGINT) AS errors,
  round(quantile_cont(latency_ms, 0.95), 6) AS exact_p95, true AS close
FROM log GROUP BY ALL""")
def latency_profiles(spark, sf):
    """Weekly profiles rolled up from stored minutes and hours, beside the exact percentile; ``close``
    tells whether the exact p50, p95 and p99 lie within three points of rank in the sketch."""
    log = stage(request_log(spark, sf), "log")
    minutes = stage(profiles.profile(log), "minutes")
    hours = stage(profiles.roll_up(minutes, "hour"), "hours")
    weeks = profiles.roll_up(hours, "week")
    qs = [0.5, 0.95, 0.99]
    exact = log.groupBy("served_by", F.date_trunc("week", "ts").alias("slot")).agg(
        F.percentile("latency_ms", qs).alias("p"))
    close = F.lit(True)
    for i, q in enumerate(qs):
        close = close & F.col("p")[i].between(profiles.quantile(q - 0.03),
                                              profiles.quantile(min(q + 0.03, 1.0)))
    return weeks.join(exact, ["served_by", "slot"]).select(
        "served_by", F.date_format("slot", "yyyy-MM-dd").alias("week"), "requests", "errors",
        F.round(F.col("p")[1], 6).alias("exact_p95"), close.alias("close"))


def _halves(spark, sf, *extra):
    df = valuations(spark, sf, ["size_sqm", "sale_price", "year_built", "sale_date", *extra])
    early = F.col("sale_date") < F.lit("2000-01-01").cast("date")
    return df.filter(early), df.filter(~early)


_PSI_TAIL = """t AS (SELECT feature, sum(base) AS tb, sum(cur) AS tc FROM c GROUP BY feature),
s AS (SELECT feature, greatest(base / tb, 1e-6::DOUBLE) AS e, greatest(cur / tc, 1e-6::DOUBLE) AS a
  FROM c JOIN t USING (feature))
SELECT feature, round(sum((a - e) * ln(a / e)), 6) AS psi, sum((a - e) * ln(a / e)) > 0.2 AS alert
FROM s GROUP BY feature"""


@query("psi_numeric", f"""WITH {V}, f AS (SELECT 'size_sqm' AS feature, size_sqm AS x,
  sale_date < DATE '2000-01-01' AS early FROM v UNION ALL
  SELECT 'sale_price', sale_price, sale_date < DATE '2000-01-01' FROM v UNION ALL
  SELECT 'year_built', year_built, sale_date < DATE '2000-01-01' FROM v),
q AS (SELECT feature, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
  FROM f WHERE early GROUP BY feature),
c AS (SELECT feature, len(list_filter(edges, lambda e: e < x)) AS bin, count(*) FILTER (early) AS base,
  count(*) FILTER (NOT early) AS cur FROM f JOIN q USING (feature) GROUP BY ALL), {_PSI_TAIL}""")
def psi_numeric(spark, sf):
    out = monitor.psi(*_halves(spark, sf), ["size_sqm", "sale_price", "year_built"])
    return out.withColumn("psi", F.round("psi", 6))


@query("psi_categorical", f"""WITH {V}, f AS (SELECT 'property_type' AS feature, property_type AS x,
  sale_date < DATE '2000-01-01' AS early FROM v UNION ALL
  SELECT 'region_code', region_code, sale_date < DATE '2000-01-01' FROM v),
c AS (SELECT feature, x, count(*) FILTER (early) AS base, count(*) FILTER (NOT early) AS cur
  FROM f GROUP BY ALL), {_PSI_TAIL}""")
def psi_categorical(spark, sf):
    names = ["property_type", "region_code"]
    out = monitor.psi_categorical(*_halves(spark, sf, *names), names)
    return out.withColumn("psi", F.round("psi", 6))


@query("ks_two_sample", f"""WITH {V}, c AS (SELECT sale_price AS x,
  count(*) FILTER (sale_date < DATE '2000-01-01') AS a,
  count(*) FILTER (sale_date >= DATE '2000-01-01') AS b FROM v GROUP BY sale_price),
r AS (SELECT sum(a) OVER w AS ra, sum(b) OVER w AS rb, sum(a) OVER () AS n1, sum(b) OVER () AS n2
  FROM c WINDOW w AS (ORDER BY x)),
d AS (SELECT CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2,
  max(abs(ra / n1 - rb / n2)) AS d FROM r),
l AS (SELECT *, (sqrt(n1::DOUBLE * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(n1::DOUBLE * n2 / (n1 + n2)))
  * d AS lam FROM d),
p AS (SELECT *, CASE WHEN lam < 0.2 THEN 1 ELSE least(greatest(2 * list_sum(list_transform(
  range(1, 101), lambda j: CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * j * j * lam * lam))), 0), 1)
  END AS p FROM l)
SELECT n1, n2, round(d, 6) AS d, round(p, 6)::DOUBLE AS p, p < 0.01 AS alert, d > 0.3 AS rollback FROM p""")
def ks_two_sample(spark, sf):
    out = monitor.ks_two_sample(*_halves(spark, sf), "sale_price")
    return out.withColumns({"d": F.round("d", 6), "p": F.round("p", 6)})


_HEALTH = f"""{LOG}, h AS (SELECT served_by, time_bucket(INTERVAL '1 hour', ts) AS w,
  count(*) AS requests, avg(is_error) AS error_rate, quantile_cont(latency_ms, 0.95) AS p95
  FROM log GROUP BY ALL)"""


@query("health_windows", f"""WITH {_HEALTH} SELECT served_by, strftime(w, '%Y-%m-%d %H:%M') AS window_start,
  requests, round(error_rate, 6) AS error_rate, round(p95, 6) AS p95 FROM h""")
def health_windows(spark, sf):
    out = monitor.health_windows(request_log(spark, sf), "1 hour")
    return out.withColumns({
        "window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm"),
        "error_rate": F.round("error_rate", 6), "p95": F.round("p95", 6)})


@query("rollback_triggers", f"""WITH {_HEALTH}, e AS (SELECT served_by, w,
  min(error_rate) OVER r5 AS m5, count(*) OVER r5 AS c5, min(w) OVER r5 AS f5,
  min(p95 / 20) OVER r10 AS m10, count(*) OVER r10 AS c10, min(w) OVER r10 AS f10 FROM h
  WINDOW r5 AS (PARTITION BY served_by ORDER BY w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
  r10 AS (PARTITION BY served_by ORDER BY w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT served_by, strftime(w, '%Y-%m-%d %H:%M') AS window_start, 'error_rate' AS reason FROM e
  WHERE m5 > 0.01 AND c5 = 5 AND w - f5 = INTERVAL '4 hours'
UNION ALL SELECT served_by, strftime(w, '%Y-%m-%d %H:%M'), 'latency_p95' FROM e
  WHERE m10 > 2 AND c10 = 10 AND w - f10 = INTERVAL '9 hours'""")
def rollback_triggers(spark, sf):
    windows = monitor.health_windows(request_log(spark, sf), "1 hour")
    out = monitor.rollback_triggers(windows, baseline_p95=20.0, window_seconds=3600)
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))
