"""Photo-condition scores: parsing, aggregation per property, score cache and audit."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.operators.quantiles import keyed_percentiles
from parcelspark.operators.skew import HOT_ROWS

# Keys of a photo score, the smallest usable confidence and the renovation threshold.
SCORE_KEYS = ["exterior_condition", "roof_condition", "curb_appeal", "renovation_recency",
              "visible_defects", "confidence"]
MIN_CONFIDENCE = 0.5
RENOVATED = 0.7

SCORE_SCHEMA = T.StructType([
    T.StructField(k, T.ArrayType(T.StringType()) if k == "visible_defects" else T.DoubleType())
    for k in SCORE_KEYS])
_CONDITION = ["exterior_condition", "roof_condition", "curb_appeal"]


def score_photos(df: DataFrame, scorer: Callable[[bytes], str | None],
                 image_col: str = "image") -> DataFrame:
    """Add ``score_json`` from a caller-supplied scorer (image bytes → JSON text).

    A photo whose scoring raises gets null, so one bad photo does not fail the job.
    """
    def attempt(image):
        try:
            return scorer(bytes(image))
        except Exception:
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns=[image_col]).assign(
                score_json=[attempt(image) for image in batch[image_col]])

    schema = T.StructType([f for f in df.schema if f.name != image_col]
                          + [T.StructField("score_json", T.StringType())])
    return df.mapInPandas(run, schema)


def parse_scores(df: DataFrame, json_col: str = "score_json") -> DataFrame:
    """Columns of the valid photo scores; text that is malformed, not an object or short of a key is
    dropped, while an explicit null is kept."""
    needed = F.array(*[F.lit(k) for k in SCORE_KEYS])
    present = F.json_object_keys(json_col)
    valid = df.filter(present.isNotNull() & (F.size(F.array_except(needed, present)) == 0))
    parsed = valid.withColumn("_score", F.from_json(json_col, SCORE_SCHEMA))
    return parsed.select(*[c for c in df.columns if c != json_col], "_score.*")


def aggregate_vision(scores: DataFrame, key: str = "property_hash",
                     min_conf: float = MIN_CONFIDENCE, min_photos: int = 1,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per property: medians over its usable photos.

    A property without enough usable photos keeps its row with ``photo_count`` and null scores.
    """
    usable = F.coalesce(F.col("confidence"), F.lit(0.0)) >= min_conf
    metrics = [*_CONDITION, "renovation_recency"]
    scored = keyed_percentiles(
        scores, [key], {m: (F.when(usable, F.col(m)), [0.5]) for m in metrics},
        {"photo_count": F.count(F.when(usable, 1)).cast("int")}, hot_rows)
    enough = F.col("photo_count") >= min_photos
    mid = {m: F.when(enough, F.col(m)[0]) for m in metrics}
    terms = F.filter(F.array(*[mid[m] for m in _CONDITION]), lambda x: x.isNotNull())
    mean = F.try_divide(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.size(terms))
    return scored.select(
        key, *[mid[m].alias(m) for m in metrics],
        (mid["renovation_recency"] >= RENOVATED).cast("int").alias("renovation_flag"),
        mean.alias("condition_score"), "photo_count")


def rescore_candidates(manifest: DataFrame, cache: DataFrame,
                       keys: Sequence[str] = ("property_hash", "photo_hash")) -> DataFrame:
    """Photos of the manifest that have no cached score, each once.

    Both sides are reduced to their distinct keys before the join, so copies cost nothing.
    """
    keys = list(keys)
    known = cache.select(*keys).distinct()
    return manifest.dropDuplicates(keys).join(known, keys, "left_anti")


def upsert_scores(cache: DataFrame, new: DataFrame, ts: str = "last_scored_at",
                  keys: Sequence[str] = ("property_hash", "photo_hash")) -> DataFrame:
    """Latest score per photo; at equal times the new one wins.

    An aggregate with partial maxima instead of a sort per key.
    """
    keys = list(keys)
    both = (cache.withColumn("_new", F.lit(0))
            .unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True))
    values = [c for c in both.columns if c not in (*keys, "_new")]
    order = F.struct(ts, "_new", *[F.col(c) for c in values if c != ts])
    latest = both.groupBy(*keys).agg(F.max(order).alias("_row"))
    return latest.select(*keys, *[F.col("_row")[c].alias(c) for c in values])


def vision_audit(audit: DataFrame, rubric: str, human: str, rubric_flag: str, human_flag: str,
                 confidence: str = "confidence", bins: int = 10,
                 min_corr: float = 0.7) -> DataFrame:
    """Audit metrics as (metric, bin, value, n) rows.

    ``correlation`` of rubric and human score, ``freeze`` (1 below ``min_corr``),
    ``false_renovation_rate`` among flagged properties, and per confidence bin the share of scores
    within 0.1 of the human score.
    """
    close = (F.abs(F.col(rubric) - F.col(human)) <= 0.1 + 1e-9).cast("double")
    band = F.least(F.floor(F.col(confidence) * bins), F.lit(bins - 1)).cast("int")
    flagged = F.col(rubric_flag) == 1
    n = F.count(F.lit(1))
    whole = audit.agg(
        F.corr(rubric, human).alias("corr"), n.alias("n"),
        F.count_if(flagged).alias("flagged"),
        F.count_if(flagged & (F.col(human_flag) == 0)).alias("false_flags"))
    row = "struct('{0}' AS metric, CAST(NULL AS INT) AS bin, CAST({1} AS DOUBLE) AS value, {2} AS n)"
    overall = whole.selectExpr("inline(array({}))".format(", ".join([
        row.format("correlation", "corr", "n"),
        row.format("freeze", f"CAST(coalesce(corr < {min_corr}, true) AS INT)", "n"),
        row.format("false_renovation_rate", "try_divide(false_flags, flagged)", "flagged")])))
    calibration = (audit.filter(F.col(confidence).isNotNull())
                   .groupBy(band.alias("bin")).agg(F.avg(close).alias("value"), n.alias("n"))
                   .select(F.lit("within_tenth").alias("metric"), "bin", "value", "n"))
    return overall.unionByName(calibration)
