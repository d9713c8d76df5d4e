"""Anonymization: pseudonyms, generalization, k-anonymity, noise and the release report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.geo import CELL_AREA_KM2, hex_cell
from parcelspark.functions.hashing import digest, pseudonym, uniform
from parcelspark.functions.scalars import laplace, month_text, prefix
from parcelspark.operators.skew import lookup_join
from parcelspark.session import stage

# Direct identifiers, quasi-identifiers and the group size.
DIRECT_IDS = ["owner_name", "owner_id", "account_number", "street_address", "phone", "email"]
QUASI_IDS = ["geo_h3_r8", "property_type", "sale_month", "size_band"]
K = 10


def pseudonymize(df: DataFrame, id_col: str, salt: str,
                 drop: Sequence[str] = DIRECT_IDS) -> DataFrame:
    """Replace the id by a salted pseudonym ``property_hash`` and drop direct identifiers."""
    hashed = df.withColumn("property_hash", pseudonym(F.col(id_col), salt))
    return hashed.drop(id_col, *drop)


def generalize(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
               postcode: str = "postcode", date: str = "sale_date",
               area_km2: float = CELL_AREA_KM2) -> DataFrame:
    """Coordinates → cell, postcode → three characters, date → month; the inputs are dropped."""
    return (df.withColumns({
        "geo_h3_r8": hex_cell(F.col(lat), F.col(lon), area_km2),
        "postcode_prefix": prefix(F.col(postcode)),
        "sale_month": month_text(F.col(date)),
    }).drop(lat, lon, postcode, date))


def group_sizes(df: DataFrame, quasi_ids: Sequence[str] = QUASI_IDS) -> DataFrame:
    """Rows per quasi-identifier combination; combinations with a null are left out."""
    known = df.select(*quasi_ids).dropna(subset=list(quasi_ids))
    return known.groupBy(*quasi_ids).agg(F.count(F.lit(1)).alias("group_size"))


def k_anonymize(df: DataFrame, quasi_ids: Sequence[str] = QUASI_IDS, k: int = K,
                sizes: DataFrame | None = None) -> DataFrame:
    """Keep the rows whose combination has at least ``k`` rows and no null.

    Groups are counted with map-side partial sums and the counts are staged once; pass ``sizes`` to
    share them with :func:`k_report`.
    """
    sizes = stage(group_sizes(df, quasi_ids), "group-sizes") if sizes is None else sizes
    safe = sizes.filter(F.col("group_size") >= k).select(*quasi_ids)
    return lookup_join(df, safe, quasi_ids, "left_semi")


def k_report(df: DataFrame, quasi_ids: Sequence[str] = QUASI_IDS, k: int = K,
             sizes: DataFrame | None = None) -> DataFrame:
    """One row: rows kept and dropped, and the distribution of the group sizes.

    Sizes are first counted by value: there are at most sqrt(2 * rows) distinct sizes.
    """
    sizes = group_sizes(df, quasi_ids) if sizes is None else sizes
    by_size = sizes.groupBy("group_size").agg(F.count(F.lit(1)).alias("groups"))
    size, groups = F.col("group_size"), F.col("groups")
    rows = df.agg(F.count(F.lit(1)).alias("total_rows")).scalar()
    mean = F.sum(size * groups) / F.sum(groups)
    spread = (F.sum(size.cast("double") * size * groups)
              - F.sum(size * groups) * F.sum(size * groups) / F.sum(groups).cast("double"))
    stats = by_size.agg(
        F.sum(F.when(size >= k, size * groups).otherwise(0)).alias("kept_rows"),
        F.sum(groups).alias("groups"),
        F.sum(F.when(size >= k, groups).otherwise(0)).alias("safe_groups"),
        mean.alias("size_mean"),
        F.sqrt(spread / F.nullif(F.sum(groups) - 1, F.lit(0))).alias("size_std"),
        F.min(size).alias("size_min"),
        F.percentile(size, [0.25, 0.5, 0.75], groups).alias("q"),
        F.max(size).alias("size_max"))
    kept = F.coalesce("kept_rows", F.lit(0))
    total = F.col("total_rows")
    return stats.withColumn("total_rows", rows).select(
        "total_rows", kept.alias("kept_rows"), (total - kept).alias("dropped_rows"),
        ((total - kept) / F.greatest(total, F.lit(1))).alias("dropped_share"),
        "groups", "safe_groups", "size_mean", "size_std", "size_min",
        F.col("q")[0].alias("size_p25"), F.col("q")[1].alias("size_p50"),
        F.col("q")[2].alias("size_p75"), "size_max")


def laplace_noise(df: DataFrame, col: str, key: Sequence[str], secret: str,
                  rel_scale: float = 0.005) -> DataFrame:
    """Add Laplace noise of scale ``rel_scale * value``, drawn from a keyed digest of ``key``."""
    u = uniform(digest(secret, *key))
    return df.withColumn(col, F.col(col) + laplace(u, F.col(col) * rel_scale))


def privacy_report(before: DataFrame, after: DataFrame, quasi_ids: Sequence[str] = QUASI_IDS,
                   k: int = K) -> DataFrame:
    """Release check as (item, value) rows: row-count delta, proof of k, columns removed and kept.

    Each side is read once: the groups of ``after`` give both its rows and the smallest one. Rows
    with a null quasi-identifier count as rows, and are a group of their own for the proof.
    """
    groups = after.groupBy(*quasi_ids).agg(F.count(F.lit(1)).alias("n"))
    whole = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_after"),
                       F.min("n").alias("smallest_group"))
    # One row each.
    counts = whole.crossJoin(F.broadcast(before.agg(F.count(F.lit(1)).alias("rows_before"))))
    removed = ",".join(sorted(set(before.columns) - set(after.columns)))
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in after.schema)
    leaked = ",".join(sorted(set(after.columns) & set(DIRECT_IDS)))
    smallest = F.col("smallest_group")
    items = {
        "rows_before": F.col("rows_before"), "rows_after": F.col("rows_after"),
        "rows_dropped": F.col("rows_before") - F.col("rows_after"),
        "smallest_group": smallest, "k_holds": F.coalesce(smallest >= k, F.lit(True)),
        "columns_removed": F.lit(removed), "direct_ids_left": F.lit(leaked),
        "schema": F.lit(schema),
    }
    pairs = [F.struct(F.lit(name).alias("item"), value.cast("string").alias("value"))
             for name, value in items.items()]
    return counts.select(F.inline(F.array(*pairs)))
