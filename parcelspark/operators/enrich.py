"""Public enrichment: left joins with dimensions that are unique on their keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.skew import BROADCAST_BYTES, lookup_join

# The public tables, their join keys and value columns.
PUBLIC_DIMENSIONS = {
    "public_osm_h3_features": (["geo_h3_r8"], ["dist_school", "dist_transit",
                                               "amenity_count_1km"]),
    "public_census_postcode": (["postcode_prefix"], ["median_income", "unemployment_rate",
                                                     "pop_density"]),
    "public_macro_indicators": (["sale_month"], ["mortgage_rate", "cpi",
                                                 "regional_gdp_growth"]),
    "public_hazard_layers": (["geo_h3_r8"], ["flood_zone", "seismic_zone"]),
}


def assert_unique(dim: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs twice, which would multiply the facts."""
    twice = dim.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"dimension is not unique on {list(keys)}: {twice}")


def enrich(df: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]],
           max_bytes: int = BROADCAST_BYTES, check: bool = True) -> DataFrame:
    """Left join each dimension; every fact row comes out exactly once."""
    for dim, keys in dims:
        if check:
            assert_unique(dim, keys)
        df = lookup_join(df, dim, keys, "left", max_bytes)
    return df


def append_files(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns missing from one of them are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def with_row_count(df: DataFrame, name: str):
    """The frame and an Observation that counts its rows while they are written."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
