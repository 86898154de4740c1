"""Summaries of stored advisory output (the batch report)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREVIEW_COLUMNS = ("window_start", "window_end", "zone", "zone_name", "rolling_avg_aqi")
GROUP_COLUMNS = ("zone", "zone_name")


def present(df: DataFrame, cols) -> list[str]:
    """The listed columns that exist, in the listed order."""
    return [c for c in cols if c in df.columns]


def advisory_totals(df: DataFrame) -> DataFrame:
    """One row: total advisories, distinct zones (0 when there is no zone column)."""
    zones = (F.countDistinct("zone") if "zone" in df.columns else F.lit(0).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("total_advisories"),
                  zones.alias("unique_zones"))


def advisory_preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` advisories by (window_start, zone): a deterministic head."""
    cols = present(df, PREVIEW_COLUMNS)
    order = present(df, ("window_start", "zone")) or cols
    return df.select(*cols).orderBy(*order).limit(n)


def advisory_summary(df: DataFrame) -> DataFrame:
    """Per zone (and zone_name when present): count, mean (2 dp), max of AQI.

    Rows whose group key is null are dropped; output is sorted by the keys.
    Empty input gives an empty typed result.
    """
    keys = present(df, GROUP_COLUMNS)
    if "zone" not in keys or "rolling_avg_aqi" not in df.columns:
        return df.sparkSession.createDataFrame(
            [], "zone string, zone_name string, total_advisories long, mean_aqi double, "
                "max_aqi double")
    a = F.col("rolling_avg_aqi")
    return (df.dropna(subset=keys).groupBy(*keys)
            .agg(F.count(a).alias("total_advisories"),
                 F.round(F.avg(a), 2).alias("mean_aqi"),
                 F.max(a).alias("max_aqi"))
            .orderBy(*keys))
