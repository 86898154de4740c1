"""Stream-table enrichment: add lookup columns, keep unmatched events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.operators.joins import small_side


def last_per_key(lookup: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key: the row with the highest ``order_col`` wins.

    ``max_by`` is an ordinary aggregate with a map-side partial step, so a
    key repeated many times never gathers its rows in one place.
    """
    cols = [c for c in lookup.columns if c not in (key, order_col)]
    packed = F.struct(*cols)
    return (lookup.groupBy(key).agg(F.max_by(packed, F.col(order_col)).alias("_v"))
            .select(key, *[F.col(f"_v.{c}").alias(c) for c in cols]))


def enrich(events: DataFrame, lookup: DataFrame, on: str | Sequence[str] = "route_id",
           columns: Sequence[str] | None = None) -> DataFrame:
    """Left join events to a lookup table on ``on``.

    Unmatched events keep their columns; the lookup columns are null for them
    (and so absent from ``to_json`` output, which drops nulls).  The lookup
    side is broadcast when its size check passes; keys must be unique (use
    ``last_per_key`` first).
    """
    keys = [on] if isinstance(on, str) else list(on)
    cols = list(columns) if columns else [c for c in lookup.columns if c not in keys]
    dim = small_side(lookup.select(*keys, *cols))
    return events.join(dim, keys, "left")


def enrich_json(raw: DataFrame, lookup: DataFrame, key: str = "route_id",
                value_col: str = "value", columns: Sequence[str] | None = None) -> DataFrame:
    """Enrich schemaless JSON records, keeping every field as it came.

    The record is parsed to ``map<string, variant>`` (fields the producer
    sent, explicit nulls included), the lookup is joined on the record's
    ``key`` field, and the lookup columns are added to the map only for
    matched records.  Output: the input columns plus ``enriched`` (JSON
    text).  Unparseable records give a null map and pass through unchanged.
    """
    cols = list(columns) if columns else [c for c in lookup.columns if c != key]
    text = F.col(value_col).cast("string")
    parsed = raw.withColumn("_m", F.from_json(text, "map<string, variant>"))
    parsed = parsed.withColumn("_k", F.try_variant_get(F.col("_m").getItem(key), "$", "string"))
    add = F.from_json(F.to_json(F.struct(*[F.col(c) for c in cols])), "map<string, variant>")
    dim = small_side(lookup.select(F.col(key).alias("_k"), add.alias("_add")))
    joined = parsed.join(dim, "_k", "left")
    # Lookup values replace fields of the same name, as a dict update would.
    kept = F.map_filter("_m", lambda k, v: ~k.isin(*cols))
    merged = F.when(F.col("_add").isNull(), F.col("_m")).otherwise(F.map_concat(kept, F.col("_add")))
    return joined.withColumn("enriched", F.to_json(merged)).drop("_m", "_k", "_add")
