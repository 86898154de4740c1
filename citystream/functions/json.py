"""JSON encode/decode and key/value packing for message sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parse_events(df: DataFrame, schema: StructType, value_col: str = "value",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed parse of a JSON payload column (binary or string) into columns.

    A malformed record gives an all-null row; a field of the wrong type gives
    a null field and keeps the others.  Columns named in ``keep`` (e.g.
    ``topic``) are carried through.
    """
    data = F.from_json(F.col(value_col).cast("string"), schema)
    return df.select(*keep, data.alias("data")).select(*keep, "data.*")


KEEP_NULLS = {"ignoreNullFields": "false"}


def as_variant(struct: str | Column) -> Column:
    """A struct as a VARIANT object; null fields stay in it as JSON nulls."""
    return F.to_variant_object(struct)


def parsed_once(df: DataFrame, value: str | Column, out: str) -> DataFrame:
    """Add ``out``: the JSON text (or bytes) ``value`` as VARIANT, null where it
    is no JSON.  A generator over one element stands between the parse and what
    reads it, so the optimiser does not repeat the parse for each field."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    one = F.array(F.struct(F.try_parse_json(text).alias(out)))
    return df.select("*", F.inline(one))


def to_kv(df: DataFrame, key: str | Column | None, *fields,
          keep_nulls: bool = False) -> DataFrame:
    """Pack rows as (key, value) strings for a message sink.

    ``fields`` default to all columns; VARIANT and struct fields are nested.
    Null fields are left out, or written as JSON nulls with ``keep_nulls``
    (nulls inside a VARIANT always stay).  ``key=None`` gives a null key.
    """
    cols = list(fields) if fields else [F.col(c) for c in df.columns]
    k = F.lit(None).cast("string") if key is None else (
        F.col(key) if isinstance(key, str) else key).cast("string")
    return df.select(k.alias("key"), F.to_json(F.struct(*cols), KEEP_NULLS if keep_nulls else {}).alias("value"))
