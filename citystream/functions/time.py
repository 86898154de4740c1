"""Event-time helpers; all are Column expressions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# The text layouts the producers write ('yyyy-MM-dd HH:mm:ss'
# in UTC, and ISO 'yyyy-MM-ddTHH:mm:ssZ').  Text without a zone is UTC.
TEXT_FORMATS = ("yyyy-MM-dd HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ssX",
                "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXXX")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(c) -> Column:
    """Parse an event timestamp given as epoch milliseconds or text.

    Accepts a number (epoch ms), digit-only text (epoch ms), or one of
    ``TEXT_FORMATS`` with or without a zone (no zone = UTC).  Anything else
    gives null.  Result: TIMESTAMP_NTZ in UTC wall time; the session time
    zone plays no part (zone-less text is given an explicit 'Z').
    """
    col = _c(c)
    s = F.trim(col.cast("string"))
    as_ms = F.when(s.rlike(r"^-?[0-9]{1,18}$"), s.cast("long"))
    zoned = F.when(s.rlike(r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"), s).otherwise(F.concat(s, F.lit("Z")))
    parsed = F.coalesce(*[F.try_to_timestamp(zoned, F.lit(f)) for f in TEXT_FORMATS])
    return F.coalesce(micros_to_ntz(as_ms * F.lit(1000)), utc_to_ntz(parsed))


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ column (zone free)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(c))


def epoch_millis(c) -> Column:
    return F.floor(epoch_micros(c) / F.lit(1000)).cast("long")


def micros_to_ntz(us) -> Column:
    return F.timestamp_add("MICROSECOND", _c(us), F.expr(_EPOCH_NTZ))


def ntz_to_utc(c) -> Column:
    """TIMESTAMP_NTZ (UTC wall time) -> TIMESTAMP at the same UTC instant.

    Needed for watermarks, which accept only TIMESTAMP.  Independent of the
    session time zone.
    """
    return F.timestamp_micros(epoch_micros(c))


def utc_to_ntz(c) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ holding the UTC wall time."""
    return micros_to_ntz(F.unix_micros(_c(c)))


def split_id(c, seconds: int) -> Column:
    """Index of the fixed-width time slice holding an NTZ time.

    Used to split a hot key's ordered sequence into bounded pieces.
    """
    return F.floor(epoch_micros(c) / F.lit(int(seconds) * 1_000_000)).cast("long")
