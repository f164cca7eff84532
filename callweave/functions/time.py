"""Epoch / timestamp conversions that do not depend on the session zone.

Timestamps are ``TIMESTAMP_NTZ`` holding UTC wall-clock time, so results are
the same whatever ``spark.sql.session.timeZone`` a cluster runs with.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_to_timestamp(col) -> Column:
    """Epoch seconds (bigint) -> TIMESTAMP_NTZ; NULL stays NULL."""
    return F.timestamp_add("SECOND", _c(col), F.expr(_EPOCH))


def timestamp_to_epoch(col) -> Column:
    """TIMESTAMP_NTZ -> whole epoch seconds, rounded down."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(col).cast("timestamp_ntz"))
    return F.floor(micros / F.lit(1_000_000)).cast("bigint")


def lookback_start_epoch(as_of, days: int) -> Column:
    """Epoch seconds of ``as_of - days``."""
    return timestamp_to_epoch(as_of) - F.lit(int(days) * 86400)


def run_date_string(col) -> Column:
    """Date or timestamp -> ``yyyy-MM-dd``."""
    return F.date_format(_c(col), "yyyy-MM-dd")
