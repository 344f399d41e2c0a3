"""Reading of instants written in several ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kbspark.functions.text import strip


def instant_micros(c: Column | str, naive_zone: str = "Z") -> Column:
    """Microseconds since the epoch of an ISO text or an epoch count; null where unreadable.

    Digits only are epoch milliseconds above 1e10 and seconds otherwise. A text without a
    zone is read in ``naive_zone``, whatever the session's zone is.
    """
    s = strip(c)
    number = s.try_cast("bigint")
    zoned = F.when(s.rlike(r"([zZ]|[+-]\d{2}:?\d{2})$") & s.rlike("[T ]"), F.regexp_replace(s, r"([+-]\d{2})(\d{2})$", "$1:$2")).otherwise(F.concat(s, F.lit(naive_zone)))
    iso = F.unix_micros(zoned.try_cast("timestamp"))
    return (
        F.when(s.rlike(r"^[+-]?\d{1,17}$"), F.when(F.abs(number) > F.lit(10_000_000_000), number * 1000).otherwise(number * 1_000_000))
        .when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.unix_micros(F.concat(s, F.lit("T00:00:00"), F.lit(naive_zone)).try_cast("timestamp")))
        .otherwise(iso)
    )
