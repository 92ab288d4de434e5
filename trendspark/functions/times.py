"""Date, time and duration expressions (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 duration and date-prefix formats.
DURATION_PATTERN = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$"
DURATION_CHECK = r"^P(?:\d+D)?(?:T(?:\d+H)?(?:\d+M)?(?:\d+S)?)?$"
DATE_PREFIX_CHECK = r"^\d{4}-\d{2}-\d{2}"
DAY_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
_UNIT_SECONDS = {1: 86400, 2: 3600, 3: 60, 4: 1}


def duration_seconds(col: Column) -> Column:
    """Seconds of an ISO-8601 duration; null and malformed text give 0."""
    units = F.array(*[F.lit(u).cast("bigint") for u in _UNIT_SECONDS.values()])

    def total(parts: Column) -> Column:
        # Casting '' would raise and catch an error per row, so blanks become null first.
        terms = F.zip_with(parts, units, lambda p, u: F.coalesce(F.when(p != "", p).try_cast("bigint"), F.lit(0)) * u)
        return F.when(~parts[0].startswith("P"), F.aggregate(terms, F.lit(0).cast("bigint"), lambda a, x: a + x))

    # One match writes the parts side by side; text that does not match keeps its first letter. The lambda binds the
    # match, which each use of a plain expression would run again.
    written = F.array(F.split(F.regexp_replace(col, DURATION_PATTERN, "$1:$2:$3:$4"), ":"))
    return F.coalesce(F.when(col.startswith("P"), F.transform(written, total)[0]), F.lit(0).cast("bigint"))


def clock_seconds(col: Column) -> Column:
    """'mm:ss' to seconds."""
    parts = F.split(col, ":")
    return F.get(parts, F.lit(0)).try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int")


def as_timestamp(col: Column) -> Column:
    return F.try_to_timestamp(col.cast("string"))


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def day_label(day: Column) -> Column:
    return F.get(F.array(*[F.lit(d) for d in DAY_LABELS]), day)


def time_parts(ts: Column) -> dict[str, Column]:
    return {
        "hour": F.hour(ts),
        "weekday": F.weekday(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "is_weekend": F.weekday(ts) >= 5,
    }
