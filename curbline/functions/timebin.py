"""Time binning on wall-clock (NTZ) timestamps, JVM-side only."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def floor_bin(ts: Column | str, minutes: int) -> Column:
    """Start of the half-open bin ``[start, start + minutes)`` that holds ``ts``.

    Bins are counted from midnight, so ``minutes`` should divide a day."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.date_trunc("DAY", ts).cast("timestamp_ntz")
    minute = F.hour(ts) * 60 + F.minute(ts)
    return day + F.make_dt_interval(mins=(minute - minute % minutes).cast("int"))


def ceil_bin(ts: Column | str, minutes: int) -> Column:
    """End of the bin ``(start, end]`` that holds ``ts``: a reading on a boundary stays there."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    low = floor_bin(ts, minutes)
    return F.when(low == ts, ts).otherwise(low + F.make_dt_interval(mins=F.lit(minutes)))


def first_local_hours(rows: DataFrame, keys: Sequence[str], utc: str, zone: str) -> DataFrame:
    """Rows with their wall-clock time ``local``; where clocks fall back, of the hour that comes twice only the first stays."""
    local = rows.withColumn("local", F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(utc)))
    # the repeat is the one whose wall clock has been shown an hour of elapsed time before
    before = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(utc) - F.expr("INTERVAL 1 HOUR"))
    return local.where(before != F.col("local"))


def shifted_bin(ts: Column | str, minutes: int) -> Column:
    """Like :func:`floor_bin` for bins ``(start, end]``: a reading on the boundary belongs to the earlier bin."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return floor_bin(ts - F.expr("INTERVAL 1 SECOND"), minutes)


def seconds_of_day(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts).cast("int")


def is_weekend(d: Column | str) -> Column:
    return F.weekday(d) >= 5


def routine_bins(day: str, ranges: list[tuple[str, str]], minutes: int = 15) -> Column:
    """Array of the bin starts in listed time-of-day ranges (first and last start, inclusive) of a day."""
    at = lambda t: F.lit(f"{day} {t}:00").cast("timestamp_ntz")
    return F.flatten(F.array(*[F.sequence(at(a), at(b), F.expr(f"INTERVAL {minutes} MINUTES")) for a, b in ranges]))
