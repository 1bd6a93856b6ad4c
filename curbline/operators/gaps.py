"""Gaps, islands, outages and runs in per-sensor time series. All windows are partitioned by sensor."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {n} MINUTES")


def find_gaps(points: DataFrame, key: str, ts: str, start: str, end: str, bin_minutes: int, threshold_minutes: int) -> DataFrame:
    """Silent stretches of at least ``threshold_minutes`` per sensor between ``start`` and ``end``.

    A real point covers its bin; the two ends of the period are added as points without length. Sensors without any
    point in the period are not found. Returns (key, gap_start, gap_end, gap_minutes)."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    real = points.where((F.col(ts) >= lo) & (F.col(ts) < hi)).select(key, F.col(ts).alias("dt")).distinct().withColumn("covers", F.lit(bin_minutes))
    sensors = real.select(key).distinct()
    edge = sensors.select(key, F.explode(F.array(lo, hi)).alias("dt")).withColumn("covers", F.lit(0))
    w = Window.partitionBy(key).orderBy("dt", "covers")
    begun = (F.col("dt") + F.make_dt_interval(mins=F.col("covers"))).alias("gap_start")
    steps = real.unionByName(edge).select(key, begun, F.lead("dt").over(w).alias("gap_end"))
    minutes = F.expr("timestampdiff(SECOND, gap_start, gap_end) div 60")
    return steps.withColumn("gap_minutes", minutes).where(F.expr("timestampdiff(SECOND, gap_start, gap_end)") >= threshold_minutes * 60)


def outages(bins: DataFrame, key: str, bin_col: str, bin_minutes: int, least_bins: int = 2, until: Column | None = None) -> DataFrame:
    """Missing stretches of at least ``least_bins`` between a sensor's bins (those with a count): (key, outage_start, outage_end, bins_missing), ends inclusive.

    With ``until`` (a bin, the same for all) a stretch that is still open there counts too."""
    if until is not None:
        bins = bins.select(key, bin_col).unionByName(bins.select(key).distinct().withColumn(bin_col, until)).distinct()
    previous = F.lag(bin_col).over(Window.partitionBy(key).orderBy(bin_col))
    seen = bins.select(key, bin_col, previous.alias("previous"))
    start, end = F.col("previous") + _minutes(bin_minutes), F.col(bin_col) - _minutes(bin_minutes)
    missing = F.expr(f"timestampdiff(MINUTE, previous, {bin_col}) div {bin_minutes} - 1")
    return seen.select(key, start.alias("outage_start"), end.alias("outage_end"), missing.alias("bins_missing")).where(F.col("bins_missing") >= least_bins)


def network_outages(points: DataFrame, bin_col: str, bin_minutes: int, least_bins: int = 2, until: Column | None = None) -> DataFrame:
    """Stretches in which no sensor reports. Bins are reduced to their distinct values first, so the one global window
    sees a row per bin of the period, however many sensors there are."""
    return outages(points.select(F.lit("network").alias("scope"), bin_col).distinct(), "scope", bin_col, bin_minutes, least_bins, until)


def islands(bins: DataFrame, key: str, bin_col: str, bin_minutes: int) -> DataFrame:
    """Runs of adjacent bins per sensor, by the difference of bin number and rank: (key, start, end, bins)."""
    number = F.expr(f"timestampdiff(MINUTE, TIMESTAMP_NTZ'2000-01-01 00:00:00', {bin_col}) div {bin_minutes}")
    ranked = bins.select(key, bin_col).distinct().withColumn("run", number - F.row_number().over(Window.partitionBy(key).orderBy(bin_col)))
    return ranked.groupBy(key, "run").agg(F.min(bin_col).alias("start"), F.max(bin_col).alias("end"), F.count("*").alias("bins")).drop("run")


def sessions(rows: DataFrame, keys: Sequence[str], order: Sequence[str], starts: Column) -> DataFrame:
    """Numbers the runs of each key: a row with ``starts`` true (which may use ``lag`` over :func:`row_window`) begins a new one."""
    w = row_window(keys, order)
    flagged = rows.withColumn("_new", F.coalesce(starts.cast("int"), F.lit(1)))
    return flagged.withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def row_window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def day_runs(days: DataFrame, key: str, day: str, out: Column) -> DataFrame:
    """Runs of consecutive days with ``out`` true per sensor, over complete calendars: (key, first_day, last_day, days)."""
    w = row_window([key], [day])
    flagged = days.select(key, day, out.alias("_out"))
    numbered = flagged.withColumn("_turn", F.when(F.lag("_out").over(w).eqNullSafe(F.col("_out")), 0).otherwise(1))
    numbered = numbered.withColumn("_run", F.sum("_turn").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.where("_out").groupBy(key, "_run").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("days")).drop("_run")


def unacceptable_gaps(gaps: DataFrame, key: str, tolerance: Column, bin_minutes: int = 15) -> DataFrame:
    """Gaps that reach ``tolerance`` minutes, spread over the bins that they touch: per (sensor, bin) the longest gap, then
    the earliest, with its minutes inside the bin."""
    long = gaps.where(F.col("gap_minutes") >= tolerance)
    from curbline.functions.timebin import floor_bin

    last = floor_bin(F.col("gap_end") - F.expr("INTERVAL 1 SECOND"), bin_minutes)
    spread = long.withColumn("bin", F.explode(F.sequence(floor_bin("gap_start", bin_minutes), last, _minutes(bin_minutes))))
    stop = F.least(F.col("gap_end"), F.col("bin") + _minutes(bin_minutes))
    inside = F.expr("timestampdiff(SECOND, greatest(gap_start, bin), _stop)")
    spread = spread.withColumn("_stop", stop).withColumn("seconds_in_bin", inside).drop("_stop")
    w = Window.partitionBy(key, "bin").orderBy(F.desc("gap_minutes"), "gap_start")
    return spread.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
