"""Zero counts at several levels, and ranges that say so."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_levels(counts: DataFrame, levels: Sequence[str], volume: str) -> DataFrame:
    """Keys without volume at the coarsest level that has none: (levels; finer ones null).

    ``levels`` are nested, the coarsest first. One pass of grouping sets; a key drops out if what it belongs to is there."""
    sets = [list(levels[: k + 1]) for k in range(len(levels))]
    sums = counts.groupingSets(sets, *levels).agg(F.sum(volume).alias("_v"), *[F.grouping(c).alias(f"_g_{c}") for c in levels]).where("_v = 0")
    out = None
    for k in range(len(levels)):
        at = sums.where(reduce(lambda a, b: a & b, [F.col(f"_g_{c}") == (0 if n <= k else 1) for n, c in enumerate(levels)])).select(*levels)
        for above in range(k):
            top = sums.where(reduce(lambda a, b: a & b, [F.col(f"_g_{c}") == (0 if n <= above else 1) for n, c in enumerate(levels)]))
            top = top.select(*[F.col(c).alias(f"_t_{c}") for c in levels[: above + 1]])
            at = at.join(top, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in levels[: above + 1]]), "left_anti")
        out = at if out is None else out.unionByName(at)
    return out


def range_upkeep(found: DataFrame, ranges: DataFrame, keys: Sequence[str], begin: Column, end: Column) -> DataFrame:
    """What to do with keys found silent from ``begin`` to ``end``: (keys, range_start, range_end, action).

    ``extend`` the automatic range of the very keys that ends at ``begin``; nothing if a range whose keys, nulls standing for any
    value, hold these covers the time (an open end covers all); else ``insert``. ``ranges``: keys, range_start, range_end, automatic."""
    r = ranges.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("range_start").alias("_start"), F.col("range_end").alias("_end"), "automatic")
    first, *finer = keys
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    ends_here = r.where(F.col("automatic") & (F.col("_end") == begin)).groupBy(*[f"_r_{k}" for k in keys]).agg(F.min("_start").alias("_since"))
    marked = found.join(ends_here, same, "left").select(*keys, "_since")
    holds = reduce(lambda a, b: a & b, [F.col(f"_r_{k}").isNull() | F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in finer], F.col(first) == F.col(f"_r_{first}"))
    covering = r.where((F.col("_start") <= begin) & (F.col("_end").isNull() | (F.col("_end") >= end)))
    fresh = marked.where("_since is null").join(covering, holds, "left_anti")
    out = marked.where("_since is not null").select(*keys, F.col("_since").alias("range_start"), F.lit("extend").alias("action")).unionByName(fresh.select(*keys, begin.alias("range_start"), F.lit("insert").alias("action")))
    return out.select(*keys, "range_start", end.alias("range_end"), "action")


def daily_volumes(bins: DataFrame, gaps: DataFrame, usual: DataFrame, bad: DataFrame, notes: DataFrame, key: str, expected: int) -> DataFrame:
    """(key, day, volume, missing_minutes, gap_minutes, missing_volume, caveats) of days that no bad range touches.

    ``bins``: key, ts (minutes that have a count), volume; ``gaps``: key, day, hour, gap_minutes; ``usual``: key, hour, per_hour, by which minutes
    in gaps are valued; ``bad``: key, day; ``notes``: key, day, rank, caveat, put in order. Every side is summed to days before it meets the others."""
    day = bins.groupBy(key, F.to_date("ts").alias("day")).agg(F.sum("volume").alias("volume"), (expected - F.count_distinct("ts")).alias("missing_minutes"))
    lost = gaps.join(usual, [key, "hour"], "left").groupBy(key, "day").agg(F.sum("gap_minutes").alias("gap_minutes"), F.sum(F.col("gap_minutes") * F.coalesce("per_hour", F.lit(0.0)) / 60).alias("missing_volume"))
    said = notes.groupBy(key, "day").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("rank", "caveat"))), lambda n: n["caveat"])).alias("caveats"))
    out = day.join(bad.select(key, "day").distinct(), [key, "day"], "left_anti").join(lost, [key, "day"], "left").join(said, [key, "day"], "left")
    return out.select(key, "day", "volume", "missing_minutes", F.coalesce("gap_minutes", F.lit(0)).alias("gap_minutes"), F.coalesce("missing_volume", F.lit(0.0)).alias("missing_volume"), F.coalesce("caveats", F.array().cast("array<string>")).alias("caveats"))
