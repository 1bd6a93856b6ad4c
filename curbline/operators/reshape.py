"""Reshaping of counts: movements to approaches, wide to long, histograms, splits, interpolation."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions.timebin import floor_bin

#: Exit leg of each (leg, movement): 1 through, 2 left, 3 right, 4 u-turn. Fixed values by geometry.
EXITS = {"N": "SEWN", "E": "WSNE", "S": "NWES", "W": "ENSW"}
DIRECTIONS = {"N": "SB", "E": "WB", "S": "NB", "W": "EB"}


def exit_leg(leg: Column, movement: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, legs in EXITS.items():
        out = F.when((leg == k) & movement.between(1, 4), F.substring(F.lit(legs), movement.cast("int"), F.lit(1))).otherwise(out)
    return out


def movements_to_approaches(rows: DataFrame, keys: Sequence[str], leg: str, movement: str, volume: str) -> DataFrame:
    """Each turning movement counts where it enters and where it leaves: one scan, an explode of two, one sum."""
    towards = lambda c: F.create_map(*[F.lit(x) for kv in DIRECTIONS.items() for x in kv])[c]
    out = exit_leg(F.col(leg), F.col(movement))
    # who leaves by a leg moves away from the node, opposite to those who enter there
    away = F.create_map(*[F.lit(x) for kv in {"N": "NB", "E": "EB", "S": "SB", "W": "WB"}.items() for x in kv])[out]
    ends = F.array(F.struct(F.col(leg).alias("leg"), towards(F.col(leg)).alias("dir")), F.struct(out.alias("leg"), away.alias("dir")))
    seen = rows.select(*keys, F.explode(ends).alias("end"), F.col(volume).alias("_v")).where("end.leg IS NOT NULL")
    return seen.groupBy(*keys, F.col("end.leg").alias("leg"), F.col("end.dir").alias("dir")).agg(F.sum("_v").alias(volume))


def wide_to_long(rows: DataFrame, ids: Sequence[str], pattern: str, names: Sequence[str], value: str) -> DataFrame:
    """Unpivots the columns that match ``pattern`` and splits their names into its groups."""
    import re

    wide = [c for c in rows.columns if re.fullmatch(pattern, c)]
    long = rows.unpivot(list(ids), wide, "_name", value)
    return long.select(*ids, *[F.regexp_extract("_name", pattern, k + 1).alias(n) for k, n in enumerate(names)], value)


def time_ranges(rows: DataFrame, ids: Sequence[str], prefix: str, value: str) -> DataFrame:
    """Columns named ``{prefix}hhmm_hhmm`` as rows (ids, begin, end, value): times of day in minutes, read from the names."""
    long = wide_to_long(rows, ids, rf"{prefix}(\d\d)(\d\d)_(\d\d)(\d\d)", ["_a", "_b", "_c", "_d"], value)
    at = lambda h, m: F.col(h).cast("int") * 60 + F.col(m).cast("int")
    return long.select(*ids, at("_a", "_b").alias("begin"), at("_c", "_d").alias("end"), value)


def histogram(rows: DataFrame, keys: Sequence[str], value: str, width: int) -> DataFrame:
    """Counts by ``floor(value / width) * width`` with each bin's share of its keys' total."""
    binned = rows.withColumn("bin_lo", (F.floor(F.col(value) / width) * width).cast("long"))
    counts = binned.groupBy(*keys, "bin_lo").agg(F.count("*").alias("n"))
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))


def split_half_hours(bins: DataFrame, key: str, bin_col: str, volume: str) -> DataFrame:
    """30-minute counts (not 0) as two 15-minute ones: along the trend of both neighbours, (v -+ (next - previous) / 6) / 2; with
    one neighbour in proportion to it and the count; else halves."""
    w = Window.partitionBy(key).orderBy(bin_col)
    near = F.expr("INTERVAL 30 MINUTES")
    known = bins.where(F.col(volume) != 0).select(
        key, bin_col, F.col(volume).alias("_v"),
        F.when(F.lag(bin_col).over(w) == F.col(bin_col) - near, F.lag(volume).over(w)).alias("_a"),
        F.when(F.lead(bin_col).over(w) == F.col(bin_col) + near, F.lead(volume).over(w)).alias("_b"),
    )
    v, a, b = F.col("_v"), F.col("_a"), F.col("_b")
    first = F.when(a.isNotNull() & b.isNotNull(), (v - (b - a) / 6) / 2).when(b.isNotNull(), v * v / (v + b)).when(a.isNotNull(), a * v / (a + v)).otherwise(v / 2)
    halves = F.array(F.struct(F.col(bin_col).alias("b"), first.alias("v")), F.struct((F.col(bin_col) + F.expr("INTERVAL 15 MINUTES")).alias("b"), (v - first).alias("v")))
    return known.withColumn("_h", F.explode(halves)).select(key, F.col("_h.b").alias(bin_col), F.col("_h.v").alias(volume))


def quarter_hours(hours: DataFrame, keys: Sequence[str], bin_col: str, volume: str) -> DataFrame:
    """Hourly counts as four bins: the count stands in the first, the others are zeros in its place."""
    parts = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), (F.col(volume) if m == 0 else F.lit(0)).cast("long").alias("v")) for m in (0, 15, 30, 45)]))
    return hours.select(*keys, bin_col, parts.alias("_p")).select(*keys, (F.col(bin_col) + F.make_dt_interval(mins=F.col("_p.m"))).alias(bin_col), F.col("_p.v").alias(volume))


#: Opposite leg, and what leaves by each leg: straight on from the opposite leg, right from the next one clockwise, left from the one before.
CLOCKWISE = "NESW"


def exit_volumes(kind: str, legs: str = CLOCKWISE) -> dict[str, Column]:
    """What leaves by each leg of a node, from columns ``{leg}_{kind}_{r|t|l}`` in lower case: (leg, sum)."""
    out = {}
    for k, leg in enumerate(legs):
        from_ = lambda turn: legs[(k + turn) % 4].lower()  # noqa: E731, B023
        # seen from the leg that is entered: straight on it leaves opposite, by a right turn a quarter against the clock
        out[leg] = F.col(f"{from_(2)}_{kind}_t") + F.col(f"{from_(1)}_{kind}_r") + F.col(f"{from_(3)}_{kind}_l")
    return out


def fill_linear(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Nulls between two known values of a sensor become their linear interpolation by ``order`` (numeric); ends stay null."""
    w = Window.partitionBy(key).orderBy(order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    point = F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("x"), F.col(value).alias("y")))
    both = rows.withColumn("_a", F.last(point, True).over(back)).withColumn("_b", F.first(point, True).over(ahead))
    line = F.col("_a.y") + (F.col("_b.y") - F.col("_a.y")) * (F.col(order) - F.col("_a.x")) / (F.col("_b.x") - F.col("_a.x"))
    return both.withColumn(value, F.coalesce(F.col(value), line)).drop("_a", "_b")


def complete_days(rows: DataFrame, key: str, ts: str, minutes: int, least: int) -> DataFrame:
    """(key, day, bins) of days with at least ``least`` distinct bins."""
    return rows.groupBy(key, F.to_date(ts).alias("day")).agg(F.count_distinct(floor_bin(ts, minutes)).alias("bins")).where(F.col("bins") >= least)
