"""Aggregation into bins with zero padding."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.session import checkpointed


def bin_spine(facts: DataFrame, bin_col: str, minutes: int) -> DataFrame:
    """Every bin between the first and the last one present, as one generated column.

    Only the two bounds are aggregated; the spine's size depends on the period, not on the rows."""
    bounds = facts.agg(F.min(bin_col).alias("lo"), F.max(bin_col).alias("hi")).where("lo is not null")
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {minutes} MINUTES"))).alias(bin_col))


def padded_sums(facts: DataFrame, keys: Sequence[str], bin_col: str, minutes: int, **sums: Column) -> DataFrame:
    """Aggregates ``sums`` per key and bin; combinations without rows get zeros.

    ``facts`` holds the bin already. The pair (distinct keys x bins) is what the result is defined as; facts are
    scanned and aggregated once, into a written table that gives keys, bounds and values, and joined on the equi-key."""
    agg = checkpointed(facts.groupBy(*keys, bin_col).agg(*[c.alias(n) for n, c in sums.items()]))
    grid = agg.select(*keys).distinct().join(bin_spine(agg, bin_col, minutes), how="cross")
    return grid.join(agg, [*keys, bin_col], "left").fillna(0, list(sums))


def padded_for_new(keys: DataFrame, key: str, begun: str, ended: str, first: Column, last: Column, minutes: int, **zeros: Column) -> DataFrame:
    """Zero rows of keys that are new to a padded table: a row for each bin of a key's whole life, from the later of ``begun`` and ``first`` up to the earlier of ``ended`` (null: still there) and ``last`` (exclusive)."""
    lo, hi = F.greatest(F.col(begun), first), F.least(F.coalesce(F.col(ended), last), last)
    life = keys.withColumn("_lo", lo).withColumn("_hi", hi).where("_lo < _hi")
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    return life.select(key, F.explode(F.sequence("_lo", F.col("_hi") - step, step)).alias("bin")).withColumns(zeros)
