"""Interval algebra and joins: as-of, interval, wildcard, split, merge, subtract, chains."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.session import checkpointed


@dataclass(frozen=True)
class Range:
    """A range of columns: lower bound inclusive, upper one as said (a flag or a column); a null bound is open."""

    lo: Column
    hi: Column
    upper_inclusive: Column | bool = False

    def _closed(self) -> Column:
        return self.upper_inclusive if isinstance(self.upper_inclusive, Column) else F.lit(self.upper_inclusive)

    def is_empty(self) -> Column:
        return F.coalesce((self.lo > self.hi) | ((self.lo == self.hi) & ~self._closed()), F.lit(False))

    def contains(self, x: Column) -> Column:
        return F.coalesce(self.lo <= x, F.lit(True)) & F.coalesce((x < self.hi) | ((x == self.hi) & self._closed()), F.lit(True))

    def overlaps(self, other: "Range") -> Column:
        """Whether neither range ends before the other begins; empty ranges overlap as their bounds do."""
        before = lambda a, b: F.coalesce((b.lo < a.hi) | ((b.lo == a.hi) & a._closed()), F.lit(True))
        return before(self, other) & before(other, self)

    def intersection(self, other: "Range") -> "Range":
        """Half-open; empty where the bounds cross."""
        return Range(F.greatest(self.lo, other.lo), F.least(self.hi, other.hi))


def overlap_join(a: DataFrame, b: DataFrame, key: str, a_span: tuple[str, str], b_span: tuple[str, str]) -> DataFrame:
    """Pairs of half-open spans of one key that overlap (``b``'s columns but the key are named unlike ``a``'s).

    Both are cut by day and meet in an equi-join on (key, day); a pair counts on the day on which the later one begins, so it
    comes out once."""
    days = lambda df, span: df.where(F.col(span[0]) < F.col(span[1])).withColumn("_day", F.explode(F.sequence(F.to_date(span[0]), F.to_date(span[1]), F.expr("INTERVAL 1 DAY"))))
    met = days(a, a_span).join(days(b, b_span), [key, "_day"])
    begun = F.greatest(a_span[0], b_span[0])
    return met.where((F.col(a_span[0]) < F.col(b_span[1])) & (F.col(b_span[0]) < F.col(a_span[1])) & (F.to_date(begun) == F.col("_day"))).drop("_day")


def asof_join(facts: DataFrame, dims: DataFrame, key: str, at: str, valid_from: str, columns: Sequence[str], valid_to: str | None = None) -> DataFrame:
    """Latest row of ``dims`` with ``valid_from <= at < valid_to`` (null: open) for each fact; facts without one keep nulls.

    One sort per key over facts and dims together and running windows: no range join, so no blow-up by versions. Of dims
    with equal ``valid_from`` the one that ends last counts, then the one with the largest struct of ``columns``. A version that has
    ended gives way to an earlier one that is still valid: versions are cut at the times where a later one begins or ends."""
    names = facts.columns
    if valid_to is None:
        spans = dims.groupBy(F.col(key).alias("_key"), F.col(valid_from).alias("_at")).agg(F.max(F.struct(*columns)).alias("_dim"))
    else:
        d = dims.select(F.col(key).alias("_key"), F.col(valid_from).alias("_lo"), F.col(valid_to).alias("_hi"), F.struct(*columns).alias("_dim")).where("_hi is null or _lo < _hi")
        # at each bound of a key: the latest version that holds there
        bounds = d.select("_key", F.col("_lo").alias("_at")).unionByName(d.where("_hi is not null").select("_key", F.col("_hi").alias("_at"))).distinct()
        held = bounds.join(d.withColumnRenamed("_key", "_k"), (F.col("_key") == F.col("_k")) & (F.col("_lo") <= F.col("_at")) & (F.col("_hi").isNull() | (F.col("_at") < F.col("_hi"))), "left")
        best = F.max(F.when(F.col("_lo").isNotNull(), F.struct("_lo", F.col("_hi").isNull().alias("_open"), "_hi", "_dim")))
        spans = held.groupBy("_key", "_at").agg(best.alias("_b")).select("_key", "_at", F.col("_b._dim").alias("_dim"))
    f = facts.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*names).alias("_fact"))
    both = f.unionByName(spans.select("_key", "_at", F.lit(0).alias("_side"), F.struct("_dim").alias("_span")), allowMissingColumns=True)
    w = Window.partitionBy("_key").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_span", F.last("_span", ignorenulls=True).over(w)).where("_side = 1")
    return found.select("_fact.*", *[F.col(f"_span._dim.{c}").alias(c) for c in columns])


def band_join(facts: DataFrame, bands: DataFrame, value: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Left join of values to half-open bands ``[lo, hi)``; null ``hi`` is open. ``bands`` is a small lookup (declared
    class tables), which Spark broadcasts by its size."""
    return facts.join(bands, (F.col(value) >= F.col(lo)) & (F.col(hi).isNull() | (F.col(value) < F.col(hi))), "left")


def interval_join(points: DataFrame, spans: DataFrame, key: str, at: str, lo: str, hi: str, how: str = "inner") -> DataFrame:
    """Points within half-open spans of their key, joined on (key, day) after spans are cut by day: an equi-join whose
    buckets hold a day's rows of one key. Spans end with the points' last day; ``hi`` null is open."""
    last = points.agg(F.max(at).alias("_last"))
    cut = spans.join(F.broadcast(last)).withColumn("_end", F.least(F.coalesce(F.col(hi), F.col("_last") + F.expr("INTERVAL 1 SECOND")), F.col("_last") + F.expr("INTERVAL 1 SECOND")))
    cut = cut.where(F.col(lo) < F.col("_end")).withColumn("_day", F.explode(F.sequence(F.to_date(lo), F.to_date(F.col("_end")), F.expr("INTERVAL 1 DAY")))).drop("_last")
    other = [c for c in spans.columns if c != key]
    cut = cut.select(F.col(key).alias("_key"), "_day", "_end", *other)
    met = (F.col(key) == F.col("_key")) & (F.to_date(at) == F.col("_day")) & (F.col(at) >= F.col(lo)) & (F.col(at) < F.col("_end"))
    return points.join(cut, met, how).drop("_key", "_day", "_end")


def factor_ranges(counts: DataFrame, settings: DataFrame, key: str, at: str, lo: str, hi: str) -> DataFrame:
    """Spans in which each count's factor holds: from its time, the first of a setting from the setting's start, to the next count's or the setting's end (null: open)."""
    s = settings.select(F.col(key).alias("_key"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
    met = counts.join(s, (F.col(key) == F.col("_key")) & (F.col(at) >= F.col("_lo")) & (F.col("_hi").isNull() | (F.col(at) < F.col("_hi"))))
    w = Window.partitionBy("_key", "_lo").orderBy(at)
    spans = met.withColumn(lo, F.when(F.lag(at).over(w).isNull(), F.col("_lo")).otherwise(F.col(at))).withColumn(hi, F.coalesce(F.lead(at).over(w), F.col("_hi")))
    return spans.drop("_key", "_lo", "_hi", at)


def merge_ranges(ranges: DataFrame, keys: Sequence[str], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Union of overlapping or touching ranges per key, closed over chains of any length."""
    w = Window.partitionBy(*keys).orderBy(lo, hi)
    reach = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = ranges.withColumn("_new", F.when(F.col(lo) <= reach, 0).otherwise(1))
    marked = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_run").agg(F.min(lo).alias(lo), F.max(hi).alias(hi)).drop("_run")


def cut_out(ranges: DataFrame, lo: str, hi: str, from_: Column, to: Column) -> DataFrame:
    """Ranges without ``[from_, to)``: what is left of it and what is right, if anything."""
    parts = F.array(F.struct(F.col(lo).alias("a"), F.least(F.col(hi), from_).alias("b")), F.struct(F.greatest(F.col(lo), to).alias("a"), F.col(hi).alias("b")))
    out = ranges.withColumn("_part", F.explode(parts)).where("_part.a < _part.b")
    return out.withColumn(lo, F.col("_part.a")).withColumn(hi, F.col("_part.b")).drop("_part")


def wildcard_anti(facts: DataFrame, rules: DataFrame, keys: Sequence[str], at: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Facts that no rule covers at their time ``at``: a null in a rule's key means any value, its span is half-open, and a null ``hi`` open.

    Rules are split by which keys are null, one equi anti-join on the others each. Rules for any key at all are merged into
    spans that don't overlap, cut by day, and met by the day: no nested loop over rules and facts."""
    out = facts
    for given in product((True, False), repeat=len(keys)):
        part = rules.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() if has else F.col(k).isNull() for k, has in zip(keys, given)]))
        part = part.select(*[F.col(k).alias(f"_r_{k}") for k, has in zip(keys, given) if has], F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
        held = (F.col(at) >= F.col("_lo")) & (F.col("_hi").isNull() | (F.col(at) < F.col("_hi")))
        if any(given):
            out = out.join(part, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_r_{k}") for k, has in zip(keys, given) if has]) & held, "left_anti")
        else:
            last = facts.agg(F.max(at).alias("_last"))
            ended = part.join(F.broadcast(last)).select(F.lit(0).alias("_one"), "_lo", F.coalesce("_hi", F.col("_last") + F.expr("INTERVAL 1 SECOND")).alias("_hi")).where("_lo < _hi")
            merged = merge_ranges(ended, ["_one"], "_lo", "_hi").withColumn("_day", F.explode(F.sequence(F.to_date("_lo"), F.to_date("_hi"), F.expr("INTERVAL 1 DAY"))))
            out = out.join(merged, (F.to_date(at) == F.col("_day")) & (F.col(at) >= F.col("_lo")) & (F.col(at) < F.col("_hi")), "left_anti")
    return out


def resolve_chain(links: DataFrame, old: str, new: str) -> DataFrame:
    """Follows replacements (one for each ``old``; null: not replaced) to their end by pointer jumping: (old, current, hops, cyclic).

    Each round doubles the reach and is written, so the plan stays one join deep; log2 of the longest chain in rounds. Members
    of a cycle, and what leads into one, have a null ``current``."""
    ends = links.where(F.col(new).isNull()).select(F.col(old).alias("old"), F.col(old).alias("current"), F.lit(0).cast("long").alias("hops"), F.lit(False).alias("cyclic"))
    table = checkpointed(links.where(F.col(new).isNotNull()).select(F.col(old).alias("old"), F.col(new).alias("current"), F.lit(1).cast("long").alias("hops")))
    most = table.count()
    reach = 1
    while True:
        nxt = table.select(F.col("old").alias("_o"), F.col("current").alias("_c"), F.col("hops").alias("_h"))
        step = checkpointed(table.join(nxt, table.current == nxt._o, "left"))
        if reach > most or step.where("_c is not null").isEmpty():
            cyclic = F.col("_c").isNotNull()
            return step.select("old", F.when(~cyclic, F.col("current")).alias("current"), F.when(~cyclic, F.col("hops")).alias("hops"), cyclic.alias("cyclic")).unionByName(ends)
        table = step.select("old", F.coalesce("_c", "current").alias("current"), (F.col("hops") + F.coalesce("_h", F.lit(0))).alias("hops"))
        reach *= 2


def overlaps(ranges: DataFrame, keys: Sequence[str], lo: str, hi: str) -> DataFrame:
    """Ranges that begin before an earlier one of their key has ended (violations of an exclusion constraint)."""
    w = Window.partitionBy(*keys).orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("_reach", F.max(hi).over(w)).where(F.col(lo) < F.col("_reach")).drop("_reach")


def coarsest(rows: DataFrame, keys: Sequence[str], level: str) -> DataFrame:
    """Of rows at two levels (``level`` null: the coarser one), those whose coarser row isn't there too."""
    top = rows.where(F.col(level).isNull()).select(*keys).distinct()
    return rows.where(F.col(level).isNull()).unionByName(rows.where(F.col(level).isNotNull()).join(top, list(keys), "left_anti"))
