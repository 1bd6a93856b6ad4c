"""Operators on geometry tables: lines of points, merged lines, points in polygons."""

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions import spatial as sp


def make_lines(points: DataFrame, keys: Sequence[str], order: str, x: str, y: str, name: str = "line") -> DataFrame:
    """A line of each key's points, by ``order``."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), sp.point(F.col(x), F.col(y)).alias("p"))))
    return points.groupBy(*keys).agg(F.transform(rows, lambda r: r["p"]).alias(name))


def merge_lines(lines: DataFrame, key: str, line: str) -> DataFrame:
    """Lines of each key joined where just two of them end: (key, line), one row for each line that is left.

    A key's lines (a street's, say) are joined in one task; they are as many as a street has."""
    kind = lines.schema[key].dataType.simpleString()

    def run(keys, table):
        import pyarrow as pa

        held = {k: deque((p["x"], p["y"]) for p in row) for k, row in enumerate(table.column(line).to_pylist()) if row and len(row) > 1}
        ends: dict = {}
        for k, row in sorted(held.items(), key=lambda x: (list(x[1]), x[0])):
            for end in (row[0], row[-1]):
                ends.setdefault(end, []).append(k)
        for end, both in sorted(ends.items()):
            if len(both) != 2 or both[0] == both[1]:
                continue
            # the shorter line goes into the longer one, which keeps its number; only the shorter one's other end has to learn it
            a, b = sorted(both, key=lambda k: -len(held[k]))
            first, second = held[a], held.pop(b)
            far = second[-1] if second[0] == end else second[0]
            rest = iter(second) if second[0] == end else reversed(second)
            next(rest)
            (first.extend if first[-1] == end else first.extendleft)(rest)
            ends[far][:] = [a if k == b else k for k in ends[far]]
        held = {k: list(row) for k, row in held.items()}
        out = sorted(min(row, row[::-1]) for row in held.values())
        rows = [[{"x": x, "y": y} for x, y in row] for row in out]
        return pa.table({key: pa.array([keys[0].as_py()] * len(rows), table.schema.field(key).type), line: pa.array(rows, pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))})

    return lines.select(key, line).groupBy(key).applyInArrow(run, f"{key} {kind}, {line} array<{sp.POINT}>")


def in_polygons(points: DataFrame, polygons: DataFrame, x: str, y: str, ring: str, cell: float) -> DataFrame:
    """Points with each polygon that holds them. Polygons are copied to the cells that their box covers, so points meet theirs in an
    equi-join; ``cell`` should be about a polygon's size."""
    b = sp.box(F.col(ring))
    span = lambda lo, hi: F.sequence(F.floor(b[lo] / cell), F.floor(b[hi] / cell))
    cut = polygons.withColumn("_cx", F.explode(span("x1", "x2"))).withColumn("_cy", F.explode(span("y1", "y2")))
    met = points.withColumn("_cx", F.floor(F.col(x) / cell)).withColumn("_cy", F.floor(F.col(y) / cell)).join(cut, ["_cx", "_cy"])
    return met.where(sp.inside(sp.point(F.col(x), F.col(y)), F.col(ring))).drop("_cx", "_cy")


def moved(old: DataFrame, new: DataFrame, key: str, metres: float, away: Column) -> DataFrame:
    """What a fresh reading of sites means: (columns of ``new``, action): ``insert`` for sites that are new, moved by more than ``metres``
    or have another direction, ``update`` for names that changed in place. ``away`` is the distance of old_x, old_y and x, y; others are left out."""
    o = old.select(F.col(key).alias("_k"), F.col("x").alias("old_x"), F.col("y").alias("old_y"), F.col("direction").alias("_direction"), F.col("name").alias("_name"))
    met = new.join(o, F.col(key) == F.col("_k"), "left")
    fresh = F.col("_k").isNull() | (away > metres) | ~F.col("direction").eqNullSafe(F.col("_direction"))
    said = F.when(fresh, "insert").when(~F.col("name").eqNullSafe(F.col("_name")), "update")
    return met.withColumn("action", said).where("action is not null").select(*new.columns, "action")
