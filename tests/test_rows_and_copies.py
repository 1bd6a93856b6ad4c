"""Queries on odd values and on many copies, against their SQL or brute force."""

import datetime as dt

import compare
import duckdb
from pyspark.sql import functions as F

from curbline.functions import spatial as sp
from curbline.operators import lines, network
from curbline.plans import registry


def held(spark, tmp_path, name: str, **tables) -> str:
    """Differences of a query from its SQL over small tables."""
    c = duckdb.connect()
    for t, df in tables.items():
        df.write.parquet(f"{tmp_path}/{t}.parquet")
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    return compare.differences(registry.QUERIES[name].run(spark, str(tmp_path)), c, registry.QUERIES[name].sql)


def test_a_speed_of_zero_makes_the_harmonic_mean_zero(spark, tmp_path):
    at = lambda day, hour: dt.datetime(2024, 1, day, hour, 5)
    rows = [(1, at(9, 8), 0.0), (1, at(9, 8), 40.0), (1, at(10, 8), 30.0), (2, at(9, 8), 20.0), (2, at(9, 8), None), (2, at(10, 8), 50.0), (3, at(9, 7), 0.0), (4, at(9, 7), None), (4, at(10, 7), 12.0)]
    assert held(spark, tmp_path, "harmonic_speed", events=spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, value double")) == ""


def test_rings_are_clipped_once_for_all_uses(spark):
    ring = lambda x, y: F.array(sp.point(F.lit(x), F.lit(y)), sp.point(F.lit(x + 4), F.lit(y)), sp.point(F.lit(x + 4), F.lit(y + 3)), sp.point(F.lit(x), F.lit(y + 3)))
    a, b, far = ring(0, 0), ring(1, 1), ring(9, 9)
    cut = spark.range(1).select(sp.area(sp.intersection(a, b)), sp.total_area(sp.difference(a, b)), sp.total_area(sp.union(a, b)), sp.overlaps(a, b), sp.overlaps(a, a), sp.contains(a, a), sp.intersects(a, far), sp.total_area(sp.difference(a, far)))
    assert tuple(cut.first()) == (6.0, 6.0, 18.0, True, False, True, False, 12.0)
    text = sp.area(sp.intersection(a, b))._jc.toString()
    assert text.lower().count("aggregate") <= 2  # one for the cuts and one for the area


def test_nearest_compares_places(spark):
    """40,000 points at two places: pairs of points would be some hundred millions."""
    p = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, -79.5).otherwise(-79.499).alias("lon"), F.lit(43.6).alias("lat"))
    t = p.withColumnRenamed("id", "site").where("site > 1")
    met = network.nearest(p, t, "id", "site", 0.025, F.hypot(F.col("lon") - F.col("t_lon"), F.col("lat") - F.col("t_lat")))
    assert {tuple(r) for r in met.groupBy(F.col("id") % 2, "site", "metres").count().collect()} == {(0, 2, 0.0, 20_000), (1, 3, 0.0, 20_000)}


def test_long_streets_are_merged_in_little_time(spark):
    """20,000 pieces in turned order, all of one street, with a ring beside it."""
    piece = lambda a, b: [{"x": float(x), "y": float(y)} for x, y in (a, b)]
    pieces = [(1, piece((k, 0), (k + 1, 0)) if k % 2 else piece((k + 1, 0), (k, 0))) for k in range(20_000)]
    ring = [(2, piece((0, 0), (0, 1))), (2, piece((1, 1), (0, 1))), (2, piece((1, 1), (1, 0))), (2, piece((0, 0), (1, 0)))]
    begun = dt.datetime.now()
    got = {r.key: [(p.x, p.y) for p in r.line] for r in lines.merge_lines(spark.createDataFrame(pieces[::-1] + ring, f"key long, line array<{sp.POINT}>"), "key", "line").collect()}
    assert got[1] == [(float(k), 0.0) for k in range(20_001)]
    assert len(got[2]) == 5 and got[2][0] == got[2][-1]
    assert (dt.datetime.now() - begun).total_seconds() < 60


def test_one_text_of_many_rows_is_cut_once(spark):
    said = [("Nation 1 Road", "Between Birch Avenue and Cedar Avenue", None)] * 3 + [("Birch Avenue", "Entire length", None), (None, "Birch Avenue", "Cedar Avenue")]
    rows = spark.createDataFrame([(k, *t) for k, t in enumerate(said)], "id long, highway string, start string, end string")
    line = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    streets = spark.createDataFrame([(1, "Nation 1 Rd", line((0, 0), (200, 0))), (2, "Nation 1 Rd", line((200, 0), (400, 0))), (3, "Birch Ave", line((0, 0), (0, 100))), (4, "Cedar Ave", line((200, 0), (200, 100)))], f"segment long, street string, line array<{sp.POINT}>")
    got = network.texts_to_segments(rows, "id", "highway", "start", "end", streets)
    assert sorted((r.id, r.segment, r.lo, r.hi) for r in got.collect()) == [(0, 1, 0.0, 1.0), (1, 1, 0.0, 1.0), (2, 1, 0.0, 1.0), (3, 3, 0.0, 1.0)]


def test_events_with_nulls_are_alone_and_copies_are_not_expanded(spark):
    from curbline.operators import textmatch

    a = spark.createDataFrame([(1, 5, "summer fest"), (2, 5, "summer fest"), (3, None, "summer fest"), (4, 5, None)], "k long, day int, name string")
    b = spark.createDataFrame([(7, 5, "The summer fest!"), (8, 5, "The summer fest!"), (9, 6, "summer fest")], "k long, day int, name string")
    got = {r.k: (r.copy_of, r.links, [tuple(x) for x in r.alike or ()]) for r in textmatch.event_classes(a, b, "k", ["day"], "name", 90).collect()}
    assert got == {1: (1, 2, [(7, 100)]), 2: (1, 2, []), 3: (3, 0, []), 4: (4, 0, []), 7: (7, 2, [(1, 100)]), 8: (7, 2, []), 9: (9, 0, [])}
