"""Operators on hand-made frames: boundaries, nulls, ties, chains, empty input."""

import datetime as dt

from pyspark.sql import functions as F

from curbline.functions.streets import abbreviate, title_case
from curbline.operators import changes, gaps, numbering, ranges, reshape, routing, stats

T = lambda s: dt.datetime.fromisoformat(s)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_gap_at_both_ends_and_over_midnight(spark):
    points = spark.createDataFrame([(1, T("2024-01-01T22:00")), (1, T("2024-01-02T03:00")), (2, T("2024-01-05T00:00"))], "k int, ts timestamp_ntz")
    got = rows(gaps.find_gaps(points, "k", "ts", "2024-01-01 00:00:00", "2024-01-03 00:00:00", 60, 120), "k", "gap_start", "gap_end")
    assert got == [(1, T("2024-01-01T00:00"), T("2024-01-01T22:00")), (1, T("2024-01-01T23:00"), T("2024-01-02T03:00")), (1, T("2024-01-02T04:00"), T("2024-01-03T00:00"))]


def test_gaps_of_nothing(spark):
    points = spark.createDataFrame([], "k int, ts timestamp_ntz")
    assert gaps.find_gaps(points, "k", "ts", "2024-01-01 00:00:00", "2024-01-03 00:00:00", 60, 120).count() == 0
    assert gaps.outages(points, "k", "ts", 15).count() == 0
    assert gaps.islands(points, "k", "ts", 15).count() == 0


def test_merge_closes_chains(spark):
    r = spark.createDataFrame([("a", 1, 3), ("a", 3, 5), ("a", 5, 9), ("a", 2, 8), ("a", 10, 11), ("b", 1, 2)], "k string, lo int, hi int")
    assert rows(ranges.merge_ranges(r, ["k"]), "k", "lo", "hi") == [("a", 1, 9), ("a", 10, 11), ("b", 1, 2)]


def test_cut_out_splits_in_the_middle(spark):
    r = spark.createDataFrame([(1, 10), (4, 6), (0, 5), (6, 9)], "lo int, hi int")
    assert rows(ranges.cut_out(r, "lo", "hi", F.lit(4), F.lit(6)), "lo", "hi") == [(0, 4), (1, 4), (6, 10), (6, 9)]


def test_overlap_check(spark):
    r = spark.createDataFrame([("a", 1, 5), ("a", 5, 7), ("a", 6, 8)], "k string, lo int, hi int")
    assert rows(ranges.overlaps(r, ["k"], "lo", "hi"), "lo") == [(6,)]


def test_asof_boundary_ties_and_missing(spark):
    facts = spark.createDataFrame([(1, 10, "x"), (1, 9, "y"), (2, 5, "z"), (None, 5, "n")], "k int, at int, name string")
    dims = spark.createDataFrame([(1, 10, "v2"), (1, 10, "v3"), (1, 3, "v1"), (3, 1, "v9")], "k int, since int, v string")
    assert rows(ranges.asof_join(facts, dims, "k", "at", "since", ["v"]), "name", "v") == [("n", None), ("x", "v3"), ("y", "v1"), ("z", None)]


def test_asof_end_of_validity(spark):
    facts = spark.createDataFrame([(1, k) for k in range(0, 14)], "k int, at int")
    dims = spark.createDataFrame([(1, 1, 12, "long"), (1, 4, 6, "short"), (1, 5, 5, "none"), (1, 9, None, "open")], "k int, since int, until int, v string")
    got = dict(rows(ranges.asof_join(facts, dims, "k", "at", "since", ["v"], "until"), "at", "v"))
    assert got == {0: None, **dict.fromkeys((1, 2, 3, 6, 7, 8), "long"), 4: "short", 5: "short", **dict.fromkeys(range(9, 14), "open")}


def test_wildcards(spark):
    day = lambda n: T(f"2024-01-{n:02}T12:00")
    facts = spark.createDataFrame([(1, "a", day(2)), (1, "b", day(9)), (2, "a", day(2)), (3, "c", day(2)), (2, "a", day(20)), (2, "a", None)], "k int, c string, ts timestamp_ntz")
    rules = spark.createDataFrame([(1, None, day(1), day(5)), (None, "c", day(1), None), (2, "b", day(1), None), (None, None, day(19), day(20)), (None, None, day(20), day(22))], "k int, c string, lo timestamp_ntz, hi timestamp_ntz")
    assert rows(ranges.wildcard_anti(facts, rules, ["k", "c"], "ts"), "k", "c", "ts") == [(1, "b", day(9)), (2, "a", None), (2, "a", day(2))]
    none = rules.where("k > 99")
    assert ranges.wildcard_anti(facts, none, ["k", "c"], "ts").count() == 6
    plan = ranges.wildcard_anti(facts, rules, ["k", "c"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan.replace("BroadcastNestedLoopJoin BuildRight, Cross", "").replace("BroadcastNestedLoopJoin BuildLeft, Cross", "").replace("BroadcastNestedLoopJoin BuildRight, Inner", "")


def test_replacement_chain_of_three(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8)], "a int, b int")
    assert rows(ranges.resolve_chain(links, "a", "b"), "old", "current", "hops") == [(1, 4, 3), (2, 4, 2), (3, 4, 1), (9, 8, 1)]
    circle = spark.createDataFrame([(1, 2), (2, 3), (3, 2), (7, None), (8, 7)], "a int, b int")
    assert rows(ranges.resolve_chain(circle, "a", "b"), "old", "current", "hops", "cyclic") == [(1, None, None, True), (2, None, None, True), (3, None, None, True), (7, 7, 0, False), (8, 7, 1, False)]


def test_upsert_audit_quarantine(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, None), (None, "m")], "k int, v string")
    assert rows(changes.upsert(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "c"), (3, None), (None, "m")]
    log = changes.audit(old, new.unionByName(old.where("k = 1")), ["k"])
    assert rows(log, "k", "action", "changed") == [(2, "U", ["v"]), (3, "I", []), (None, "U", ["v"])]
    assert changes.audit(old, old, ["k"]).count() == 0  # a null key is the same key
    gone = changes.merge(old, new, ["k"], delete_matched=F.col("v") == "c", delete_absent=F.col("v") == "a")
    assert rows(gone, "k", "v") == [(3, None), (None, "m")]
    assert rows(changes.insert_new(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "b"), (3, None), (None, "n")]
    good, bad = changes.quarantine(new.unionByName(new.where("k = 2")), ["k"])
    assert good.count() == 2 and bad.count() == 2


def test_movements_enter_and_leave(spark):
    m = spark.createDataFrame([(1, "N", 1, 5), (1, "E", 3, 2), (1, "S", 9, 4)], "node int, leg string, movement int, volume int")
    got = rows(reshape.movements_to_approaches(m, ["node"], "leg", "movement", "volume"), "leg", "dir", "volume")
    assert got == [("E", "WB", 2), ("N", "NB", 2), ("N", "SB", 5), ("S", "NB", 4), ("S", "SB", 5)]


def test_half_hours_follow_the_trend(spark):
    b = spark.createDataFrame([(1, T("2024-01-01T00:00"), 10.0), (1, T("2024-01-01T00:30"), 20.0), (1, T("2024-01-01T01:00"), 40.0)], "k int, bin timestamp_ntz, v double")
    got = [v for _, v in rows(reshape.split_half_hours(b, "k", "bin", "v"), "bin", "v")]
    assert [round(v, 3) for v in got] == [3.333, 6.667, 7.5, 12.5, 13.333, 26.667]


def test_interpolation_leaves_ends(spark):
    s = spark.createDataFrame([(1, 0, None), (1, 1, 10.0), (1, 2, None), (1, 4, 40.0), (1, 5, None)], "k int, x int, y double")
    assert rows(reshape.fill_linear(s, "k", "x", "y"), "x", "y") == [(0, None), (1, 10.0), (2, 20.0), (4, 40.0), (5, None)]


def test_weighted_percentile_and_harmonic(spark):
    r = spark.createDataFrame([("a", 1, 1), ("a", 2, 8), ("a", 3, 1)], "k string, v int, w int")
    assert rows(stats.weighted_percentiles(r, ["k"], "v", "w", [0.05, 0.5, 0.95]), "p5", "p50", "p95") == [(1, 2, 3)]
    assert r.agg(F.round(stats.harmonic_mean(F.col("v")), 6)).first()[0] == round(3 / (1 + 1 / 2 + 1 / 3), 6)


def test_streets(spark):
    names = ["Queen Street West", "The West Green", "Avenue Road", "Lake Shore Boulevard East", "Elm Grove Avenue", "Oak Park Gate (north side)", "Mount Pleasant Road", "Bay Avenue East", "Elm Road Crescent"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(abbreviate(F.col("n"))).collect()]
    assert got == ["Queen St W", "The West Green", "Avenue Rd", "Lake Shore Blvd E", "Elm Grove Ave", "Oak Park Gt ", "Mount Pleasant Rd", "Bay Ave E", "Elm Road Cres"]
    titles = spark.range(1).select(title_case(F.lit("UPPER-LOWER square")), title_case(F.lit("a POINT 5 METRES north west of o'brien ST")))
    assert tuple(titles.first()) == ("Upper-Lower Square", "A point 5 m Northwest of O'Brien St")


def test_serial_numbers_and_percentiles(spark):
    import random
    import statistics

    rnd = random.Random(1)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([None, *range(40)])) for _ in range(500)] + [("c", 7), ("d", None)]
    df = spark.createDataFrame([(k, g, v) for k, (g, v) in enumerate(data)], "id long, g string, v int").repartition(5)
    numbered = rows(numbering.serial(df, ["id"], "n", 10), "id", "n")
    assert sorted(numbered) == [(k, k + 10) for k in range(len(data))]
    got = {r.g: (r.p0, r.p37, r.p50, r.p100) for r in stats.percentiles(df, ["g"], "v", {"p0": 0.0, "p37": 0.37, "p50": 0.5, "p100": 1.0}).collect()}
    for g in ("a", "b", "c", None):
        some = sorted(v for k, v in data if k == g and v is not None)
        place = 0.37 * (len(some) - 1)
        at = some[int(place)] + (place - int(place)) * (some[min(int(place) + 1, len(some) - 1)] - some[int(place)])
        assert got[g] == (some[0], at, statistics.median(some), some[-1]) or abs(got[g][1] - at) < 1e-9
    assert got.keys() == {"a", "b", "c", None}


def test_routes():
    edges = [(1, "a", "b", 1.0), (2, "b", "c", 1.0), (3, "a", "c", 5.0), (4, "c", "d", 1.0)]
    assert routing.route(edges, "a", "d") == [1, 2, 4]
    assert routing.route(edges, "a", "d", banned=[(1, 2)]) == [3, 4]
    assert routing.route(edges, "d", "a") is None
