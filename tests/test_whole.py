"""Queries over whole tables, and routes of any length, against brute force."""

import datetime as dt
import heapq

import pytest

from curbline.operators import routing
from curbline.plans import registry, traffic

SF = "/root/testdata/sf0.001"


def dijkstra(edges, start):
    out, best, queue = {}, {}, [(0, start)]
    for a, b, c in edges:
        out.setdefault(a, []).append((b, c))
    while queue:
        cost, node = heapq.heappop(queue)
        if node not in best:
            best[node] = cost
            for to, c in out.get(node, ()):
                heapq.heappush(queue, (cost + c, to))
    return best


def test_routes_of_more_than_64_edges(spark):
    edges = [(k, k + 1, 1 + k % 3) for k in range(68)] + [(0, 30, 500), (10, 5, 1)]
    got = routing.distances(spark.createDataFrame(edges, "source long, target long, cost long").coalesce(1), spark.createDataFrame([(0,)], "node long"))
    assert {r.node: r.cost for r in got.collect()} == dijkstra(edges, 0)


def test_negative_cycles_raise(spark):
    edges = spark.createDataFrame([(0, 1, 1), (1, 0, -2)], "source long, target long, cost long")
    with pytest.raises(ValueError):
        routing.distances(edges, spark.createDataFrame([(0,)], "node long"))


def test_all_edges_count(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").collect()
    edges = [(r.o_custkey % 40, r.o_orderkey % 40, int(r.o_totalprice + 0.5) % 900 + 100) for r in orders if r.o_custkey % 40 != r.o_orderkey % 40]
    assert traffic.path_edges(spark, SF).count() == len({e[:2] for e in edges})
    assert {r.node: r.cost for r in registry.QUERIES["shortest_paths"].run(spark, SF).collect()} == dijkstra(edges, 0)


def test_legs_of_all_customers(spark):
    arms, want = {}, set()
    for r in spark.read.parquet(f"{SF}/customer.parquet").collect():
        arms.setdefault(r.c_nationkey, []).append((r.c_custkey, r.c_custkey * 37 % 360))
    for node, some in arms.items():
        off = lambda az, at: min(abs(az - at) % 360, 360 - abs(az - at) % 360)
        left = sorted((off(az, (343 + 90 * k) % 360), arm, k) for arm, az in some for k in range(4))
        while left:
            _, arm, k = left[0]
            want.add((node, arm, "NESW"[k]))
            left = [x for x in left if x[1] != arm and x[2] != k]
    assert max(map(len, arms.values())) > 4
    assert {tuple(r) for r in registry.QUERIES["cardinal_legs"].run(spark, SF).select("node", "arm", "leg").collect()} == want


def test_whole_queries_take_all_rows(spark):
    run = lambda name: registry.QUERIES[name].run(spark, SF)
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    orders, customers = read("orders").collect(), {r.c_custkey for r in read("customer").collect()}
    assert {r.seg for r in run("speed_sections").collect()} == {r.o_custkey for r in orders}
    assert {r.c_custkey for r in run("nearest_site").collect()} == customers
    assert {r.c_custkey for r in run("lateral_top").collect()} == {r.o_custkey for r in orders} & customers
    assert run("levenshtein_names").count() == read("part").count() * read("nation").count()
    bins = {}
    for r in read("events").collect():
        bins.setdefault(r.user_id, set()).add(r.ts.replace(minute=r.ts.minute // 15 * 15, second=0, microsecond=0))
    step, lo, hi = dt.timedelta(minutes=15), min(map(min, bins.values())), max(map(max, bins.values()))
    want = set()
    for k, some in bins.items():
        begun = [lo, *(b + step for b in sorted(some))]
        want |= {(k, a, b) for a, b in zip(begun, [*sorted(some), hi + step]) if b - a >= dt.timedelta(hours=24)}
    assert {(r.user_id, r.gap_start, r.gap_end) for r in run("generic_gaps").collect()} == want
    assert run("gap_summary").first().gaps == len(want)
    n = {k: 0 for k in bins}
    for r in read("events").collect():
        n[r.user_id] += 1
    tolerance = lambda k: 1440 if n[k] >= 60 else 2000 if n[k] >= 40 else 3000
    assert {r.user_id for r in run("unacceptable_gaps").collect()} == {k for k, a, b in want if (b - a).total_seconds() / 60 >= tolerance(k)}


def test_routes_are_cheapest_and_connected(spark):
    edges = {(r.source, r.target): r.cost for r in traffic.path_edges(spark, SF).collect()}
    best = dijkstra([(a, b, c) for (a, b), c in edges.items()], 0)
    got = {r.node: r for r in registry.QUERIES["routes"].run(spark, SF).collect()}
    assert {k: r.cost for k, r in got.items()} == best
    for k, r in got.items():
        assert r.route[0] == 0 and r.route[-1] == k and sum(edges[step] for step in zip(r.route, r.route[1:])) == r.cost


def test_bans_by_search_over_edges(spark):
    edges = [(1, 0, 1, 5), (2, 1, 2, 5), (3, 0, 2, 30), (4, 2, 3, 1), (5, 1, 3, 50)]
    bans = spark.createDataFrame([(1, 2), (3, 4)], "first long, second long")
    got = routing.distances_with_bans(spark.createDataFrame(edges, "id long, source long, target long, cost long"), bans, spark.createDataFrame([(0,)], "node long"), 9999)
    for node, cost in ((1, 5), (2, 30), (3, 55)):
        path = routing.route([(i, a, b, c) for i, a, b, c in edges], 0, node, [(1, 2), (3, 4)])
        assert {r.node: r.cost for r in got.collect()}[node] == cost == sum(c for i, *_, c in edges if i in path)


def test_event_duplicates_by_all_pairs(spark):
    from curbline.operators.textmatch import partial_ratio

    assert partial_ratio("summer fest", "The summer fest!") == 100 and partial_ratio("", "") == 100 and partial_ratio("", "a") == 0
    rows = [(r.o_orderkey, r.o_orderdate.date(), r.o_custkey % 5, r.o_orderdate.hour, f"{['winter', 'summer', 'harvest'][r.o_orderkey % 3]} festival number {r.o_orderkey % 7}") for r in spark.read.parquet(f"{SF}/orders.parquet").collect()]
    name = lambda k, n: f"The {n}!" if k % 2 == 0 else n
    by = {}
    for k, *block, n in rows:
        by.setdefault(tuple(block), []).append((k, name(k, n)))
    want = {(a, b): partial_ratio(x, y) for some in by.values() for a, x in some for b, y in some if a % 2 == 0 and b % 2 == 1}
    want = {k: v for k, v in want.items() if v > 90}
    events = registry.QUERIES["event_duplicates"].run(spark, SF).collect()
    assert sorted(r.o_orderkey for r in events) == sorted(r[0] for r in rows)
    copies = {}
    for r in events:
        copies.setdefault(r.copy_of, []).append(r.o_orderkey)
    got = {(a, b): x.ratio for r in events if r.o_orderkey % 2 == 0 for x in r.alike or () for a in copies[r.copy_of] for b in copies[x.copy_of]}
    assert got and got == want
    assert {r.o_orderkey: r.links for r in events} == {r[0]: sum(r[0] in pair for pair in want) for r in rows}


def test_near_pairs_lose_none(spark):
    import random

    from curbline.operators.textmatch import near_pairs

    rnd = random.Random(3)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9))) for _ in range(120)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    names, targets = set(words[:60]), set(words[60:])
    for most in (0, 1, 3):
        got = near_pairs(spark.createDataFrame([(w,) for w in names], "n string"), spark.createDataFrame([(w,) for w in targets], "t string"), "n", "t", most)
        assert {(r.n, r.t): r.distance for r in got.collect()} == {(a, b): d for a in names for b in targets if (d := distance(a, b)) <= most}
