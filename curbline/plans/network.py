"""Queries over streets, nodes and registers."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from curbline.functions import geometry as geo
from curbline.functions import spatial as sp
from curbline.functions.streets import title_case
from curbline.operators import network, routing, stats, textmatch
from curbline.operators.numbering import serial
from curbline.operators.reshape import exit_volumes
from curbline.plans.registry import register
from curbline.plans.traffic import _XY, _points, path_edges
from curbline.session import checkpointed
from curbline.sources.tables import table


@register("nearest_site", f"""
    WITH p AS (SELECT c_custkey, {_XY} FROM customer), t AS (SELECT c_custkey AS site, lon AS x, lat AS y FROM p),
    m AS (SELECT c_custkey, site, 2 * 6371008.8 * asin(sqrt(pow(sin(radians(y - lat) / 2), 2) + cos(radians(lat)) * cos(radians(y)) * pow(sin(radians(x - lon) / 2), 2))) AS d FROM p CROSS JOIN t WHERE abs(x - lon) <= 0.05 AND abs(y - lat) <= 0.05)
    SELECT c_custkey, arg_min(site, (d, site)) AS site, round(min(d), 3) AS metres FROM m GROUP BY 1 HAVING min(d) < 1500""", "D12 KNN")
def q_nearest(spark, sf_dir):
    """Every customer is a site too, so the nearest site stands at the customer's own place."""
    p = _points(spark, sf_dir)
    found = network.nearest(p, p.withColumnRenamed("c_custkey", "site"), "c_custkey", "site", 0.025, geo.haversine(F.col("lon"), F.col("lat"), F.col("t_lon"), F.col("t_lat")))
    return found.where("metres < 1500").select("c_custkey", "site", F.round("metres", 3).alias("metres"))


@register("cardinal_legs", """
    WITH a AS (SELECT c_nationkey AS node, c_custkey AS arm, (c_custkey * 37) % 360 AS az FROM customer),
    p AS (SELECT node, arm, leg, rank, least(abs(az - facing) % 360, 360 - abs(az - facing) % 360) AS off FROM a CROSS JOIN (VALUES ('N', 343, 0), ('E', 73, 1), ('S', 163, 2), ('W', 253, 3)) l(leg, facing, rank)),
    r1 AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY node ORDER BY off, arm, rank) = 1),
    p2 AS (SELECT p.* FROM p WHERE NOT EXISTS (SELECT 1 FROM r1 WHERE r1.node = p.node AND (r1.arm = p.arm OR r1.leg = p.leg))), r2 AS (SELECT * FROM p2 QUALIFY row_number() OVER (PARTITION BY node ORDER BY off, arm, rank) = 1),
    p3 AS (SELECT p.* FROM p2 p WHERE NOT EXISTS (SELECT 1 FROM r2 WHERE r2.node = p.node AND (r2.arm = p.arm OR r2.leg = p.leg))), r3 AS (SELECT * FROM p3 QUALIFY row_number() OVER (PARTITION BY node ORDER BY off, arm, rank) = 1),
    p4 AS (SELECT p.* FROM p3 p WHERE NOT EXISTS (SELECT 1 FROM r3 WHERE r3.node = p.node AND (r3.arm = p.arm OR r3.leg = p.leg))), r4 AS (SELECT * FROM p4 QUALIFY row_number() OVER (PARTITION BY node ORDER BY off, arm, rank) = 1)
    SELECT node, arm, leg FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r4)""", "F11")
def q_legs(spark, sf_dir):
    """Nodes have more arms than labels; arms beyond four get none."""
    arms = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", (F.col("c_custkey") * 37 % 360).cast("double").alias("az"))
    return network.legs(arms, "c_nationkey", "c_custkey", "az")


@register("network_at_time", """
    WITH l AS (SELECT DISTINCT user_id AS link, CAST(100 + user_id AS DOUBLE) AS length FROM events),
    o AS (SELECT user_id AS link, avg(value) AS speed FROM events WHERE ts >= TIMESTAMP '2024-01-10 08:00:00' AND ts < TIMESTAMP '2024-01-10 10:00:00' GROUP BY 1),
    p AS (SELECT user_id AS link, quantile_cont(value, 0.5) AS speed FROM events WHERE hour(ts) BETWEEN 8 AND 9 AND isodow(ts) = 3 GROUP BY 1)
    SELECT link, round(3.6 * length / coalesce(nullif(o.speed, 0), p.speed), 6) AS seconds FROM l LEFT JOIN o USING (link) LEFT JOIN p USING (link) WHERE coalesce(nullif(o.speed, 0), p.speed) > 0""", "F9")
def q_network(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "link")
    at = lambda t: F.lit(f"2024-01-10 {t}:00:00").cast("timestamp_ntz")
    observed = e.where((F.col("ts") >= at("08")) & (F.col("ts") < at("10"))).groupBy("link").agg(F.avg("value").alias("speed"))
    pattern = e.where(F.hour("ts").between(8, 9) & (F.weekday("ts") == 2)).groupBy("link").agg(F.percentile("value", F.lit(0.5)).alias("speed"))
    links = e.select("link").distinct().withColumn("length", (100 + F.col("link")).cast("double"))
    return network.network_costs(links, observed, pattern).select("link", F.round("seconds", 6).alias("seconds"))


_BYLAWS = "SELECT o_custkey AS seg, o_orderkey AS num, (o_orderkey % 8) / 10.0 AS lo, (o_orderkey % 8 + 2) / 10.0 AS hi, 30 + 10 * CAST(o_orderkey % 4 AS INTEGER) AS speed FROM orders"


@register("speed_sections", f"""
    WITH b AS ({_BYLAWS}), c AS (SELECT DISTINCT seg, unnest([0.0, lo, hi, 1.0]) AS a FROM b), s AS (SELECT seg, a, lead(a) OVER (PARTITION BY seg ORDER BY a) AS z FROM c),
    v AS (SELECT s.seg, s.a, s.z, coalesce(arg_max(speed, num), 50) AS speed FROM s LEFT JOIN b ON b.seg = s.seg AND b.lo <= s.a AND b.hi >= s.z WHERE s.z IS NOT NULL GROUP BY ALL),
    t AS (SELECT *, CASE WHEN lag(speed) OVER w = speed THEN 0 ELSE 1 END AS turn FROM v WINDOW w AS (PARTITION BY seg ORDER BY a)), r AS (SELECT *, sum(turn) OVER (PARTITION BY seg ORDER BY a) AS run FROM t)
    SELECT seg, CAST(min(a) AS DOUBLE) AS lo, CAST(max(z) AS DOUBLE) AS hi, speed FROM r GROUP BY seg, run, speed""", "F15 range difference")
def q_sections(spark, sf_dir):
    b = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("seg"), F.col("o_orderkey").alias("num"), (F.col("o_orderkey") % 8 / 10.0).cast("double").alias("lo"), ((F.col("o_orderkey") % 8 + 2) / 10.0).cast("double").alias("hi"), (30 + 10 * (F.col("o_orderkey") % 4)).cast("int").alias("speed"))
    return network.sections(b, "seg", "lo", "hi", "num", "speed", 50)


#: Names of the avenues from west to east: fixed values of the test grid.
AVENUES = ["Ash", "Birch", "Cedar", "Dogwood", "Elm"]
#: Descriptions of stretches of streets, with what the parts of each are: (highway, from, to, parsed highway, street, metres and direction of either end).
TEXTS = [
    ("Nation {a} Road", "Between Birch Avenue and Dogwood Avenue", None, "Nation {a} Rd", "Birch Ave", None, None, "Dogwood Ave", None, None),
    ("NATION {a} ROAD", "Ash Avenue", "A point 50 metres east of Cedar Avenue", "Nation {a} Rd", "Ash Ave", None, None, "Cedar Ave", 50.0, "east"),
    ("Nation {a} Road", "Birch Avenue", "a point 80.5 metres west thereof", "Nation {a} Rd", "Birch Ave", None, None, "Birch Ave", 80.5, "west"),
    ("Nation {a} Road", "A point 20 metres east of Ash Avenue and a point 30 metres west of Dogwood Avenue", None, "Nation {a} Rd", "Ash Ave", 20.0, "east", "Dogwood Ave", 30.0, "west"),
    ("Cedar Avenue", "Nation 0 Road (north end) to Nation {a} Road/Main Street", None, "Cedar Ave", "Nation 0 Rd", None, None, "Nation {a} Rd", None, None),
    ("Birch Avenue", "Entire length", None, "Birch Ave", "Entire Length", None, None, None, None, None),
    ("Nation {a} Raod", "Brich Avenue", "Elm Avenue", "Nation {a} Raod", "Brich Ave", None, None, "Elm Ave", None, None),
    ("Nowhere Crescent", "Birch Avenue", "Cedar Avenue", "Nowhere Cres", "Birch Ave", None, None, "Cedar Ave", None, None),
]


def _sql(x) -> str:
    return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)


def _described(spark, sf_dir):
    """A description for each order: text by its number, street by its customer's."""
    texts = spark.createDataFrame([(k, *t[:3]) for k, t in enumerate(TEXTS)], "kind long, highway string, start string, end string")
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % len(TEXTS)).alias("kind"), (F.col("o_custkey") % 24 + 1).cast("string").alias("a"))
    named = [F.replace(F.col(c), F.lit("{a}"), F.col("a")).alias(c) for c in ("highway", "start", "end")]
    return o.join(F.broadcast(texts), "kind").select("o_orderkey", "kind", *named)


_PARTS = ["highway2", "btwn1", "metres_btwn1", "direction_btwn1", "btwn2", "metres_btwn2", "direction_btwn2"]


@register("bylaw_texts", f"""
    WITH t(kind, {", ".join(_PARTS)}) AS (VALUES {", ".join(f"({k}, {', '.join(map(_sql, x[3:]))})" for k, x in enumerate(TEXTS))})
    SELECT o_orderkey, {", ".join(f"replace({c}, '{{a}}', CAST(o_custkey % 24 + 1 AS VARCHAR)) AS {c}" if "metres" not in c and "direction" not in c else f"CAST({c} AS {'DOUBLE' if 'metres' in c else 'VARCHAR'}) AS {c}" for c in _PARTS)}
    FROM orders JOIN t ON t.kind = o_orderkey % {len(TEXTS)}""", "F3")
def q_bylaws(spark, sf_dir):
    return network.bylaw_parts(_described(spark, sf_dir), "highway", "start", "end").select("o_orderkey", *_PARTS)


def _streets(spark, sf_dir):
    """A grid of streets: a road every 100 metres to the north, an avenue every 200 to the east, cut into a segment between each two."""
    n, r = table(spark, sf_dir, "nation").select("n_nationkey"), table(spark, sf_dir, "region").select("r_regionkey")
    cross = n.join(r, how="cross")
    x, y = (F.col("r_regionkey") * 200).cast("double"), (F.col("n_nationkey") * 100).cast("double")
    roads = cross.where("r_regionkey < 4").select((F.col("n_nationkey") * 10 + F.col("r_regionkey")).cast("long").alias("segment"), F.format_string("Nation %d Rd", "n_nationkey").alias("street"), F.array(sp.point(x, y), sp.point(x + 200, y)).alias("line"))
    avenues = cross.where("n_nationkey < 24").select((1000 + F.col("n_nationkey") * 10 + F.col("r_regionkey")).cast("long").alias("segment"), F.concat(F.element_at(F.array(*[F.lit(x) for x in AVENUES]), (F.col("r_regionkey") + 1).cast("int")), F.lit(" Ave")).alias("street"), F.array(sp.point(x, y), sp.point(x, y + 100)).alias("line"))
    return roads.unionByName(avenues)


@register("text_to_segments", """
    WITH o AS (SELECT o_orderkey, o_orderkey % 8 AS kind, o_custkey % 24 + 1 AS a FROM orders),
    s AS (SELECT o_orderkey, kind, a, x.lo, x.hi FROM o JOIN (VALUES (0, 200.0, 600.0), (1, 0.0, 400 + 50 * cos(radians(17))), (2, 200 - 80.5 * cos(radians(17)), 200.0), (3, 20 * cos(radians(17)), 600 - 30 * cos(radians(17))), (6, 200.0, 800.0)) x(k, lo, hi) ON kind = k),
    r AS (SELECT o_orderkey, kind, a * 10 + i AS segment, 'Nation ' || a || ' Rd' AS street, greatest(lo - i * 200, 0) / 200 AS lo, least(hi - i * 200, 200) / 200 AS hi FROM s CROSS JOIN (VALUES (0), (1), (2), (3)) g(i)),
    v AS (SELECT o_orderkey, kind, 1002 + i * 10 AS segment, 'Cedar Ave' AS street, 0.0 AS lo, 1.0 AS hi FROM o CROSS JOIN (SELECT unnest(range(24)) AS i) WHERE kind = 4 AND i < a
      UNION ALL SELECT o_orderkey, kind, 1001 + i * 10, 'Birch Ave', 0.0, 1.0 FROM o CROSS JOIN (SELECT unnest(range(24)) AS i) WHERE kind = 5)
    SELECT o_orderkey, segment, street, round(lo, 6) AS lo, round(hi, 6) AS hi, CASE kind WHEN 5 THEN 'Maybe (Entire length of road)' WHEN 6 THEN 'Low (6 character difference)' ELSE 'Very High (100% match)' END AS confidence, CASE WHEN kind <> 5 THEN CASE kind WHEN 6 THEN 6 ELSE 0 END END AS lev_sum
    FROM (SELECT * FROM r WHERE hi - lo > 1e-9 UNION ALL SELECT * FROM v)""", "F4 F5 F6")
def q_segments(spark, sf_dir):
    """All four branches: entire length, two intersections, one and an offset, two and offsets; misspelt streets, and one that isn't there."""
    found = network.texts_to_segments(_described(spark, sf_dir), "o_orderkey", "highway", "start", "end", _streets(spark, sf_dir))
    return found.select("o_orderkey", "segment", "street", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "confidence", "lev_sum")


@register("match_confidence", """
    SELECT p_partkey, CASE WHEN p_size > 45 THEN 'No Match' WHEN p_size % 7 = 0 THEN 'Very High (100% match)' WHEN p_size % 7 = 1 THEN 'High (1 character difference)' WHEN p_size % 7 <= 3 THEN 'Medium (' || p_size % 7 || ' character difference)' ELSE 'Low (' || p_size % 7 || ' character difference)' END AS confidence FROM part""")
def q_confidence(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", network.confidence(F.when(F.col("p_size") <= 45, F.col("p_size") % 7)).alias("confidence"))


#: Posted schedules, with their days and spans in minutes.
SCHEDULES = [
    ("7:00 a.m. to 6:00 p.m., Monday to Friday", [1, 2, 3, 4, 5], [(420, 1080)]), ("9 a.m. to 5 p.m. Saturday and Sunday", [6, 7], [(540, 1020)]), ("Anytime", [1, 2, 3, 4, 5, 6, 7], [(0, 1440)]),
    ("7:30 a.m. to 9:30 a.m. and 3:30 p.m. to 6:30 p.m., Mon. to Fri., except weekdays off", [1, 2, 3, 4, 5], [(450, 570), (930, 1110)]), ("10:00 p.m. to 6:00 a.m., Friday to Monday", [1, 5, 6, 7], [(1320, 1800)]),
]


@register("schedules", f"""
    WITH t(k, days, spans) AS (VALUES {", ".join(f"({k}, {d}, '{'; '.join(f'{a}-{z}' for a, z in t)}')" for k, (_, d, t) in enumerate(SCHEDULES))})
    SELECT p_partkey, days, spans FROM part JOIN t ON k = p_size % {len(SCHEDULES)}""", "F19")
def q_schedules(spark, sf_dir):
    texts = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(SCHEDULES)], "k int, text string")
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % len(SCHEDULES)).alias("k")).join(F.broadcast(texts), "k")
    spans = F.array_join(F.transform(network.schedule_times(F.col("text")), lambda s: F.concat_ws("-", s["begin"].cast("string"), s["end"].cast("string"))), "; ")
    return p.select("p_partkey", network.schedule(F.col("text")).alias("days"), spans.alias("spans"))


_AZ = "(c_custkey * 7) % 360"


@register("segment_directions", f"""
    WITH a AS (SELECT c_custkey, {_AZ} AS az FROM customer), o AS (SELECT c_custkey, az, d, least(abs(az - f) % 360, 360 - abs(az - f) % 360) AS off FROM a CROSS JOIN (VALUES ('NB', 343), ('EB', 73), ('SB', 163), ('WB', 253)) x(d, f)),
    m AS (SELECT c_custkey, arg_max(d, (-off, strpos('NB,EB,SB,WB', d))) AS direction, min(off) AS off FROM o GROUP BY 1), e AS (SELECT c_custkey, off AS eb FROM o WHERE d = 'EB')
    SELECT c_custkey, CASE WHEN off < 40 THEN direction END AS direction, CAST(off AS DOUBLE) AS off, CASE WHEN eb < 80 THEN 'forward' WHEN eb > 100 THEN 'backward' END AS eastbound FROM m JOIN e USING (c_custkey)""", "F12")
def q_directions(spark, sf_dir):
    az = (F.col("c_custkey") * 7 % 360).cast("double")
    said, off = network.segment_directions(az)
    return table(spark, sf_dir, "customer").select("c_custkey", said.alias("direction"), off.alias("off"), network.along_segment(az, F.lit("EB")).alias("eastbound"))


@register("intersection_classes", """
    WITH e AS (SELECT c_nationkey AS node, c_mktsegment AS f FROM customer UNION ALL SELECT c_custkey % 300, c_mktsegment FROM customer), r(f, k) AS (VALUES ('MACHINERY', 0), ('BUILDING', 1), ('AUTOMOBILE', 2)),
    d AS (SELECT node, f, coalesce(any_value(k), 3) AS k FROM e LEFT JOIN r USING (f) GROUP BY ALL)
    SELECT node, any_value(n) AS degree, list(f ORDER BY k, f) AS features, arg_min(f, (k, f)) AS class FROM d JOIN (SELECT node, count(*) AS n FROM e GROUP BY 1) USING (node) GROUP BY node""", "F13")
def q_classes(spark, sf_dir):
    edges = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("source"), (F.col("c_custkey") % 300).alias("target"), F.col("c_mktsegment").alias("feature"))
    return network.intersection_classes(edges, ["MACHINERY", "BUILDING", "AUTOMOBILE"])


@register("routes_with_bans", """
    WITH RECURSIVE e AS (SELECT row_number() OVER (ORDER BY a, b) AS id, a, b, cost FROM (SELECT o_custkey % 40 AS a, o_orderkey % 40 AS b, min(CAST(round(o_totalprice) AS BIGINT) % 900 + 100) AS cost FROM orders WHERE o_custkey % 40 <> o_orderkey % 40 GROUP BY 1, 2)),
    t AS (SELECT x.id AS i, y.id AS j, y.cost + CASE WHEN (x.id + y.id) % 3 = 0 THEN 9999 ELSE 0 END AS cost FROM e x JOIN e y ON x.b = y.a),
    p(edge, cost) USING KEY (edge) AS (SELECT id, cost FROM e WHERE a = 0 UNION SELECT t.j, min(p.cost + t.cost) FROM p JOIN t ON t.i = p.edge LEFT JOIN recurring.p r ON r.edge = t.j WHERE r.cost IS NULL OR p.cost + t.cost < r.cost GROUP BY t.j)
    SELECT b AS node, CAST(min(p.cost) AS BIGINT) AS cost FROM p JOIN e ON e.id = p.edge GROUP BY b""", "F8 pgr_trsp")
def q_bans(spark, sf_dir):
    """Costs of all nodes from node 0 where some turns are banned: two edges whose numbers add up to a multiple of three."""
    edges = checkpointed(serial(path_edges(spark, sf_dir), ["source", "target"], "id"))
    turns = edges.alias("x").join(edges.alias("y"), F.col("x.target") == F.col("y.source")).where("(x.id + y.id) % 3 = 0").select(F.col("x.id").alias("first"), F.col("y.id").alias("second"))
    return routing.distances_with_bans(edges, turns, spark.createDataFrame([(0,)], "node long"), 9999).select("node", "cost")


@register("routes", covers="F7 path")
def q_routes(spark, sf_dir):
    """The nodes of a cheapest route from node 0 to each node, in order; held against a search of the whole graph by tests."""
    return routing.routes(checkpointed(path_edges(spark, sf_dir)), spark.createDataFrame([(0,)], "node long"))


@register("paired_directions", """
    WITH l AS (SELECT user_id % 3 AS street, user_id % 5 AS a, CAST(floor(user_id / 5) AS BIGINT) % 5 AS b, avg(value + 5) AS speed FROM events GROUP BY ALL)
    SELECT x.street, x.a, x.b, round(x.speed, 6) AS speed, round(y.speed, 6) AS back, round(x.speed / y.speed, 6) AS ratio, CASE WHEN x.speed > y.speed THEN 'forward' WHEN x.speed < y.speed THEN 'back' END AS bias
    FROM l x JOIN l y ON x.street = y.street AND x.a = y.b AND x.b = y.a WHERE x.a < x.b""", "D11")
def q_paired(spark, sf_dir):
    u = F.col("user_id")
    l = table(spark, sf_dir, "events").groupBy((u % 3).alias("street"), (u % 5).alias("a"), (F.floor(u / 5) % 5).alias("b")).agg(F.avg(F.col("value") + 5).alias("speed"))
    both = stats.paired_ratio(checkpointed(l), ["street"], "a", "b", "speed").where("a < b")
    return both.select("street", "a", "b", F.round("speed", 6).alias("speed"), F.round("back", 6).alias("back"), F.round("ratio", 6).alias("ratio"), "bias")


@register("event_duplicates", covers="D9")
def q_event_duplicates(spark, sf_dir):
    """Events of two lists that are one: same day, time and venue, and names alike. Copies, events of one list that agree in all, are
    not expanded into pairs: a row for each event with its class and the number of its links, and the links of classes at the event that stands for each; held against a comparison of all pairs by tests."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), (F.col("o_custkey") % 5).alias("venue"), F.hour("o_orderdate").alias("time"))
    name = F.format_string("%s festival number %d", F.element_at(F.array(*[F.lit(x) for x in ("winter", "summer", "harvest")]), (F.col("o_orderkey") % 3 + 1).cast("int")), F.col("o_orderkey") % 7)
    rows = o.withColumn("name", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("The "), name, F.lit("!"))).otherwise(name))
    a, b = rows.where("o_orderkey % 2 = 0"), rows.where("o_orderkey % 2 = 1")
    return textmatch.event_classes(a, b, "o_orderkey", ["day", "venue", "time"], "name", 90)


@register("title_case", "SELECT n_nationkey, 'Nation-' || n_nationkey || ' Bay/Lake' AS name FROM nation", "F2 initcap")
def q_title(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", title_case(F.concat(F.lit("NATION-"), F.col("n_nationkey").cast("string"), F.lit(" bay/LAKE"))).alias("name"))


@register("valid_date_codes", """
    WITH c AS (SELECT k % 5 AS code, DATE '1995-01-01' + CAST(k AS INTEGER) * 200 AS valid_to, 'v' || k AS label FROM (SELECT unnest(range(20)) AS k))
    SELECT o_orderkey, arg_min(label, valid_to) AS label FROM orders LEFT JOIN c ON c.code = o_custkey % 5 AND CAST(o_orderdate AS DATE) <= valid_to GROUP BY 1""", "D5")
def q_codes(spark, sf_dir):
    c = spark.range(20).select((F.col("id") % 5).alias("code"), F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") * 200).cast("int")).alias("valid_to"), F.concat(F.lit("v"), "id").alias("label"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 5).alias("code"), F.to_date("o_orderdate").alias("d"))
    met = o.join(F.broadcast(c), (o.code == c.code) & (F.col("d") <= F.col("valid_to")), "left")
    return met.groupBy("o_orderkey").agg(F.min_by("label", "valid_to").alias("label"))


@register("open_issues", """
    WITH a AS (SELECT user_id, date_trunc('day', ts) AS d, event_type AS alert FROM events WHERE value > 150)
    SELECT i.user_id, i.lo, string_agg(DISTINCT a.alert, ',' ORDER BY a.alert) AS alerts FROM (SELECT DISTINCT user_id, date_trunc('week', ts) AS lo FROM events WHERE event_type = 'error') i
    LEFT JOIN a ON a.user_id = i.user_id AND a.d >= i.lo AND a.d < i.lo + INTERVAL 7 DAY GROUP BY ALL""", "C14 tsrange overlap")
def q_issues(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    week = F.date_trunc("week", "ts").cast("timestamp_ntz")
    a = e.where("value > 150").groupBy("user_id", week.alias("lo")).agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("alerts"))
    return e.where("event_type = 'error'").select("user_id", week.alias("lo")).distinct().join(a, ["user_id", "lo"], "left")


@register("consecutive_numbers", """
    SELECT y, n, before FROM (SELECT year(o_orderdate) AS y, o_orderkey AS n, lag(o_orderkey, 1) OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS before FROM orders) WHERE n - before > 20""", "E9 lag")
def q_consecutive(spark, sf_dir):
    w = Window.partitionBy("y").orderBy("n")
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.col("o_orderkey").alias("n"))
    return o.withColumn("before", F.lag("n").over(w)).where("n - before > 20")


@register("exclusive_tables", "SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 3000)", "G4")
def q_exclusive(spark, sf_dir):
    taken = table(spark, sf_dir, "supplier").where("s_acctbal < 3000").select(F.col("s_nationkey").alias("c_nationkey"))
    return network.exclusive(table(spark, sf_dir, "customer").select("c_nationkey").distinct(), taken, ["c_nationkey"])


@register("cross_source_counts", """
    WITH a AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE user_id % 2 = 0 GROUP BY 1), b AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE user_id % 2 = 1 AND isodow(ts) < 7 GROUP BY 1)
    SELECT count_if(abs(a.n - b.n) <= 0.1 * a.n) AS close, count_if(b.n IS NULL) AS missing_b, count_if(a.n IS NULL) AS missing_a, count(*) AS days FROM a FULL JOIN b USING (d)""", "E14")
def q_cross(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    a = e.where("user_id % 2 = 0").groupBy("d").agg(F.count("*").alias("a"))
    b = e.where((F.col("user_id") % 2 == 1) & (F.weekday("ts") < 6)).groupBy("d").agg(F.count("*").alias("b"))
    return a.join(b, "d", "full").agg(F.count_if(F.abs(F.col("a") - F.col("b")) <= 0.1 * F.col("a")).alias("close"), F.count_if(F.col("b").isNull()).alias("missing_b"), F.count_if(F.col("a").isNull()).alias("missing_a"), F.count("*").alias("days"))


@register("seasonal_regression", "SELECT month(l_shipdate) AS season, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY 1", "E15")
def q_regression(spark, sf_dir):
    fit = [f("l_extendedprice", "l_quantity") for f in (F.regr_slope, F.regr_intercept, F.regr_r2)]
    return table(spark, sf_dir, "lineitem").groupBy(F.month("l_shipdate").alias("season")).agg(F.round(fit[0], 3).alias("slope"), F.round(fit[1], 2).alias("intercept"), F.round(fit[2], 6).alias("r2"))


#: Wide counts of a node: three modes by four legs and three turns, made of an order's numbers.
_WIDE = [(leg, kind, turn) for leg in "nesw" for kind in ("cars", "truck", "bus") for turn in "rtl"]


def _count(k: int) -> str:
    return f"(o_custkey * {k + 3} + o_orderkey * {2 * k + 1}) % {7 + k}"


def _exits_sql() -> str:
    """What leaves by each leg: straight on from the opposite one, by right and left turns from those beside it; summed over vehicles."""
    column = {x: _count(k) for k, x in enumerate(_WIDE)}
    sums = [(leg, kind, [(legs[2], "t"), (legs[1], "r"), (legs[3], "l")]) for leg, legs in (("N", "nesw"), ("E", "eswn"), ("S", "swne"), ("W", "wnes")) for kind in ("cars", "truck", "bus")]
    return " UNION ALL ".join(f"SELECT o_orderkey, '{leg}' AS leg, '{kind}' AS kind, CAST({' + '.join(column[f, kind, t] for f, t in parts)} AS BIGINT) AS volume FROM orders" for leg, kind, parts in sums)


@register("tmc_exits", _exits_sql(), "B6")
def q_exits(spark, sf_dir):
    wide = table(spark, sf_dir, "orders").select("o_orderkey", *[F.expr(_count(k)).alias("_".join(x)) for k, x in enumerate(_WIDE)])
    rows = F.array(*[F.struct(F.lit(leg).alias("leg"), F.lit(kind).alias("kind"), v.alias("volume")) for kind in ("cars", "truck", "bus") for leg, v in exit_volumes(kind).items()])
    return wide.select("o_orderkey", F.inline(rows))


@register("freshness", "SELECT event_type, max(ts) AS newest, max(ts) < TIMESTAMP '2024-01-30 23:45:00' AS stale FROM events GROUP BY 1", "E10")
def q_freshness(spark, sf_dir):
    newest = F.max("ts")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(newest.alias("newest"), (newest < F.lit("2024-01-30 23:45:00").cast("timestamp_ntz")).alias("stale"))
