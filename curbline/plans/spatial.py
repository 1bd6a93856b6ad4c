"""Points, lines and polygons: geometry made of the customers' numbers, and SQL that says the same in closed form."""

from pyspark.sql import functions as F

from curbline.functions import spatial as sp
from curbline.operators import lines
from curbline.plans.registry import register
from curbline.session import spread
from curbline.sources.tables import table

#: Every customer has an L-shaped line, three to the east and four to the north from (x0, y0).
_BASE = "b AS (SELECT c_custkey, CAST(c_custkey % 100 AS DOUBLE) AS x0, CAST(c_custkey % 37 AS DOUBLE) AS y0, CAST(c_custkey % 4 + 1 AS DOUBLE) AS dx, CAST(c_custkey % 6 - 1 AS DOUBLE) AS dy, (c_custkey % 5) / 10.0 AS a, (5 + c_custkey % 6) / 10.0 AS z FROM customer)"


def _lines(spark, sf_dir):
    k = F.col("c_custkey")
    x, y = (k % 100).cast("double"), (k % 37).cast("double")
    line = F.array(sp.point(x, y), sp.point(x + 3, y), sp.point(x + 3, y + 4))
    near = sp.point(x + 3 + k % 4 + 1, y + k % 6 - 1)
    return table(spark, sf_dir, "customer").select("c_custkey", line.alias("line"), near.alias("p"), ((k % 5) / 10.0).alias("a"), ((5 + k % 6) / 10.0).alias("z"))


@register("point_functions", f"""
    WITH {_BASE} SELECT c_custkey, x0 + 1 AS x, y0 - 2 AS y, round(x0 - dy * sin(0.305) + dx * cos(0.305), 6) AS rx, round(y0 + dx * sin(0.305) + dy * cos(0.305), 6) AS ry, round(sqrt(dx * dx + dy * dy), 6) AS metres, 2952 AS srid,
      'POINT' AS kind FROM b""", "ST_MakePoint ST_X ST_Y ST_Translate ST_Rotate ST_SetSRID ST_GeometryType ST_Distance F5")
def q_points(spark, sf_dir):
    k = F.col("c_custkey")
    p = sp.point(k % 100, k % 37)
    q = sp.translate(p, k % 4 + 1, k % 6 - 1)
    moved, turned = sp.translate(p, F.lit(1.0), F.lit(-2.0)), sp.rotate(q, F.lit(0.305), p)
    kind = sp.kind(sp.as_text(F.array(p)))
    return table(spark, sf_dir, "customer").select("c_custkey", moved["x"].alias("x"), moved["y"].alias("y"), F.round(turned["x"], 6).alias("rx"), F.round(turned["y"], 6).alias("ry"), F.round(sp.distance(p, q), 6).alias("metres"), F.lit(2952).alias("srid"), kind.alias("kind"))


@register("grid_points", """
    WITH p AS (SELECT c_custkey, radians(43.55 + (c_custkey % 300) / 1000.0) AS phi, radians(-79.6 + (c_custkey % 400) / 1000.0 + 79.5) AS lam, 2.0 / 298.257222101 - pow(1 / 298.257222101, 2) AS e FROM customer),
    q AS (SELECT *, e / (1 - e) AS f, 6378137.0 / sqrt(1 - e * pow(sin(phi), 2)) AS n, pow(tan(phi), 2) AS t, e / (1 - e) * pow(cos(phi), 2) AS c, lam * cos(phi) AS a,
      6378137.0 * ((1 - e / 4 - 3 * e * e / 64 - 5 * e * e * e / 256) * phi - (3 * e / 8 + 3 * e * e / 32 + 45 * e * e * e / 1024) * sin(2 * phi) + (15 * e * e / 256 + 45 * e * e * e / 1024) * sin(4 * phi) - 35 * e * e * e / 3072 * sin(6 * phi)) AS m FROM p)
    SELECT c_custkey, round(304800 + 0.9999 * n * (a + (1 - t + c) * pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * f) * pow(a, 5) / 120), 3) AS x,
      round(0.9999 * (m + n * tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * f) * pow(a, 6) / 720)), 3) AS y FROM q""", "ST_Transform")
def q_grid(spark, sf_dir):
    k = F.col("c_custkey")
    p = sp.to_grid(F.lit(-79.6) + (k % 400) / 1000.0, F.lit(43.55) + (k % 300) / 1000.0)
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(p["x"], 3).alias("x"), F.round(p["y"], 3).alias("y"))


@register("line_functions", f"""
    WITH {_BASE} SELECT c_custkey, 7.0::DOUBLE AS length, 3 AS points, x0 AS sx, y0 AS sy, x0 + 3 AS ex, y0 + 4 AS ey, x0 + 3 AS mx, y0 AS my, x0 + 3 AS first_reversed, round(x0 + (3 * 1.5 + 4 * 3) / 7.0, 6) AS cx, round(y0 + 4 * 2 / 7.0, 6) AS cy,
      x0 - 1 AS bx1, y0 + 5 AS by2, x0 + 2 <= 51 AND x0 + 3 >= 49 AND y0 + 4 >= 9 AND y0 <= 11 AS boxes FROM b""", "ST_Length ST_NPoints ST_StartPoint ST_EndPoint ST_PointN ST_Reverse ST_Centroid ST_Expand && bbox")
def q_lines(spark, sf_dir):
    line, n = F.col("line"), lambda k: sp.point_at(F.col("line"), k)
    c, wide = sp.line_centroid(line), sp.expand(sp.box(line), 1)
    other = sp.box(F.array(sp.point(F.lit(49), F.lit(9)), sp.point(F.lit(51), F.lit(11))))
    over = sp.boxes_overlap(F.struct((sp.box(line)["x1"] + 2).alias("x1"), sp.box(line)["y1"].alias("y1"), sp.box(line)["x2"].alias("x2"), sp.box(line)["y2"].alias("y2")), other)
    return _lines(spark, sf_dir).select(
        "c_custkey", sp.length(line).alias("length"), F.size(line).alias("points"), n(1)["x"].alias("sx"), n(1)["y"].alias("sy"), n(-1)["x"].alias("ex"), n(-1)["y"].alias("ey"), n(2)["x"].alias("mx"), n(2)["y"].alias("my"),
        F.get(F.reverse(line), F.lit(0))["x"].alias("first_reversed"), F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"), wide["x1"].alias("bx1"), wide["y2"].alias("by2"), over.alias("boxes"),
    )


@register("line_locate", f"""
    WITH {_BASE}, l AS (SELECT *, least(greatest(dy, 0), 4) AS w FROM b)
    SELECT c_custkey, round((3 + w) / 7, 6) AS share, round(sqrt(dx * dx + (dy - w) * (dy - w)), 6) AS metres, x0 + 3 AS cx, round(y0 + w, 6) AS cy, sqrt(dx * dx + (dy - w) * (dy - w)) <= 2.5 AS near FROM l""", "ST_LineLocatePoint ST_ClosestPoint ST_DWithin ST_Buffer of lines")
def q_locate(spark, sf_dir):
    line, p = F.col("line"), F.col("p")
    c = sp.closest_point(line, p)
    return _lines(spark, sf_dir).select("c_custkey", F.round(sp.locate(line, p), 6).alias("share"), F.round(sp.line_distance(line, p), 6).alias("metres"), F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"), sp.within_distance(line, p, 2.5).alias("near"))


@register("line_substring", f"WITH {_BASE} SELECT c_custkey, 3 AS points, round(x0 + 7 * a, 6) AS sx, y0 AS sy, x0 + 3 AS mx, x0 + 3 AS ex, round(y0 + 7 * z - 3, 6) AS ey, round(7 * (z - a), 6) AS length FROM b", "ST_LineSubstring ST_Line_Substring F6")
def q_substring(spark, sf_dir):
    cut = _lines(spark, sf_dir).select("c_custkey", sp.substring(F.col("line"), F.col("a"), F.col("z")).alias("c"))
    n = lambda k: sp.point_at(F.col("c"), k)
    return cut.select("c_custkey", F.size("c").alias("points"), F.round(n(1)["x"], 6).alias("sx"), n(1)["y"].alias("sy"), n(2)["x"].alias("mx"), F.round(n(-1)["x"], 6).alias("ex"), F.round(n(-1)["y"], 6).alias("ey"), F.round(sp.length(F.col("c")), 6).alias("length"))


@register("lines_of_points", "SELECT o_custkey, count(*) AS points, CAST(min_by(o_orderkey % 100, o_orderkey) AS DOUBLE) AS sx, CAST(max_by(o_orderkey % 100, o_orderkey) AS DOUBLE) AS ex FROM orders GROUP BY 1", "ST_MakeLine F18")
def q_make_lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 100).alias("x"), (F.col("o_orderkey") % 7).alias("y"))
    made = lines.make_lines(o, ["o_custkey"], "o_orderkey", "x", "y")
    return made.select("o_custkey", F.size("line").cast("long").alias("points"), sp.point_at(F.col("line"), 1)["x"].alias("sx"), sp.point_at(F.col("line"), -1)["x"].alias("ex"))


@register("lines_merged", """
    WITH s AS (SELECT c_nationkey AS street, c_custkey AS k FROM customer), r AS (SELECT *, row_number() OVER (PARTITION BY street ORDER BY k) AS n, count(*) OVER (PARTITION BY street) AS total FROM s)
    SELECT street, CAST(n - (n - 1) % 5 AS BIGINT) AS sx, count(*) + 1 AS points, CAST(count(*) AS DOUBLE) AS length FROM r GROUP BY street, n - (n - 1) % 5""", "ST_LineMerge ST_GeometryN")
def q_merge_lines(spark, sf_dir):
    """Segments of streets, every other one turned round, with a gap after each fifth."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    s = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("street"), n.alias("n"))
    row = F.floor((F.col("n") - 1) / 5)
    line = F.array(sp.point(F.col("n"), row), sp.point(F.col("n") + 1, row))
    merged = lines.merge_lines(s.select("street", F.when(F.col("n") % 2 == 0, F.reverse(line)).otherwise(line).alias("line")), "street", "line")
    return merged.select("street", sp.point_at(F.col("line"), 1)["x"].cast("long").alias("sx"), F.size("line").cast("long").alias("points"), sp.length(F.col("line")).alias("length"))


@register("line_text", f"""
    WITH {_BASE}, t AS (SELECT *, 'LINESTRING (' || x0 || ' ' || y0 || ', ' || (x0 + 3) || ' ' || y0 || ', ' || (x0 + 3) || ' ' || (y0 + 4) || ')' AS wkt FROM b)
    SELECT c_custkey, wkt, '{{"type":"LineString","coordinates":[[' || x0 || ',' || y0 || '],[' || (x0 + 3) || ',' || y0 || '],[' || (x0 + 3) || ',' || (y0 + 4) || ']]}}' AS geojson, 'LINESTRING' AS kind, x0 + 3 AS back_x, y0 + 4 AS back_y FROM t""", "ST_AsText ST_GeomFromText ST_AsGeoJSON A10")
def q_text(spark, sf_dir):
    t = _lines(spark, sf_dir).select("c_custkey", sp.as_text(F.col("line")).alias("wkt"), sp.as_geojson(F.col("line")).alias("geojson"))
    back = sp.point_at(sp.from_text(F.col("wkt")), -1)
    return t.select("c_custkey", "wkt", "geojson", sp.kind(F.col("wkt")).alias("kind"), back["x"].alias("back_x"), back["y"].alias("back_y"))


@register("polyline_points", """
    SELECT n_nationkey, i, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM nation CROSS JOIN (VALUES (0, -120.2, 38.5), (1, -120.95, 40.7), (2, -126.453, 43.252)) p(i, x, y)""", "ST_LineFromEncodedPolyline F17")
def q_polyline(spark, sf_dir):
    text = F.lit("_p~iF~ps|U_ulLnnqC_mqNvxq`@")
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.posexplode(sp.from_polyline(text)).alias("i", "p"))
    return rows.select("n_nationkey", "i", F.round("p.x", 5).alias("x"), F.round("p.y", 5).alias("y"))


@register("lines_crossing", """
    WITH s AS (SELECT s_suppkey, CAST(s_suppkey % 9 AS DOUBLE) AS x, CAST(s_suppkey % 7 AS DOUBLE) AS y FROM supplier)
    SELECT s_suppkey, x BETWEEN 3 AND 7 AND 4.5 BETWEEN y AND y + 2 AS crosses FROM s""", "ST_Intersects of lines")
def q_crossing(spark, sf_dir):
    """A street from west to east at 4.5 against upright ones two long."""
    x, y = (F.col("s_suppkey") % 9).cast("double"), (F.col("s_suppkey") % 7).cast("double")
    street = F.array(sp.point(F.lit(3), F.lit(4.5)), sp.point(F.lit(7), F.lit(4.5)))
    return table(spark, sf_dir, "supplier").select("s_suppkey", sp.lines_cross(F.array(sp.point(x, y), sp.point(x, y + 2)), street).alias("crosses"))


_BOXES = "b AS (SELECT c_custkey, CAST(c_custkey % 100 AS DOUBLE) AS x0, CAST(c_custkey % 37 AS DOUBLE) AS y0, abs(c_custkey % 7 - 3) AS ox, abs(c_custkey % 5 - 2) AS oy FROM customer), m AS (SELECT *, CAST(greatest(4 - ox, 0) * greatest(3 - oy, 0) AS DOUBLE) AS common FROM b)"


@register("polygon_functions", f"""
    WITH {_BOXES} SELECT c_custkey, round(common, 6) AS common, round(12 - common, 6) AS rest, round(24 - common, 6) AS both, common > 0 AS meets, ox = 0 AND oy = 0 AS holds, common > 0 AND NOT (ox = 0 AND oy = 0) AS partly,
      x0 + 2 AS cx, y0 + 1.5::DOUBLE AS cy, round(16 * sin(2 * pi() / 32), 6) AS circle FROM m""", "ST_Intersection ST_Difference ST_Union ST_Intersects ST_Contains ST_Within ST_Overlaps ST_Centroid ST_Buffer")
def q_polygons(spark, sf_dir):
    k = F.col("c_custkey")
    x, y = (k % 100).cast("double"), (k % 37).cast("double")
    ring = lambda x, y: F.array(sp.point(x, y), sp.point(x + 4, y), sp.point(x + 4, y + 3), sp.point(x, y + 3))
    rows = spread(table(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", ring(x, y).alias("a"), ring(x + k % 7 - 3, y + k % 5 - 2).alias("b"))
    a, b, c, ab, ba, rest = F.col("a"), F.col("b"), sp.centroid(F.col("a")), F.col("ab"), F.col("ba"), F.col("rest")
    cut = rows.select("*", sp.intersection(a, b).alias("ab"), sp.intersection(b, a).alias("ba"), sp.difference(a, b).alias("rest"))
    return cut.select(
        "c_custkey", F.round(sp.area(ab), 6).alias("common"), F.round(sp.total_area(rest), 6).alias("rest"), F.round(sp.total_area(sp.union(a, b, rest)), 6).alias("both"),
        sp.intersects(a, b, ab).alias("meets"), sp.contains(a, b, ba).alias("holds"), sp.overlaps(a, b, ab, ba).alias("partly"), F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"), F.round(sp.area(sp.buffer(sp.point_at(a, 1), F.lit(1.0))), 6).alias("circle"),
    )


@register("points_in_polygons", """
    WITH p AS (SELECT c_custkey, (c_custkey % 101) / 2.0 + 0.25 AS x, (c_custkey % 47) / 2.0 + 0.25 AS y FROM customer), g AS (SELECT n_nationkey, CAST(n_nationkey * 2 AS DOUBLE) AS gx, CAST(n_regionkey * 4 AS DOUBLE) AS gy FROM nation)
    SELECT c_custkey, n_nationkey FROM p JOIN g ON x > gx AND y > gy AND (x - gx) / 6 + (y - gy) / 5 < 1""", "F14 pandas sjoin ST_Within ST_Contains")
def q_in_polygons(spark, sf_dir):
    p = table(spark, sf_dir, "customer").select("c_custkey", ((F.col("c_custkey") % 101) / 2.0 + 0.25).alias("x"), ((F.col("c_custkey") % 47) / 2.0 + 0.25).alias("y"))
    gx, gy = (F.col("n_nationkey") * 2).cast("double"), (F.col("n_regionkey") * 4).cast("double")
    g = table(spark, sf_dir, "nation").select("n_nationkey", F.array(sp.point(gx, gy), sp.point(gx + 6, gy), sp.point(gx, gy + 5)).alias("ring"))
    return lines.in_polygons(p, g, "x", "y", "ring", 4.0).select("c_custkey", "n_nationkey")


@register("moved_sites", """
    WITH n AS (SELECT s_suppkey, CAST(s_suppkey % 50 AS DOUBLE) + (s_suppkey % 4) * 60 AS x, 0.0 AS y, CASE WHEN s_suppkey % 9 = 0 THEN 'W' ELSE 'E' END AS direction, CASE WHEN s_suppkey % 5 = 0 THEN 'new' ELSE s_name END AS name FROM supplier),
    o AS (SELECT s_suppkey AS k, CAST(s_suppkey % 50 AS DOUBLE) AS x, 0.0 AS y, 'E' AS direction, s_name AS name FROM supplier WHERE s_suppkey % 7 <> 0),
    m AS (SELECT n.*, CASE WHEN o.k IS NULL OR sqrt(pow(n.x - o.x, 2) + pow(n.y - o.y, 2)) > 100 OR n.direction <> o.direction THEN 'insert' WHEN n.name <> o.name THEN 'update' END AS action FROM n LEFT JOIN o ON s_suppkey = k)
    SELECT s_suppkey, x, CAST(y AS DOUBLE) AS y, direction, name, action FROM m WHERE action IS NOT NULL""", "F16")
def q_moved(spark, sf_dir):
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    new = s.select("s_suppkey", ((k % 50).cast("double") + (k % 4) * 60).alias("x"), F.lit(0.0).alias("y"), F.when(k % 9 == 0, "W").otherwise("E").alias("direction"), F.when(k % 5 == 0, "new").otherwise(F.col("s_name")).alias("name"))
    old = s.where("s_suppkey % 7 <> 0").select("s_suppkey", (k % 50).cast("double").alias("x"), F.lit(0.0).alias("y"), F.lit("E").alias("direction"), F.col("s_name").alias("name"))
    return lines.moved(old, new, "s_suppkey", 100.0, F.hypot(F.col("x") - F.col("old_x"), F.col("y") - F.col("old_y")))
