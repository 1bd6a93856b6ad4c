"""Planar geometry on columns: a point is a struct (x, y), a line or ring an array of points, all in built-in expressions.

Rings are given without repeating their first corner; rings to clip by are convex, corners anticlockwise."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
#: Ellipsoid (semi-major axis, flattening) and projection of the city's grid: central meridian, scale, false easting. Fixed values.
AXIS, FLATTENING = 6378137.0, 1 / 298.257222101
MERIDIAN, SCALE, EASTING = -79.5, 0.9999, 304800.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def translate(p: Column, dx, dy) -> Column:
    return point(p["x"] + dx, p["y"] + dy)


def rotate(p: Column, angle: Column, about: Column) -> Column:
    """Anticlockwise by ``angle`` radians about a point."""
    dx, dy = p["x"] - about["x"], p["y"] - about["y"]
    return point(about["x"] + dx * F.cos(angle) - dy * F.sin(angle), about["y"] + dx * F.sin(angle) + dy * F.cos(angle))


def distance(p: Column, q: Column) -> Column:
    return F.hypot(p["x"] - q["x"], p["y"] - q["y"])


def to_grid(lon: Column, lat: Column) -> Column:
    """Longitude and latitude on the city's transverse Mercator grid, by the usual series (to a millimetre within the zone)."""
    e2 = FLATTENING * (2 - FLATTENING)
    second = e2 / (1 - e2)
    phi = F.radians(lat)
    n = AXIS / F.sqrt(1 - e2 * F.sin(phi) ** 2)
    t, c = F.tan(phi) ** 2, second * F.cos(phi) ** 2
    a = F.radians(lon - MERIDIAN) * F.cos(phi)
    m = AXIS * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi) - 35 * e2**3 / 3072 * F.sin(6 * phi)
    )
    x = EASTING + SCALE * n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * second) * a**5 / 120)
    y = SCALE * (m + n * F.tan(phi) * (a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * a**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * second) * a**6 / 720))
    return point(x, y)


def once(x: Column, f) -> Column:
    """f(x), where ``x`` is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


# ---- lines


def sides(line: Column, closed: bool = False) -> Column:
    """Segments (a, b) of a line, or of a ring with the one that closes it."""
    ends = F.concat(F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0))), F.slice(line, 1, 1) if closed else F.slice(line, 1, 0))
    starts = line if closed else F.slice(line, 1, F.greatest(F.size(line) - 1, F.lit(0)))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def length(line: Column) -> Column:
    return F.aggregate(sides(line), F.lit(0.0), lambda s, e: s + distance(e["a"], e["b"]))


def point_at(line: Column, n) -> Column:
    """The n-th point from 1, or from the end if negative."""
    return F.try_element_at(line, F.lit(n) if isinstance(n, int) else n)


def _run(line: Column) -> Column:
    """Segments with the length before them: (a, b, before, n)."""
    first = F.struct(F.lit(0.0).alias("run"), F.array().cast(f"array<struct<a:{POINT},b:{POINT},before:double,n:double>>").alias("out"))

    def step(s, e):
        n = distance(e["a"], e["b"])
        return F.struct((s["run"] + n).alias("run"), F.array_append(s["out"], F.struct(e["a"].alias("a"), e["b"].alias("b"), s["run"].alias("before"), n.alias("n"))).alias("out"))

    return F.aggregate(sides(line), first, step)["out"]


def _nearest(line: Column, p: Column) -> Column:
    """(distance, length up to it) of a line's nearest place to a point."""
    start = F.struct(F.lit(math.inf).alias("d"), F.lit(0.0).alias("at"))

    def step(s, e):
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        t = F.when(e["n"] > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((p["x"] - e["a"]["x"]) * dx + (p["y"] - e["a"]["y"]) * dy) / (e["n"] * e["n"])))).otherwise(F.lit(0.0))
        d = F.hypot(e["a"]["x"] + t * dx - p["x"], e["a"]["y"] + t * dy - p["y"])
        return F.when(d < s["d"], F.struct(d.alias("d"), (e["before"] + t * e["n"]).alias("at"))).otherwise(s)

    return F.aggregate(_run(line), start, step)


def locate(line: Column, p: Column) -> Column:
    """Share of a line's length at its nearest place to a point."""
    n = length(line)
    return F.when(n > 0, _nearest(line, p)["at"] / n).otherwise(F.lit(0.0))


def line_distance(line: Column, p: Column) -> Column:
    return _nearest(line, p)["d"]


def within_distance(line: Column, p: Column, metres) -> Column:
    """Whether a point lies in the line's buffer."""
    return line_distance(line, p) <= metres


def interpolate(line: Column, share: Column) -> Column:
    """The point at a share of a line's length."""
    at = share * length(line)
    e = F.coalesce(F.get(F.filter(_run(line), lambda e: (e["before"] + e["n"] >= at) & (e["n"] > 0)), F.lit(0)), F.try_element_at(_run(line), F.lit(-1)))
    t = F.when(e["n"] > 0, F.least(F.lit(1.0), (at - e["before"]) / e["n"])).otherwise(F.lit(0.0))
    return point(e["a"]["x"] + t * (e["b"]["x"] - e["a"]["x"]), e["a"]["y"] + t * (e["b"]["y"] - e["a"]["y"]))


def closest_point(line: Column, p: Column) -> Column:
    return interpolate(line, locate(line, p))


def substring(line: Column, a: Column, b: Column) -> Column:
    """A line between two shares of its length: the points at both, and its own between them."""
    n = length(line)
    inner = F.transform(F.filter(_run(line), lambda e: (e["before"] > a * n) & (e["before"] < b * n)), lambda e: e["a"])
    return F.concat(F.array(interpolate(line, a)), inner, F.array(interpolate(line, b)))


def line_centroid(line: Column) -> Column:
    """Mean of a line's points by length."""
    mid = lambda c: F.aggregate(_run(line), F.lit(0.0), lambda s, e: s + e["n"] * (e["a"][c] + e["b"][c]) / 2) / length(line)
    return point(mid("x"), mid("y"))


def lines_cross(line: Column, other: Column) -> Column:
    """Whether two lines have a point in common."""
    side = lambda a, b, c: F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))
    within = lambda a, b, c: c["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & c["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    def meet(e, f):
        s = [side(e["a"], e["b"], f["a"]), side(e["a"], e["b"], f["b"]), side(f["a"], f["b"], e["a"]), side(f["a"], f["b"], e["b"])]
        touch = [(s[0] == 0) & within(e["a"], e["b"], f["a"]), (s[1] == 0) & within(e["a"], e["b"], f["b"]), (s[2] == 0) & within(f["a"], f["b"], e["a"]), (s[3] == 0) & within(f["a"], f["b"], e["b"])]
        return ((s[0] != s[1]) & (s[2] != s[3])) | touch[0] | touch[1] | touch[2] | touch[3]

    return F.exists(sides(line), lambda e: F.exists(sides(other), lambda f: meet(e, f)))


# ---- boxes


def box(line: Column) -> Column:
    of = lambda c: F.transform(line, lambda p: p[c])
    return F.struct(F.array_min(of("x")).alias("x1"), F.array_min(of("y")).alias("y1"), F.array_max(of("x")).alias("x2"), F.array_max(of("y")).alias("y2"))


def expand(b: Column, by) -> Column:
    return F.struct((b["x1"] - by).alias("x1"), (b["y1"] - by).alias("y1"), (b["x2"] + by).alias("x2"), (b["y2"] + by).alias("y2"))


def boxes_overlap(a: Column, b: Column) -> Column:
    return (a["x1"] <= b["x2"]) & (b["x1"] <= a["x2"]) & (a["y1"] <= b["y2"]) & (b["y1"] <= a["y2"])


# ---- rings


def _shoelace(ring: Column) -> Column:
    return once(ring, lambda r: F.aggregate(sides(r, True), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]))


def area(ring: Column) -> Column:
    return F.abs(_shoelace(ring)) / 2


def centroid(ring: Column) -> Column:
    """Centre of gravity of a ring's area."""
    of = lambda r, n, c: F.aggregate(sides(r, True), F.lit(0.0), lambda s, e: s + (e["a"][c] + e["b"][c]) * (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / (3 * n)
    return once(ring, lambda r: once(_shoelace(r), lambda n: point(of(r, n, "x"), of(r, n, "y"))))


def inside(p: Column, ring: Column) -> Column:
    """Whether a point lies in a ring, by crossings of a ray."""

    def hit(e):
        y1, y2 = e["a"]["y"], e["b"]["y"]
        return ((y1 > p["y"]) != (y2 > p["y"])) & (p["x"] < (e["b"]["x"] - e["a"]["x"]) * (p["y"] - y1) / F.nullif(y2 - y1, F.lit(0.0)) + e["a"]["x"])

    return F.size(F.filter(sides(ring, True), hit)) % 2 == 1


def _cut(ring: Column, e: Column, sign: int) -> Column:
    """A ring's part to the left of a segment's line (sign 1), or to the right (-1)."""
    side = lambda p: sign * ((e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (p["x"] - e["a"]["x"]))
    corners = F.transform(ring, lambda p: F.struct(p.alias("p"), side(p).alias("s")))

    def kept(c):
        a, b, p, q = c["a"]["p"], c["b"]["p"], c["a"]["s"], c["b"]["s"]
        t = p / F.nullif(p - q, F.lit(0.0))
        meet = once(t, lambda t: point(a["x"] + t * (b["x"] - a["x"]), a["y"] + t * (b["y"] - a["y"])))
        crosses = ((p > 0) & (q < 0)) | ((p < 0) & (q > 0))
        none = F.array().cast(f"array<{POINT}>")
        return F.when((p >= 0) & crosses, F.array(a, meet)).when(p >= 0, F.array(a)).when(crosses, F.array(meet)).otherwise(none)

    return F.flatten(once(corners, lambda c: F.transform(sides(c, True), kept)))


def intersection(ring: Column, convex: Column) -> Column:
    """A ring's part in a convex one; empty if there is none."""
    return F.aggregate(sides(convex, True), ring, lambda r, e: _cut(r, e, 1))


def difference(ring: Column, convex: Column) -> Column:
    """A convex ring's part outside another: rings that don't overlap, one for each side of ``convex`` that cuts something off."""
    start = F.struct(ring.alias("rest"), F.array().cast(f"array<array<{POINT}>>").alias("out"))
    done = F.aggregate(sides(convex, True), start, lambda s, e: F.struct(_cut(s["rest"], e, 1).alias("rest"), F.array_append(s["out"], _cut(s["rest"], e, -1)).alias("out")))
    return F.filter(done["out"], lambda r: (F.size(r) > 2) & (area(r) > 0))


def union(ring: Column, convex: Column, rest: Column | None = None) -> Column:
    """Both rings as rings that don't overlap; ``rest``: their difference, where it is at hand."""
    return F.concat(F.array(convex), difference(ring, convex) if rest is None else rest)


def total_area(rings: Column) -> Column:
    return F.aggregate(rings, F.lit(0.0), lambda s, r: s + area(r))


def contains(ring: Column, convex: Column, common: Column | None = None) -> Column:
    """Whether a convex ring lies wholly in another convex one; ``common``: the inner one's intersection with the other, where it is at hand."""
    common = intersection(convex, ring) if common is None else common
    return once(area(convex), lambda n: F.abs(area(common) - n) <= 1e-9 * n)


def intersects(ring: Column, convex: Column, common: Column | None = None) -> Column:
    """``common``: their intersection, where it is at hand."""
    return area(intersection(ring, convex) if common is None else common) > 0


def overlaps(ring: Column, convex: Column, common: Column | None = None, turned: Column | None = None) -> Column:
    """Whether rings share area and neither holds the other; ``common`` and ``turned``: their intersection, and that of ``convex`` with ``ring``."""
    return once(intersection(ring, convex) if common is None else common, lambda c: intersects(ring, convex, c) & ~contains(convex, ring, c)) & ~contains(ring, convex, turned)


def buffer(p: Column, radius, corners: int = 32) -> Column:
    """A circle about a point, as a ring of corners."""
    turns = F.lit([[math.cos(2 * math.pi * k / corners), math.sin(2 * math.pi * k / corners)] for k in range(corners)])
    return once(p, lambda p: F.transform(turns, lambda t: point(p["x"] + radius * t[0], p["y"] + radius * t[1])))


# ---- text


def as_text(line: Column) -> Column:
    """Well-known text of a line, or of a point if it has one."""
    pairs = F.array_join(F.transform(line, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", ")
    return F.when(F.size(line) == 1, F.concat(F.lit("POINT ("), pairs, F.lit(")"))).otherwise(F.concat(F.lit("LINESTRING ("), pairs, F.lit(")")))


def from_text(text: Column) -> Column:
    """The points of a well-known text; null if it is none."""
    pairs = F.split(F.nullif(F.regexp_extract(text, r"^\s*[A-Z]+\s*\(([^()]*)\)\s*$", 1), F.lit("")), r"\s*,\s*")
    number = lambda p, k: F.element_at(F.split(F.trim(p), r"\s+"), k).try_cast("double")
    return F.transform(pairs, lambda p: point(number(p, 1), number(p, 2)))


def kind(text: Column) -> Column:
    """The geometry's type, from its well-known text."""
    return F.nullif(F.regexp_extract(text, r"^\s*([A-Z]+)", 1), F.lit(""))


def as_geojson(line: Column) -> Column:
    pairs = F.transform(line, lambda p: F.array(p["x"], p["y"]))
    return F.to_json(F.struct(F.lit("LineString").alias("type"), pairs.alias("coordinates")))


def from_polyline(text: Column, precision: int = 5) -> Column:
    """The points of an encoded polyline: signed differences of latitude and longitude in five-bit groups, low ones first."""
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c) - 63)
    zero = lambda: F.lit(0).cast("long")
    start = F.struct(zero().alias("number"), F.lit(0).alias("shift"), F.array().cast("array<bigint>").alias("out"))

    def step(s, c):
        number = s["number"].bitwiseOR(F.call_function("shiftleft", c.bitwiseAND(F.lit(31)).cast("long"), s["shift"]))
        half = F.shiftright(number, 1)
        signed = F.when(number.bitwiseAND(F.lit(1).cast("long")) == 1, -half - 1).otherwise(half)
        return F.when(c >= 32, F.struct(number.alias("number"), (s["shift"] + 5).alias("shift"), s["out"].alias("out"))).otherwise(F.struct(zero().alias("number"), F.lit(0).alias("shift"), F.array_append(s["out"], signed).alias("out")))

    steps = F.aggregate(F.filter(codes, lambda c: c >= 0), start, step)["out"]
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / 2).cast("int") - 1), lambda k: F.struct(F.get(steps, 2 * k).alias("dy"), F.get(steps, 2 * k + 1).alias("dx")))
    empty = F.struct(zero().alias("x"), zero().alias("y"), F.array().cast(f"array<{POINT}>").alias("out"))

    def add(s, d):
        x, y = s["x"] + d["dx"], s["y"] + d["dy"]
        return F.struct(x.alias("x"), y.alias("y"), F.array_append(s["out"], point(x / 10**precision, y / 10**precision)).alias("out"))

    return F.when(F.size(steps) > 1, F.aggregate(pairs, empty, add)["out"])
