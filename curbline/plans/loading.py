"""Readers and writers: rows that are written (or made) in an outer form and come back through it."""

import uuid

from pyspark.sql import functions as F

from curbline.plans.registry import register
from curbline.session import shared_folder
from curbline.sources import readers, writers
from curbline.sources.tables import table
from curbline.streaming import binned


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@register("csv_loaded", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate FROM orders", "A5 COPY TO COPY FROM pandas to_csv pandas read_csv")
def q_csv(spark, sf_dir):
    at = _folder(spark, "orders-csv")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate").write.option("header", True).csv(at)
    return readers.csv(spark, at, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz")


@register("csv_years", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1", "A16")
def q_csv_years(spark, sf_dir):
    at = _folder(spark, "orders-by-year")
    writers.csv_by_year(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), at, "o_orderdate")
    back = spark.read.schema("o_orderkey long, o_orderdate timestamp_ntz, year int").option("header", True).csv(at)
    return back.groupBy("year").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@register("fixed_width_lines", "SELECT 'D' || c_custkey AS detector_id, lpad(CAST(c_custkey % 2400 AS VARCHAR), 4, '0') AS at, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 97 - 3 AS INTEGER) END AS n FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 97 >= 3", "A8")
def q_fixed(spark, sf_dir):
    k = F.col("c_custkey")
    count = F.when(k % 5 == 0, F.lit("")).otherwise((k % 97 - 3).cast("string"))
    line = F.concat(F.rpad(F.lpad((k % 2400).cast("string"), 4, "0"), 6, " "), F.lit(" " * 8), F.rpad(F.concat(F.lit("D"), k.cast("string")), 12, " "), F.lpad(count, 10, " "))
    return readers.fixed_width(table(spark, sf_dir, "customer").select(line.alias("value")))


@register("blank_separated", "SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 3 > 0 THEN CAST(s_nationkey AS VARCHAR) END AS nation FROM supplier", "A15 pandas read_table")
def q_blank(spark, sf_dir):
    k = F.col("s_suppkey").cast("string")
    line = F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit("  "), k, F.lit(" \t "), F.col("s_nationkey").cast("string"), F.lit(" "))).otherwise(k)
    lines = table(spark, sf_dir, "supplier").select(line.alias("value")).unionByName(spark.sql("SELECT '  ' AS value"))
    return readers.text_columns(lines, ["id", "nation"])


@register("lane_records", """
    SELECT o_orderkey, CAST(l AS INTEGER) AS lane, CASE WHEN (o_orderkey * 7 + l) % 1000 > 0 THEN ((o_orderkey * 7 + l) % 1000) / 100.0 END::DOUBLE AS speed_kmh, CAST((o_orderkey * 3 + l) % 60000 AS INTEGER) AS veh_per_hr, ((o_custkey + l) % 10000 / 100.0)::DOUBLE AS occupancy_percent FROM orders CROSS JOIN (VALUES (1), (2)) v(l)""", "A9")
def q_lanes(spark, sf_dir):
    two = lambda x: F.concat(F.lpad(F.hex(x % 256), 2, "0"), F.lpad(F.hex(F.floor(x / 256)), 2, "0"))
    record = lambda l: F.concat(F.lpad(F.hex(F.lit(l)), 2, "0"), two((F.col("o_orderkey") * 7 + l) % 1000), two((F.col("o_orderkey") * 3 + l) % 60000), two((F.col("o_custkey") + l) % 10000), F.lit("00" * 8))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.unhex(F.concat(record(1), record(2))).alias("data"))
    return readers.lanes(rows, "o_orderkey", "data")


@register("geometry_bytes", "SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'POINT (-79.5 43.5)' WHEN n_nationkey % 3 = 1 THEN 'LINESTRING (-79.5 43.5, 0.0 1.0)' END AS wkt FROM nation", "A10")
def q_geometry(spark, sf_dir):
    point, zero, one = "0000000000E053C0" + "0000000000C04540", "0000000000000000", "000000000000F03F"
    data = F.when(F.col("n_nationkey") % 3 == 0, F.lit("01000000" + point)).when(F.col("n_nationkey") % 3 == 1, F.lit("02000000" + point + zero + one)).otherwise(F.lit("0300"))
    return readers.geometries(table(spark, sf_dir, "nation").select("n_nationkey", F.unhex(data).alias("data")), "n_nationkey", "data")


@register("nested_records", "SELECT o_custkey AS api_id, CAST(o_orderkey % 80 AS INTEGER) AS speed, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderkey % 4 AS INTEGER) END AS count FROM orders", "A4 A11 pandas json_normalize")
def q_nested(spark, sf_dir):
    one = F.struct((F.col("o_orderkey") % 80).cast("string").alias("speed"), F.when(F.col("o_orderkey") % 4 > 0, (F.col("o_orderkey") % 4).cast("string")).otherwise("").alias("count"))
    doc = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.collect_list(one)).alias("body"))
    records = doc.select(F.col("o_custkey").alias("api_id"), F.lit("t").alias("datetime_bin"), F.from_json("body", "array<struct<speed:string,count:string>>").alias("counter"))
    return readers.nested_counts(records).drop("datetime_bin")


@register("lane_states", """
    WITH c AS (SELECT p_partkey, unnest(['LO', CASE WHEN p_size % 2 = 0 THEN 'LC' ELSE 'LO' END, CASE WHEN p_size % 3 = 0 THEN 'BC' ELSE 'BO' END]) AS code FROM part WHERE p_size % 7 > 0)
    SELECT p_partkey, CASE WHEN code LIKE 'L%' THEN 'car' ELSE 'bike' END AS mode, count_if(code LIKE '%O') AS open, count_if(code LIKE '%C') AS closed FROM c GROUP BY 1, 2""", "A11 B19")
def q_lane_states(spark, sf_dir):
    k = F.col("p_size")
    code = F.concat(F.lit("LO"), F.when(k % 2 == 0, "LC").otherwise("LO"), F.when(k % 3 == 0, "BC").otherwise("BO"))
    doc = F.when(k % 7 > 0, F.to_json(F.struct(F.lit("A").alias("Road"), F.array(F.struct(F.lit("N").alias("Direction"), code.alias("LanesAffected"))).alias("LaneApproaches")))).otherwise("no json")
    out = readers.lane_approaches(table(spark, sf_dir, "part").select("p_partkey", doc.alias("doc")), "p_partkey", "doc")
    lookup = spark.createDataFrame([("LO", "car", "open"), ("LC", "car", "closed"), ("BO", "bike", "open"), ("BC", "bike", "closed")], "code string, mode string, state string")
    return readers.lane_states(out, "p_partkey", "LanesAffected", lookup)


@register("layer_pages", "SELECT c_custkey AS objectid, c_name AS name, CAST(c_nationkey AS INTEGER) AS nation FROM customer", "A1 A2 A3")
def q_pages(spark, sf_dir):
    """Pages of a hundred, each with the last object of the page before once more."""
    feature = F.struct(F.struct(F.col("c_custkey").alias("objectid"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("attributes"))
    page = F.floor(F.col("c_custkey") / 100)
    c = table(spark, sf_dir, "customer").withColumn("page", F.explode(F.when(F.col("c_custkey") % 100 == 99, F.array(page, page + 1)).otherwise(F.array(page))))
    body = F.to_json(F.struct(F.lit(True).alias("exceededTransferLimit"), F.collect_list(feature).alias("features")))
    return readers.pages(c.groupBy("page").agg(body.alias("body")), "page", "objectid: bigint, name: string, nation: int")


@register("pull_spans", "SELECT CAST(lo AS DATE) AS lo, least(CAST(lo + INTERVAL 30 DAY AS DATE), DATE '2024-04-15') AS hi FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-04-14', INTERVAL 30 DAY)) AS lo)", "A2")
def q_spans(spark, sf_dir):
    return readers.day_chunks(spark, "2024-01-01", "2024-04-15", 30)


@register("html_tables", "SELECT r_regionkey, CAST(i AS INTEGER) AS row, CASE WHEN i = 0 THEN ['Name', 'Nations & more'] ELSE [r_name, CAST(i AS VARCHAR)] END AS cells FROM region CROSS JOIN (VALUES (0), (1), (2)) v(i)", "A13")
def q_html(spark, sf_dir):
    rows = F.concat(*[F.concat(F.lit("<TR class='x'><td> <b>"), F.col("r_name"), F.lit(f"</b></td>\n<td>&nbsp;{i}</td></tr>")) for i in (1, 2)])
    html = F.concat(F.lit("<p>text</p><table><tr><th>Name</th><th>Nations &amp; more</th></tr>"), rows, F.lit("<tr></tr></table>"))
    return readers.html_rows(table(spark, sf_dir, "region").select("r_regionkey", html.alias("html")), "r_regionkey", "html")


@register("xml_records", "SELECT s_suppkey, s_name AS name, CAST(s_nationkey AS INTEGER) AS nation FROM supplier", "A12")
def q_xml(spark, sf_dir):
    doc = F.to_xml(F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", doc.alias("doc"))
    return rows.select("s_suppkey", F.from_xml("doc", "name string, nation int").alias("x")).select("s_suppkey", "x.name", "x.nation")


@register("sheet_validated", "SELECT c_custkey, (CASE WHEN c_acctbal <= 0 THEN 'positive ' ELSE '' END) || (CASE WHEN c_mktsegment = 'BUILDING' THEN 'segment ' ELSE '' END) AS broken FROM customer", "A14")
def q_validated(spark, sf_dir):
    good, bad = readers.validated(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), positive="c_acctbal > 0", segment="c_mktsegment <> 'BUILDING'")
    said = bad.select("c_custkey", F.concat(F.array_join("broken", " "), F.lit(" ")).alias("broken"))
    return good.select("c_custkey", F.lit("").alias("broken")).unionByName(said)


@register("restated_days", "SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN 'again' ELSE event_type END AS event_type FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-03'", "A18 A20 INSERT SELECT RANGE partitioning DELETE btree index")
def q_restated(spark, sf_dir):
    """A table by day; a day is loaded twice more, and the oldest days go."""
    at, e = _folder(spark, "days"), table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    writers.restate(e, at, ["day"], ["event_id"])
    for _ in range(2):
        writers.restate(e.where("day = DATE'2024-01-05'").withColumn("event_type", F.lit("again")), at, ["day"], ["event_id"])
    writers.retained(spark, at, "day", "2024-01-03")
    return spark.read.schema("event_id long, event_type string, day date").parquet(at).select("event_id", "day", "event_type")


@register("snapshot_versions", "SELECT p_partkey, DATE '2024-01-01' AS version_date FROM part UNION ALL SELECT p_partkey, DATE '2024-02-01' FROM part WHERE p_size > 10", "A19 MATERIALIZED VIEW REFRESH SELECT INTO CTAS TRUNCATE")
def q_versions(spark, sf_dir):
    at, p = _folder(spark, "parts"), table(spark, sf_dir, "part").select("p_partkey", "p_size")
    writers.snapshot(p, at, "2024-01-01")
    writers.snapshot(p, at, "2024-02-01")
    writers.snapshot(p.where("p_size > 10"), at, "2024-02-01")  # a refresh replaces the version
    return spark.read.schema("p_partkey long, p_size int, version_date date").parquet(at).select("p_partkey", "version_date")


@register("replicated", "SELECT * FROM supplier", "A6 A7")
def q_replicated(spark, sf_dir):
    at = _folder(spark, "suppliers")
    writers.replicate(table(spark, sf_dir, "supplier"), at)
    return spark.read.schema(table(spark, sf_dir, "supplier").schema).parquet(at)


@register("routed_inserts", "SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS route, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1", "CREATE RULE INHERITS LIST partitioning")
def q_routed(spark, sf_dir):
    """A rule sends rows to the parts of a table, which is read as one."""
    at, o = _folder(spark, "routed"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for some in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1"):
        writers.routed(o.where(some), at, F.when(F.col("o_orderstatus") == "F", "done").otherwise("open"))
    return spark.read.schema("o_orderkey long, o_orderstatus string, route string").parquet(at).groupBy("route").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@register("geojson_features", """SELECT '{"type":"FeatureCollection","features":[' || string_agg('{"type":"Feature","geometry":{"type":"Point","coordinates":[' || CAST(n_nationkey AS DOUBLE) || ',' || CAST(n_regionkey AS DOUBLE) || ']},"properties":{"n_name":"' || n_name || '"}}', ',' ORDER BY n_nationkey) || ']}' AS geojson FROM nation""", "A16 ST_AsGeoJSON")
def q_features(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("double").alias("x"), F.col("n_regionkey").cast("double").alias("y"), "n_name")
    return writers.feature_collection(n, "x", "y", ["n_name"])


def _stream(spark, sf_dir, name: str):
    """The events as files that arrive, and a folder for what is made of them."""
    at, e = _folder(spark, name), table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    e.repartition(4, "user_id").write.parquet(f"{at}/in")
    return spark.readStream.schema(e.schema).parquet(f"{at}/in"), at


@register("stream_bins", """
    SELECT * FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS bin, event_type, count(*) AS n FROM events GROUP BY 1, 2) WHERE bin + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""", "I watermarked bins")
def q_stream_bins(spark, sf_dir):
    """Bins that the watermark has closed, an hour behind the last reading."""
    stream, at = _stream(spark, sf_dir, "stream-bins")
    binned.to_table(binned.binned(stream, "ts", ["event_type"], 15, "1 hour", n=F.count("*")), f"{at}/out", f"{at}/checkpoint").awaitTermination()
    out = spark.read.schema("bin timestamp, event_type string, n long").parquet(f"{at}/out")
    return out.select(F.col("bin").cast("timestamp_ntz").alias("bin"), "event_type", "n")


@register("stream_merged", "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2", "I batch merge upsert stream")
def q_stream_merged(spark, sf_dir):
    """The last reading of each sensor and class, kept up by batches."""
    stream, at = _stream(spark, sf_dir, "stream-merged")
    binned.merged(stream, f"{at}/table", ["user_id", "event_type"], "event_id", f"{at}/checkpoint", parts=4).awaitTermination()
    return binned.current(spark, f"{at}/table").select("user_id", "event_type", "event_id", "value")
