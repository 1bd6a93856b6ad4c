"""Scalar functions, aggregates to JSON, and statements that change tables, each as a query over a whole table."""

from pyspark.sql import functions as F

from curbline.functions.timebin import ceil_bin, first_local_hours
from curbline.operators import changes, ranges
from curbline.operators.numbering import serial
from curbline.plans.registry import register
from curbline.plans.relational import same
from curbline.sources.tables import table

same("is_true_false", "SELECT p_partkey, (nullif(p_size, 7) > 10) IS TRUE AS yes, (nullif(p_size, 7) > 10) IS NOT FALSE AS not_no, (nullif(p_size, 7) > 10) IS NOT TRUE AS not_yes FROM part", "IS TRUE FALSE")
same("join_using", "SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k, c_custkey FROM customer) AS c JOIN (SELECT s_nationkey AS k, s_suppkey FROM supplier) AS s USING (k) GROUP BY k", "JOIN USING")
same("nulls_order", "SELECT o_orderkey, row_number() OVER (ORDER BY nullif(o_orderpriority, '5-LOW') NULLS FIRST, o_orderkey) AS a, row_number() OVER (ORDER BY nullif(o_orderpriority, '5-LOW') DESC NULLS LAST, o_orderkey) AS z FROM orders", "NULLS FIRST LAST")
same("today", "SELECT n_nationkey, current_date > DATE '2020-01-01' AS later, current_timestamp IS NOT NULL AS has_now FROM nation", "now current_date current_timestamp")
same("position_chr", "SELECT p_partkey, position('a' IN p_name) AS at, chr(65 + p_size % 26) AS letter, concat_ws('-', p_brand, nullif(p_type, 'SMALL'), p_name) AS joined, concat(p_brand, ' ', p_name) AS pair FROM part", "position chr concat_ws concat")


@register("like_any", "SELECT p_partkey FROM part WHERE p_name LIKE '%green%' OR p_name LIKE 'red%' OR p_brand LIKE '%2'", "LIKE ANY")
def q_like_any(spark, sf_dir):
    return spark.sql("SELECT p_partkey FROM {part} WHERE p_name LIKE ANY ('%green%', 'red%') OR p_brand LIKE ALL ('Brand%', '%2')", part=table(spark, sf_dir, "part"))


@register("similar_to", "SELECT p_partkey FROM part WHERE p_name SIMILAR TO '(red|blue|green).*' AND regexp_matches(p_brand, '#[13]')", "SIMILAR TO POSIX regex match")
def q_similar(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_name").rlike("^(?:(red|blue|green).*)$") & F.col("p_brand").rlike("#[13]")).select("p_partkey")


@register("regex_functions", r"""
    SELECT p_partkey, regexp_split_to_array(p_name, '\s+') AS words, regexp_matches(p_name, '^[a-m]') AS early, CAST(coalesce(nullif(strpos(p_name, nullif(regexp_extract(p_name, '[aeiou]{2}'), '')), 0), 0) AS INTEGER) AS at, string_split(p_brand, '#') AS parts FROM part""", "regexp_split_to_array regexp_like instr substr string_to_array")
def q_regex(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.split("p_name", r"\s+").alias("words"), F.regexp_like("p_name", F.lit("^[a-m]")).alias("early"), F.regexp_instr("p_name", F.lit("[aeiou]{2}")).alias("at"), F.split("p_brand", "#").alias("parts"))


@register("formatted", "SELECT p_partkey, printf('%s: %05d', p_name, p_size) AS label, chr(39) || replace(p_name || chr(39) || 's', chr(39), chr(39) || chr(39)) || chr(39) AS quoted FROM part", "format quote_literal")
def q_format(spark, sf_dir):
    quoted = F.concat(F.lit("'"), F.replace(F.concat("p_name", F.lit("'s")), F.lit("'"), F.lit("''")), F.lit("'"))
    return table(spark, sf_dir, "part").select("p_partkey", F.format_string("%s: %05d", "p_name", "p_size").alias("label"), quoted.alias("quoted"))


@register("truncated", "SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS whole, CAST(trunc(c_acctbal * 10) AS BIGINT) AS tenths FROM customer", "trunc")
def q_trunc(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("long").alias("whole"), (F.col("c_acctbal") * 10).cast("long").alias("tenths"))


@register("parsed_dates", """
    SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS day, strptime(strftime(o_orderdate, '%d/%m/%Y') || ' 13:05', '%d/%m/%Y %H:%M') AS at, strftime(o_orderdate, '%Y-%m') AS month FROM orders""", "to_date to_timestamp to_char")
def q_parsed(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("a"), F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" 13:05")).alias("b"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return o.select("o_orderkey", F.to_date("a", "yyyyMMdd").alias("day"), F.to_timestamp_ntz("b", F.lit("dd/MM/yyyy HH:mm")).alias("at"), "month")


@register("bin_ceilings", """
    SELECT event_id, CASE WHEN time_bucket(INTERVAL 15 MINUTE, ts) = ts THEN ts ELSE time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE END AS bin,
      CAST(floor(epoch(ts) / 300) AS BIGINT) * 300 AS epoch_bin FROM events""", "datetime_bin_ceil epoch floor arithmetic bin")
def q_ceil(spark, sf_dir):
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select("event_id", ceil_bin("ts", 15).alias("bin"), (F.floor(epoch / 300) * 300).alias("epoch_bin"))


@register("fall_back_hours", """
    WITH u AS (SELECT unnest(generate_series(TIMESTAMP '2024-11-01', TIMESTAMP '2024-11-05', INTERVAL 1 HOUR)) AS utc),
    l AS (SELECT e.user_id, u.utc, (u.utc AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto' AS local FROM u CROSS JOIN (SELECT DISTINCT user_id FROM events) e)
    SELECT user_id, local, min(utc) AS utc FROM l GROUP BY user_id, local""", "Q9 DST fall-back")
def q_fall_back(spark, sf_dir):
    hours = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-11-01 00:00:00', TIMESTAMP_NTZ'2024-11-05 00:00:00', INTERVAL 1 HOUR)) AS utc")
    rows = table(spark, sf_dir, "events").select("user_id").distinct().join(F.broadcast(hours), how="cross")
    return first_local_hours(rows, ["user_id"], "utc", "America/Toronto").select("user_id", "local", "utc")


@register("json_agg", "SELECT n_regionkey, CAST(to_json(list({'key': n_nationkey, 'name': n_name} ORDER BY n_nationkey)) AS VARCHAR) AS nations FROM nation GROUP BY 1", "json_agg jsonb_agg array_to_json")
def q_json_agg(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.to_json(rows).alias("nations"))


@register("json_object_agg", "SELECT n_regionkey, '{' || string_agg('\"' || n_name || '\":' || n_nationkey, ',' ORDER BY n_name) || '}' AS nations FROM nation GROUP BY 1", "jsonb_object_agg")
def q_json_object(spark, sf_dir):
    pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct("n_name", "n_nationkey"))))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.to_json(pairs).alias("nations"))


@register("json_records", """
    WITH d AS (SELECT o_custkey, to_json(list({'key': o_orderkey, 'status': o_orderstatus} ORDER BY o_orderkey)) AS doc FROM orders GROUP BY 1),
    r AS (SELECT o_custkey, unnest(from_json(doc, '[{"key":"BIGINT","status":"VARCHAR"}]')) AS r FROM d) SELECT o_custkey, r.key AS key, r.status AS status FROM r""", "json_to_recordset")
def q_json_records(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))))
    docs = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(rows).alias("doc"))
    return docs.select("o_custkey", F.inline(F.from_json("doc", "array<struct<key: bigint, status: string>>")))


@register("json_without_nulls", """SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN '{"name":"' || n_name || '"}' ELSE '{"name":"' || n_name || '","region":' || n_regionkey || '}' END AS doc FROM nation""", "json_strip_nulls row_to_json")
def q_json_stripped(spark, sf_dir):
    region = F.when(F.col("n_regionkey") != 1, F.col("n_regionkey"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), region.alias("region"))).alias("doc"))


@register("arrays_changed", "SELECT o_custkey, list_filter(list(o_orderstatus ORDER BY o_orderkey), lambda x: x <> 'F') AS open, array_to_string(list(o_orderstatus ORDER BY o_orderkey), '|') AS joined FROM orders GROUP BY 1", "array_remove array_to_string")
def q_arrays_changed(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus")))
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(rows.alias("r"))
    return g.select("o_custkey", F.array_remove("r.o_orderstatus", "F").alias("open"), F.array_join("r.o_orderstatus", "|").alias("joined"))


@register("range_functions", """
    WITH r AS (SELECT o_orderkey, o_custkey % 50 AS lo, o_custkey % 50 + o_orderkey % 7 AS hi, o_orderkey % 3 = 0 AS closed FROM orders)
    SELECT o_orderkey, NOT closed AND lo = hi AS empty, lo <= 20 AND (20 < hi OR closed AND hi = 20) AS has20, lo < 25 AND 15 < hi OR lo < 25 AND closed AND hi = 15 AS meets,
      CASE WHEN greatest(lo, 15) < least(hi, 25) THEN greatest(lo, 15) END AS common_lo, CASE WHEN greatest(lo, 15) < least(hi, 25) THEN least(hi, 25) END AS common_hi FROM r""", "tsrange daterange numrange int4range timerange bounds")
def q_range_functions(spark, sf_dir):
    lo, hi, closed = F.col("o_custkey") % 50, F.col("o_custkey") % 50 + F.col("o_orderkey") % 7, F.col("o_orderkey") % 3 == 0
    r = ranges.Range(lo, hi, upper_inclusive=closed)
    other = ranges.Range(F.lit(15), F.lit(25))
    both = r.intersection(other)
    return table(spark, sf_dir, "orders").select("o_orderkey", r.is_empty().alias("empty"), r.contains(F.lit(20)).alias("has20"), r.overlaps(other).alias("meets"), F.when(both.lo < both.hi, both.lo).alias("common_lo"), F.when(both.lo < both.hi, both.hi).alias("common_hi"))


@register("overlap_join", """
    WITH a AS (SELECT event_id, user_id, ts AS lo, ts + to_minutes(CAST(floor(value * 3) AS INTEGER)) AS hi FROM events WHERE value * 3 >= 1), b AS (SELECT event_id AS other, user_id, lo, hi FROM a WHERE event_id % 2 = 0)
    SELECT a.event_id, b.other FROM a JOIN b ON a.user_id = b.user_id AND a.event_id <> b.other AND a.lo < b.hi AND b.lo < a.hi""", "Range/array overlap &&")
def q_overlap_join(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    a = e.select("event_id", "user_id", F.col("ts").alias("lo"), (F.col("ts") + F.make_dt_interval(mins=F.floor(F.col("value") * 3).cast("int"))).alias("hi"))
    b = a.where("event_id % 2 = 0").select(F.col("event_id").alias("other"), "user_id", F.col("lo").alias("o_lo"), F.col("hi").alias("o_hi"))
    return ranges.overlap_join(a, b, "user_id", ("lo", "hi"), ("o_lo", "o_hi")).where("event_id <> other").select("event_id", "other")


# ---- statements that change a table, as tables before and after


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@register("update_from", "SELECT o_orderkey, o_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE o_orderstatus END AS o_orderstatus FROM orders LEFT JOIN customer ON o_custkey = c_custkey", "UPDATE FROM")
def q_update_from(spark, sf_dir):
    source = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), F.lit("B").alias("o_orderstatus"))
    return changes.update_from(_orders(spark, sf_dir), source, ["o_custkey"], ["o_orderstatus"])


@register("delete_using", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)", "DELETE USING")
def q_delete_using(spark, sf_dir):
    return changes.delete_using(_orders(spark, sf_dir), table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])


_KEPT, _CAME = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 3", "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 10 <> 7"


def _two(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return o.where("o_orderkey % 10 <> 3"), o.where("o_orderkey % 10 <> 7").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 1, "X").otherwise(F.col("o_orderstatus")))


@register("merge_into", f"""
    WITH o AS ({_KEPT}), n AS ({_CAME})
    SELECT n.* FROM n WHERE o_orderstatus <> 'F' UNION ALL SELECT o.* FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n) AND o_orderstatus <> 'P'
    UNION ALL SELECT o.* FROM o JOIN n USING (o_orderkey) WHERE n.o_orderstatus = 'F' AND false""", "MERGE INTO C14 matched delete")
def q_merge(spark, sf_dir):
    """Matched rows take the new values, or go where these say so; new rows come in; rows absent from the source go where they are pending."""
    old, new = _two(spark, sf_dir)
    return changes.merge(old, new, ["o_orderkey"], delete_matched=F.col("o_orderstatus") == "F", insert=F.col("o_orderstatus") != "F", delete_absent=F.col("o_orderstatus") == "P")


@register("layer_replaced", f"WITH n AS ({_CAME}) SELECT * FROM n", "G6 delete absent")
def q_layer(spark, sf_dir):
    old, new = _two(spark, sf_dir)
    return changes.merge(old, new, ["o_orderkey"], delete_absent=F.lit(True))


@register("insert_or_ignore", f"WITH o AS ({_KEPT}), n AS ({_CAME}) SELECT * FROM o UNION ALL SELECT * FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)", "ON CONFLICT DO NOTHING")
def q_ignore(spark, sf_dir):
    return changes.insert_new(*_two(spark, sf_dir), ["o_orderkey"])


@register("returning_chain", f"WITH o AS ({_KEPT}), n AS ({_CAME}) SELECT 'deleted' AS said, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n) UNION ALL SELECT 'inserted', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o) UNION ALL SELECT 'updated', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM o JOIN n USING (o_orderkey) WHERE o.o_orderstatus <> n.o_orderstatus", "RETURNING data-modifying CTE")
def q_returning(spark, sf_dir):
    said = changes.audit(*_two(spark, sf_dir), ["o_orderkey"])
    names = F.create_map(*[F.lit(x) for kv in {"D": "deleted", "I": "inserted", "U": "updated"}.items() for x in kv])
    return said.groupBy(names[F.col("action")].alias("said")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@register("serial_numbers", "SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders", "SEQUENCE serial nextval")
def q_serial(spark, sf_dir):
    return serial(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "id", 1001).select("o_orderkey", "id")


@register("dynamic_statement", "SELECT 'customer' AS source, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part", "Dynamic SQL EXECUTE format")
def q_dynamic(spark, sf_dir):
    """The same statement over tables that are named at run time."""
    parts = [spark.sql("SELECT :name AS source, count(*) AS n FROM {t}", args={"name": t}, t=table(spark, sf_dir, t)) for t in ("customer", "orders", "part")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("trigger_columns", "SELECT o_orderkey, upper(trim(o_orderstatus)) AS o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_totalprice > 200000 AS large FROM orders WHERE o_totalprice IS NOT NULL", "TRIGGER before insert")
def q_trigger(spark, sf_dir):
    """What row triggers do before an insert, as steps of the load: derived columns, and rows that are refused."""
    steps = {"o_orderstatus": F.upper(F.trim("o_orderstatus")), "day": F.to_date("o_orderdate"), "large": F.col("o_totalprice") > 200000}
    return changes.before_insert(table(spark, sf_dir, "orders"), steps, F.col("o_totalprice").isNotNull()).select("o_orderkey", *steps)


@register("transposed", "SELECT 'n' AS measure, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders UNION ALL SELECT 'customers', count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'F'), count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'O'), count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'P') FROM orders", "pandas transpose")
def q_transposed(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))
    long = rows.unpivot("o_orderstatus", ["n", "customers"], "measure", "v")
    return long.groupBy("measure").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.first("v")).fillna(0)


@register("dropped_nulls", "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'F') IS NOT NULL AND nullif(o_orderpriority, '5-LOW') IS NOT NULL", "pandas dropna")
def q_dropna(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("s"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return o.dropna(subset=["s", "p"]).select("o_orderkey")
