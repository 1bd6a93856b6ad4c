"""The relational surface: joins, grouping, windows, sets, sorts, subqueries, in Spark SQL and the DataFrame API."""

from pyspark.sql import functions as F

from curbline.operators.changes import latest
from curbline.operators.numbering import serial
from curbline.operators.stats import percentiles
from curbline.plans.registry import register
from curbline.sources.tables import table


def same(name: str, sql: str, covers: str = "") -> None:
    """Registers a query whose text both engines understand."""
    import re

    used = sorted(set(re.findall(r"\b(region|nation|customer|supplier|part|orders|lineitem|events|documents|pages|conversations|benchmark|labels)\b", sql)))

    def run(spark, sf_dir):
        if not used:
            return spark.sql(sql)
        text = re.sub(r"\b(" + "|".join(used) + r")\b(?!\.)", r"{\1}", sql)
        return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})

    register(name, sql, covers)(run)


CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"

same("join_inner_using", "SELECT n.n_name, count(*) AS customers FROM customer AS c JOIN nation AS n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name", "INNER JOIN")
same("join_left", "SELECT c.c_custkey, count(o.o_orderkey) AS orders_n FROM customer AS c LEFT JOIN orders AS o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey", "LEFT JOIN")
same("join_right", "SELECT s.s_suppkey, n.n_name FROM nation AS n RIGHT JOIN supplier AS s ON s.s_nationkey = n.n_nationkey AND n.n_regionkey = 1", "RIGHT JOIN")
same("join_full", "SELECT coalesce(c.k, s.k) AS k, c.customers, s.suppliers FROM (SELECT c_nationkey AS k, count(*) AS customers FROM customer GROUP BY 1) AS c FULL JOIN (SELECT s_nationkey + 5 AS k, count(*) AS suppliers FROM supplier GROUP BY 1) AS s ON c.k = s.k", "FULL JOIN E14")
same("join_cross", "SELECT r.r_name, x.v FROM region AS r CROSS JOIN (VALUES (1), (2), (3)) AS x(v)", "CROSS JOIN VALUES")
same("join_natural", "SELECT a.k, a.x, b.y FROM (SELECT n_nationkey AS k, n_name AS x FROM nation) AS a NATURAL JOIN (SELECT c_nationkey AS k, count(*) AS y FROM customer GROUP BY 1) AS b", "NATURAL JOIN")
same("join_semi_exists", "SELECT o_orderkey FROM orders AS o WHERE EXISTS (SELECT 1 FROM lineitem AS l WHERE l.l_orderkey = o.o_orderkey AND l.l_discount > 0.09)", "EXISTS")
same("join_anti_exists", "SELECT c_custkey FROM customer AS c WHERE NOT EXISTS (SELECT 1 FROM orders AS o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')", "NOT EXISTS")
same("in_subquery", "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50) AND p_brand NOT IN ('Brand#1', 'Brand#2')", "IN NOT IN")
same("scalar_subquery", "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.5 FROM orders)", "scalar subquery")
same("lateral_top", "SELECT c.c_custkey, t.o_orderkey FROM customer AS c, LATERAL (SELECT o.o_orderkey FROM orders AS o WHERE o.o_custkey = c.c_custkey ORDER BY o.o_totalprice DESC, o.o_orderkey LIMIT 2) AS t", "LATERAL")
same("theta_join", "SELECT s.s_suppkey, t.n_name FROM supplier AS s JOIN nation AS t ON s.s_nationkey > t.n_nationkey AND t.n_regionkey = 2", "theta join")
same("group_having", f"SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum({CENTS}) AS BIGINT) AS cents, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) > 10", "GROUP BY HAVING COUNT SUM MIN MAX")
same("grouping_sets", "SELECT l_returnflag, l_linestatus, grouping(l_linestatus) AS g, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_returnflag, l_linestatus), ())", "GROUPING SETS")
same("rollup_cube", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)", "ROLLUP CUBE")
same("agg_filter", "SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 200000) AS large, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderstatus", "FILTER COUNT DISTINCT")
same("agg_stats", "SELECT event_type, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(stddev_pop(value), 6) AS sd_pop FROM events GROUP BY event_type", "AVG STDDEV")
same("case_coalesce", "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice BETWEEN 100000 AND 300000 THEN 'mid' ELSE 'low' END AS band, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status, greatest(o_custkey, 500) AS g, least(o_custkey, 500) AS l FROM orders", "CASE COALESCE NULLIF GREATEST LEAST BETWEEN")
same("like_predicates", "SELECT p_partkey FROM part WHERE p_name LIKE '%ring%' OR p_name ILIKE 'RED%' OR p_brand LIKE 'Brand#1_'", "LIKE ILIKE")
same("distinct_from", "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'F') IS DISTINCT FROM 'O' AND nullif(o_orderpriority, '5-LOW') IS NOT NULL", "IS DISTINCT FROM IS NULL")
same("windows_rank", "SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS rk, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS dr FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)", "row_number rank dense_rank named WINDOW")
same("windows_lag_lead", "SELECT event_id, lag(event_id) OVER w AS prev, lead(event_id, 2) OVER w AS next2, first_value(event_id) OVER w AS first_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)", "lag lead")
same("windows_rows", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS n4, sum(event_id) OVER (PARTITION BY user_id) AS total FROM events", "ROWS frame aggregate OVER")
same("agg_of_agg", "SELECT o_orderpriority, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM orders GROUP BY o_orderpriority", "aggregate in window E12")
same("order_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25", "ORDER BY NULLS LIMIT")
same("union_all", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier", "UNION ALL")
same("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier", "UNION Q13")
same("except_sets", "SELECT p_brand, p_size FROM part EXCEPT SELECT p_brand, p_size FROM part WHERE p_type = 'SMALL' OR p_size > 40", "EXCEPT")
same("except_all", "SELECT p_brand, p_type FROM part EXCEPT ALL SELECT p_brand, p_type FROM part WHERE p_size > 25", "EXCEPT ALL E9")
same("intersect_sets", "SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9900 INTERSECT SELECT s_nationkey FROM supplier", "INTERSECT")
same("cte_chain", "WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT n, count(*) AS customers FROM a GROUP BY 1) SELECT * FROM b", "CTE")
same("recursive_cte", "WITH RECURSIVE t(n, s) AS (SELECT 1, CAST(1 AS BIGINT) UNION ALL SELECT n + 1, s + (n + 1) * 2 FROM t WHERE n < 40) SELECT n, s FROM t", "WITH RECURSIVE")
same("integer_division", "SELECT o_orderkey, CAST(floor(o_custkey / 7) AS BIGINT) AS q, o_custkey % 7 AS r, abs(o_custkey - 500) AS d FROM orders", "Q15 floor modulo abs")
same("string_scalars", "SELECT p_partkey, upper(p_name) AS u, lower(p_type) AS l, length(p_name) AS n, reverse(p_brand) AS r, replace(p_name, ' ', '_') AS w, substring(p_name, 2, 3) AS s, trim(concat(' ', p_name, ' ')) AS t, lpad(CAST(p_size AS VARCHAR(9)), 4, '0') AS p, left(p_name, 3) AS a, right(p_name, 3) AS z, split_part(p_name, ' ', 2) AS f FROM part", "string functions")
same("regex_scalars", "SELECT p_partkey, regexp_replace(p_brand, '^[A-Za-z]+#0*', 'B') AS b, nullif(regexp_extract(p_name, '^([a-z]+) (.+)$', 2), '') AS tail FROM part", "regexp_replace regexp_match")
same("date_scalars", "SELECT o_orderkey, date_trunc('month', o_orderdate) AS m, extract(year FROM o_orderdate) AS y, extract(hour FROM o_orderdate) AS h, quarter(o_orderdate) AS q FROM orders", "date_trunc EXTRACT")
same("math_scalars", "SELECT c_custkey, round(sin(radians(c_acctbal)), 8) AS s, round(cos(pi() / 3), 8) AS c, round(degrees(1.0), 6) AS d, round(c_acctbal, 1) AS r, CAST(floor(c_acctbal) AS BIGINT) AS f, sign(c_acctbal) AS g FROM customer", "math functions")
same("levenshtein_names", "SELECT a.p_partkey AS a, b.n_nationkey AS b, levenshtein(a.p_name, b.n_name) AS d FROM part AS a CROSS JOIN nation AS b", "levenshtein")


@register("distinct_on", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey", "DISTINCT ON G3")
def q_distinct_on(spark, sf_dir):
    return latest(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], F.desc("o_totalprice"), "o_orderkey")


@register("percentiles", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.05), 4) AS p05, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.85), 4) AS p85, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem GROUP BY 1", "PERCENTILE_CONT")
def q_percentiles(spark, sf_dir):
    ladder = percentiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", {"p05": 0.05, "p50": 0.5, "p85": 0.85, "p95": 0.95})
    return ladder.select("l_returnflag", *[F.round(n, 4).alias(n) for n in ("p05", "p50", "p85", "p95")])


@register("array_agg_ordered", "SELECT o_custkey, list(o_orderkey ORDER BY o_orderdate, o_orderkey) AS keys, string_agg(o_orderstatus, ',' ORDER BY o_orderdate, o_orderkey) AS statuses FROM orders GROUP BY 1", "array_agg string_agg")
def q_array_agg(spark, sf_dir):
    seq = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(seq.alias("s"))
    return rows.select("o_custkey", F.col("s.o_orderkey").alias("keys"), F.array_join("s.o_orderstatus", ",").alias("statuses"))


@register("pivot_status", "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1", "pivot pandas pivot_table unstack")
def q_pivot(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)


@register("width_buckets", "SELECT CASE WHEN l_quantity < 0 THEN 0 WHEN l_quantity >= 50 THEN 6 ELSE CAST(floor(l_quantity / 10) AS BIGINT) + 1 END AS bucket, count(*) AS n FROM lineitem GROUP BY 1", "width_bucket E13")
def q_width(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.width_bucket("l_quantity", F.lit(0.0), F.lit(50.0), F.lit(5)).alias("bucket")).agg(F.count("*").alias("n"))


@register("json_access", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events", "-> ->>")
def q_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@register("json_build", """SELECT n_nationkey, '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS doc FROM nation""", "json_build_object json_build_array")
def q_json_build(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("doc"))


@register("json_each", "SELECT key, count(*) AS n, CAST(sum(CAST(val AS INTEGER)) AS BIGINT) AS total FROM (SELECT unnest(json_keys(props)) AS key, json_extract_string(props, '$.k') AS val FROM events) GROUP BY key", "json_each")
def q_json_each(spark, sf_dir):
    pairs = table(spark, sf_dir, "events").select(F.explode(F.from_json("props", "map<string,string>")).alias("key", "val"))
    return pairs.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("val").cast("int")).alias("total"))


@register("array_functions", "SELECT vec_id, len(embedding) AS n, round(CAST(embedding[1] AS DOUBLE), 6) AS first, len(list_filter(embedding, lambda x: x > 0)) AS positive, label = ANY([1, 3]) AS odd FROM embeddings", "ARRAY[] array_length subscript = ANY")
def q_arrays(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").cast("long").alias("n"), F.round(F.col("embedding")[0].cast("double"), 6).alias("first"), F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("positive"), F.array_contains(F.array(F.lit(1), F.lit(3)), F.col("label")).alias("odd"))


@register("isodow_holidays", "SELECT CAST(ts AS DATE) AS day, isodow(ts) AS dow, isodow(ts) > 5 OR CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') AS off, count(*) AS n FROM events GROUP BY ALL", "ISODOW D7 holiday lookup")
def q_isodow(spark, sf_dir):
    holidays = spark.createDataFrame([("2024-01-01",), ("2024-01-15",)], "dt string").select(F.to_date("dt").alias("day"), F.lit(True).alias("holiday"))
    daily = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    off = (F.weekday("day") >= 5) | F.coalesce("holiday", F.lit(False))
    return daily.join(F.broadcast(holidays), "day", "left").select("day", (F.weekday("day") + 1).alias("dow"), off.alias("off"), "n")


@register("time_zones", "SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local, strftime(ts, '%Y-%m-%d %H:%M') AS label FROM events", "AT TIME ZONE to_char")
def q_zones(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("ts")).alias("local"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("label"))


@register("unnest_series", "SELECT n_nationkey, unnest(range(n_regionkey + 1)) AS i FROM nation", "generate_series unnest")
def q_unnest(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(F.sequence(F.lit(0), F.col("n_regionkey"))).alias("i"))


@register("value_counts", "SELECT p_type, count(*) AS n, rank() OVER (ORDER BY count(*) DESC, p_type) AS place FROM part GROUP BY 1", "pandas value_counts")
def q_value_counts(spark, sf_dir):
    counts = table(spark, sf_dir, "part").groupBy("p_type").agg(F.count("*").alias("n")).withColumn("less", -F.col("n"))
    return serial(counts, ["less", "p_type"], "place").select("p_type", "n", F.col("place").cast("int").alias("place"))
