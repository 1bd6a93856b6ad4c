"""Monthly summaries, upkeep of anomalies, and daily tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from curbline.functions.timebin import floor_bin
from curbline.operators import anomalies, changes, stats
from curbline.plans.registry import register
from curbline.session import checkpointed
from curbline.sources.tables import table

#: Steps of the ladder of percentiles, and of the histogram of speeds: fixed values.
LADDER = list(range(5, 100, 5))
STEPS = list(range(0, 105, 5))


@register("monthly_speeds", f"""
    SELECT event_type, date_trunc('month', ts) AS mon, {", ".join(f"CAST(round_even(quantile_cont(value, {p / 100}), 0) AS INTEGER) AS pct_{p:02}" for p in LADDER)},
      {", ".join(f"count(*) FILTER (WHERE value >= {s}" + (f" AND value < {s + 5}" if s < 100 else "") + f") AS spd_{s:02}" for s in STEPS)}, count(*) AS n FROM events GROUP BY ALL""", "E1")
def q_monthly(spark, sf_dir):
    """The ladder of percentiles and the histogram of a month in one row; bins without counts are 0."""
    e = table(spark, sf_dir, "events").select("event_type", F.date_trunc("month", "ts").cast("timestamp_ntz").alias("mon"), "value")
    keys = ["event_type", "mon"]
    bins = F.least(F.floor(F.col("value") / 5) * 5, F.lit(100)).cast("int")
    pivot = e.withColumn("bin", bins).groupBy(*keys).pivot("bin", STEPS).agg(F.count(F.lit(1))).fillna(0)
    pivot = pivot.select(*keys, *[F.col(str(s)).alias(f"spd_{s:02}") for s in STEPS]).withColumn("n", sum((F.col(f"spd_{s:02}") for s in STEPS[1:]), F.col("spd_00")))
    ladder = stats.percentiles(e, keys, "value", {f"pct_{p:02}": p / 100 for p in LADDER})
    return pivot.join(ladder, keys).select(*keys, *[F.rint(f"pct_{p:02}").cast("int").alias(f"pct_{p:02}") for p in LADDER], *[f"spd_{s:02}" for s in STEPS], "n")


@register("corridor_periods", """
    WITH l AS (SELECT user_id % 10 AS corridor, user_id AS link, CAST(ts AS DATE) AS day, hour(ts) AS hr, avg((100 + user_id) * 0.001 / (value + 5) * 3600) AS tt, any_value(100 + user_id) AS len FROM events GROUP BY ALL),
    t AS (SELECT corridor, sum(len) AS total FROM (SELECT DISTINCT corridor, link, len FROM l) GROUP BY 1),
    c AS (SELECT corridor, day, hr, total / (sum(len) / sum(tt)) AS tt FROM l JOIN t USING (corridor) GROUP BY corridor, day, hr, total HAVING sum(len) >= 0.1 * total),
    p AS (SELECT corridor, day, CASE WHEN hr BETWEEN 7 AND 9 THEN 'am' WHEN hr BETWEEN 10 AND 15 THEN 'midday' WHEN hr BETWEEN 16 AND 18 THEN 'pm' ELSE 'night' END AS period, avg(tt) AS tt FROM c GROUP BY ALL)
    SELECT corridor, period, count(*) AS days, round(min(tt), 6) AS least, round(avg(tt), 6) AS mean, round(max(tt), 6) AS most FROM p GROUP BY ALL""", "D10")
def q_corridor_periods(spark, sf_dir):
    """Link times by hour, corridors where a tenth of the length is covered, then by period of a day, then over days."""
    length, hour = 100 + F.col("user_id"), F.hour("ts")
    l = checkpointed(table(spark, sf_dir, "events").groupBy((F.col("user_id") % 10).alias("corridor"), F.col("user_id").alias("link"), F.to_date("ts").alias("day"), hour.alias("hr")).agg(F.avg(length * 0.001 / (F.col("value") + 5) * 3600).alias("tt"), F.first(length).alias("len")))
    total = l.select("corridor", "link", "len").distinct().groupBy("corridor").agg(F.sum("len").alias("total"))
    c = l.groupBy("corridor", "day", "hr").agg(F.sum("len").alias("covered"), F.sum("tt").alias("s")).join(total, "corridor").where("covered >= 0.1 * total")
    hr = F.col("hr")
    period = F.when(hr.between(7, 9), "am").when(hr.between(10, 15), "midday").when(hr.between(16, 18), "pm").otherwise("night")
    p = c.groupBy("corridor", "day", period.alias("period")).agg(F.avg(F.col("total") / (F.col("covered") / F.col("s"))).alias("tt"))
    return p.groupBy("corridor", "period").agg(F.count("*").alias("days"), F.round(F.min("tt"), 6).alias("least"), F.round(F.avg("tt"), 6).alias("mean"), F.round(F.max("tt"), 6).alias("most"))


@register("merged_histograms", """
    WITH a AS (SELECT o_custkey AS site, CAST(sum(o_orderkey % 7) AS BIGINT) AS slow, CAST(sum(o_orderkey % 5) AS BIGINT) AS fast FROM orders GROUP BY 1),
    b AS (SELECT c_custkey AS site, CAST(sum(c_custkey % 7 + c_nationkey) AS BIGINT) AS slow, CAST(sum(c_custkey % 5) AS BIGINT) AS fast FROM customer GROUP BY 1),
    c AS (SELECT l_suppkey AS site, CAST(sum(l_linenumber) AS BIGINT) AS slow, CAST(sum(l_orderkey % 5) AS BIGINT) AS fast FROM lineitem GROUP BY 1)
    SELECT site, slow + fast AS volume FROM a UNION SELECT site, slow + fast FROM b UNION SELECT site, slow + fast FROM c""", "B8 Q13")
def q_merged_histograms(spark, sf_dir):
    """Wide columns of three sources summed and added up; equal rows of different sources are one."""
    parts = [("orders", "o_custkey", ["o_orderkey % 7", "o_orderkey % 5"]), ("customer", "c_custkey", ["c_custkey % 7 + c_nationkey", "c_custkey % 5"]), ("lineitem", "l_suppkey", ["l_linenumber", "l_orderkey % 5"])]
    sums = [table(spark, sf_dir, t).groupBy(F.col(k).alias("site")).agg(sum((F.sum(F.expr(c)) for c in columns[1:]), F.sum(F.expr(columns[0]))).alias("volume")) for t, k, columns in parts]
    return sums[0].unionByName(sums[1]).unionByName(sums[2]).distinct()


@register("score_shares", "SELECT hour(ts) AS hr, CAST(floor(value / 20) * 20 AS BIGINT) AS score, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY hour(ts)), 6) AS share FROM events GROUP BY 1, 2", "E12")
def q_scores(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy(F.hour("ts").alias("hr"), (F.floor(F.col("value") / 20) * 20).alias("score")).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("hr")), 6))


_COUNTS = "SELECT user_id, event_type, event_id % 2 AS leg, CAST(ts AS DATE) AS day, CASE WHEN value > 60 THEN 1 ELSE 0 END AS v FROM events"


@register("zero_upkeep", f"""
    WITH c AS (SELECT * FROM ({_COUNTS}) WHERE day = DATE '2024-01-05'),
    g AS (SELECT user_id, event_type, leg, CAST(sum(v) AS BIGINT) AS v FROM c GROUP BY GROUPING SETS ((user_id), (user_id, event_type), (user_id, event_type, leg))), z AS (SELECT * FROM g WHERE v = 0),
    k AS (SELECT user_id, event_type, leg FROM z a WHERE event_type IS NULL OR (leg IS NULL AND NOT EXISTS (SELECT 1 FROM z b WHERE b.user_id = a.user_id AND b.event_type IS NULL))
      OR (leg IS NOT NULL AND NOT EXISTS (SELECT 1 FROM z b WHERE b.user_id = a.user_id AND (b.event_type IS NULL OR (b.event_type = a.event_type AND b.leg IS NULL))))),
    r AS (SELECT DISTINCT user_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'click' END AS event_type, CAST(NULL AS BIGINT) AS leg, DATE '2024-01-01' AS s, CASE WHEN user_id % 4 = 0 THEN DATE '2024-01-05' WHEN user_id % 4 = 1 THEN NULL ELSE DATE '2024-01-03' END AS e, user_id % 8 <> 4 AS automatic FROM events),
    x AS (SELECT k.*, (SELECT min(s) FROM r WHERE automatic AND r.user_id = k.user_id AND r.event_type IS NOT DISTINCT FROM k.event_type AND r.leg IS NOT DISTINCT FROM k.leg AND e = DATE '2024-01-05') AS since FROM k)
    SELECT user_id, event_type, leg, coalesce(since, DATE '2024-01-05') AS range_start, DATE '2024-01-06' AS range_end, CASE WHEN since IS NULL THEN 'insert' ELSE 'extend' END AS action FROM x
    WHERE since IS NOT NULL OR NOT EXISTS (SELECT 1 FROM r WHERE r.user_id = x.user_id AND (r.event_type IS NULL OR r.event_type IS NOT DISTINCT FROM x.event_type) AND (r.leg IS NULL OR r.leg IS NOT DISTINCT FROM x.leg) AND s <= DATE '2024-01-05' AND (e IS NULL OR e >= DATE '2024-01-06'))""", "C9 C15 Q1 GROUPING SETS")
def q_zero_upkeep(spark, sf_dir):
    """A day's sensors, classes and legs without large readings against the ranges that are known."""
    e = table(spark, sf_dir, "events")
    day = e.where("to_date(ts) = DATE'2024-01-05'").select("user_id", "event_type", (F.col("event_id") % 2).alias("leg"), F.when(F.col("value") > 60, 1).otherwise(0).alias("v"))
    u, at = F.col("user_id"), lambda d: F.lit(d).cast("date")
    known = e.select("user_id").distinct().select(
        "user_id", F.when(u % 3 != 0, "click").alias("event_type"), F.lit(None).cast("long").alias("leg"), at("2024-01-01").alias("range_start"),
        F.when(u % 4 == 0, at("2024-01-05")).when(u % 4 != 1, at("2024-01-03")).alias("range_end"), (u % 8 != 4).alias("automatic"),
    )
    keys = ["user_id", "event_type", "leg"]
    return anomalies.range_upkeep(anomalies.zero_levels(day, keys, "v"), known, keys, at("2024-01-05"), at("2024-01-06"))


@register("daily_volumes", """
    WITH m AS (SELECT user_id, time_bucket(INTERVAL 1 MINUTE, ts) AS ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS volume FROM events GROUP BY ALL),
    d AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum(volume) AS BIGINT) AS volume, 1440 - count(DISTINCT ts) AS missing_minutes FROM m GROUP BY ALL),
    h AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, hour(ts) AS hour FROM m), u AS (SELECT user_id, hour(ts) AS hour, CAST(sum(volume) AS BIGINT) / count(DISTINCT CAST(ts AS DATE)) AS per_hour FROM m GROUP BY ALL),
    g AS (SELECT d.user_id, d.day, x.hour FROM d CROSS JOIN (SELECT unnest(range(7, 19)) AS hour) x WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.user_id = d.user_id AND h.day = d.day AND h.hour = x.hour)),
    l AS (SELECT g.user_id, day, CAST(count(*) * 60 AS BIGINT) AS gap_minutes, sum(60 * coalesce(per_hour, 0) / 60) AS missing_volume FROM g LEFT JOIN u ON u.user_id = g.user_id AND u.hour = g.hour GROUP BY ALL),
    n AS (SELECT user_id, CAST(ts AS DATE) AS day, CASE event_type WHEN 'error' THEN 2 ELSE 1 END AS rank, CASE event_type WHEN 'error' THEN 'faults' ELSE 'sales' END AS caveat FROM events WHERE event_type IN ('error', 'purchase')),
    s AS (SELECT user_id, day, list(caveat ORDER BY rank) AS caveats FROM (SELECT DISTINCT user_id, day, rank, caveat FROM n) GROUP BY ALL)
    SELECT d.user_id, d.day, volume, missing_minutes, coalesce(gap_minutes, 0) AS gap_minutes, round(coalesce(missing_volume, 0), 3) AS missing_volume, array_to_string(coalesce(caveats, []), ',') AS caveats
    FROM d LEFT JOIN l ON l.user_id = d.user_id AND l.day = d.day LEFT JOIN s ON s.user_id = d.user_id AND s.day = d.day WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = d.user_id AND CAST(e.ts AS DATE) = d.day AND e.value > 250)""", "C13 FILTER HAVING")
def q_daily_volumes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    m = checkpointed(e.groupBy("user_id", floor_bin("ts", 1).alias("ts")).agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("volume")))
    day, hour = F.to_date("ts"), F.hour("ts")
    hours = F.collect_set(F.hour("ts"))
    seen = m.groupBy("user_id", day.alias("day")).agg(hours.alias("h"))
    gaps = seen.select("user_id", "day", F.explode(F.array_except(F.array(*[F.lit(h) for h in range(7, 19)]), "h")).alias("hour")).withColumn("gap_minutes", F.lit(60).cast("long"))
    usual = m.groupBy("user_id", hour.alias("hour")).agg((F.sum("volume") / F.count_distinct(F.to_date("ts"))).alias("per_hour"))
    bad = e.where("value > 250").select("user_id", day.alias("day"))
    fault = F.col("event_type") == "error"
    notes = e.where("event_type in ('error', 'purchase')").select("user_id", day.alias("day"), F.when(fault, 2).otherwise(1).alias("rank"), F.when(fault, "faults").otherwise("sales").alias("caveat"))
    out = anomalies.daily_volumes(m, gaps, usual, bad, notes, "user_id", 1440)
    return out.withColumn("missing_volume", F.round("missing_volume", 3)).withColumn("caveats", F.array_join("caveats", ","))


@register("issues_synced", """
    WITH a AS (SELECT user_id, date_trunc('week', ts) AS w, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS alerts FROM events WHERE value > 150 GROUP BY 1, 2),
    old AS (SELECT user_id, w, CASE WHEN user_id % 3 = 0 THEN alerts ELSE 'x' END AS alerts FROM a WHERE user_id % 5 > 0 UNION ALL SELECT DISTINCT user_id, TIMESTAMP '2023-12-04', 'gone' FROM events)
    SELECT coalesce(a.user_id, old.user_id) AS user_id, coalesce(a.w, old.w) AS week, a.alerts, CASE WHEN old.user_id IS NULL THEN 'I' WHEN a.user_id IS NULL THEN 'D' WHEN a.alerts <> old.alerts THEN 'U' ELSE 'same' END AS action
    FROM a FULL JOIN old ON a.user_id = old.user_id AND a.w = old.w""", "C14 MERGE delete absent")
def q_issues_synced(spark, sf_dir):
    """Open issues brought up to date: alerts of a week in one text; absent ones go. With what was done to each."""
    e = table(spark, sf_dir, "events")
    week = F.date_trunc("week", "ts").cast("timestamp_ntz")
    new = checkpointed(e.where("value > 150").groupBy("user_id", week.alias("week")).agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("alerts")))
    old = new.where("user_id % 5 > 0").withColumn("alerts", F.when(F.col("user_id") % 3 == 0, F.col("alerts")).otherwise("x"))
    old = checkpointed(old.unionByName(e.select("user_id").distinct().select("user_id", F.lit("2023-12-04 00:00:00").cast("timestamp_ntz").alias("week"), F.lit("gone").alias("alerts"))))
    after = changes.merge(old, new, ["user_id", "week"], delete_absent=F.lit(True))
    log = changes.audit(old, new, ["user_id", "week"]).select("user_id", "week", "action")
    return after.join(log, ["user_id", "week"], "full").select("user_id", "week", "alerts", F.coalesce("action", F.lit("same")).alias("action"))
