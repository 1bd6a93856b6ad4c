"""Binning, padding, gaps and outages over ``events`` (sensor = user_id, class = event_type, volume = value)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from curbline.functions.timebin import floor_bin, is_weekend, routine_bins, shifted_bin
from curbline.operators.gaps import day_runs, find_gaps, islands, network_outages, outages, row_window, sessions, unacceptable_gaps
from curbline.operators.padding import padded_for_new, padded_sums
from curbline.operators.ranges import coarsest, cut_out, merge_ranges
from curbline.plans.registry import register
from curbline.sources.tables import table


@register(
    "padded_15min",
    """
    WITH agg AS (
      SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts) AS bin, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT)) AS cents
      FROM events GROUP BY ALL),
    spine AS (SELECT unnest(generate_series(min(bin), max(bin), INTERVAL 15 MINUTE)) AS bin FROM agg)
    SELECT k.event_type, s.bin, coalesce(a.n, 0) AS n, CAST(coalesce(a.cents, 0) AS BIGINT) AS cents
    FROM (SELECT DISTINCT event_type FROM agg) k CROSS JOIN spine s LEFT JOIN agg a USING (event_type, bin)
    """,
    covers="B1 B3 I",
)
def padded_15min(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("bin", floor_bin("ts", 15))
    return padded_sums(events, ["event_type"], "bin", 15, n=F.count("*"), cents=F.sum(F.round(F.col("value") * 100).cast("long")))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))


CENTS = "CAST(round(value * 100) AS BIGINT)"


@register("shifted_5min", f"""
    SELECT time_bucket(INTERVAL 5 MINUTE, ts - INTERVAL 1 SECOND) AS bin, count(*) AS n, CAST(sum({CENTS}) AS BIGINT) AS cents FROM events GROUP BY 1""", "B2")
def q_shifted(spark, sf_dir):
    return _events(spark, sf_dir).groupBy(shifted_bin("ts", 5).alias("bin")).agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


_LIFE = "b AS (SELECT time_bucket(INTERVAL 15 MINUTE, min(ts)) AS lo, time_bucket(INTERVAL 15 MINUTE, max(ts)) + INTERVAL 15 MINUTE AS hi FROM events)"
_GAPS = f"""{_LIFE},
    p AS (SELECT DISTINCT user_id, time_bucket(INTERVAL 15 MINUTE, ts) AS dt, 15 AS covers FROM events),
    e AS (SELECT * FROM p UNION ALL SELECT DISTINCT user_id, lo, 0 FROM p, b UNION ALL SELECT DISTINCT user_id, hi, 0 FROM p, b),
    s AS (SELECT user_id, dt + to_minutes(covers) AS gap_start, lead(dt) OVER (PARTITION BY user_id ORDER BY dt, covers) AS gap_end FROM e),
    g AS (SELECT *, date_diff('minute', gap_start, gap_end) AS gap_minutes FROM s WHERE gap_end - gap_start >= INTERVAL 24 HOUR)"""


@register("generic_gaps", f"WITH {_GAPS} SELECT user_id, gap_start, gap_end, gap_minutes FROM g", "C1")
def q_gaps(spark, sf_dir):
    """Between the first and the last bin of the whole table."""
    bins = table(spark, sf_dir, "events").select("user_id", floor_bin("ts", 15).alias("bin"))
    start, end = bins.agg(F.min("bin").cast("string"), (F.max("bin") + F.expr("INTERVAL 15 MINUTES")).cast("string")).first()
    return find_gaps(bins, "user_id", "bin", start, end, 15, 24 * 60)


@register("gap_summary", f"WITH {_GAPS} SELECT count(*) = 0 AS ok, count(*) AS gaps, count(DISTINCT user_id) AS sensors, max(gap_minutes) AS longest FROM g", "C2")
def q_gap_summary(spark, sf_dir):
    return q_gaps(spark, sf_dir).agg((F.count("*") == 0).alias("ok"), F.count("*").alias("gaps"), F.count_distinct("user_id").alias("sensors"), F.max("gap_minutes").alias("longest"))



@register("unacceptable_gaps", f"""
    WITH {_GAPS}, t AS (SELECT user_id, CASE WHEN count(*) >= 60 THEN 1440 WHEN count(*) >= 40 THEN 2000 ELSE 3000 END AS tolerance FROM events GROUP BY 1),
    x AS (SELECT g.*, unnest(generate_series(time_bucket(INTERVAL 1 HOUR, gap_start), time_bucket(INTERVAL 1 HOUR, gap_end - INTERVAL 1 SECOND), INTERVAL 1 HOUR)) AS bin FROM g JOIN t USING (user_id) WHERE gap_minutes >= tolerance)
    SELECT user_id, bin, gap_start, gap_end, gap_minutes, date_diff('second', greatest(gap_start, bin), least(gap_end, bin + INTERVAL 1 HOUR)) AS seconds_in_bin
    FROM x QUALIFY row_number() OVER (PARTITION BY user_id, bin ORDER BY gap_minutes DESC, gap_start) = 1""", "C3")
def q_unacceptable(spark, sf_dir):
    """The tolerance of a sensor follows its volume."""
    n = F.count("*")
    tolerance = table(spark, sf_dir, "events").groupBy("user_id").agg(F.when(n >= 60, 1440).when(n >= 40, 2000).otherwise(3000).alias("tolerance"))
    return unacceptable_gaps(q_gaps(spark, sf_dir).join(tolerance, "user_id"), "user_id", F.col("tolerance"), 60).select("user_id", "bin", "gap_start", "gap_end", "gap_minutes", "seconds_in_bin")


#: Holidays of the month of the test tables, and study days for which a tolerance is wanted: fixed values.
HOLIDAYS = ["2024-01-01", "2024-01-15"]
_HOLIDAYS = "(VALUES (DATE '2024-01-01'), (DATE '2024-01-15')) h(dt)"
_OFF = "(isodow({0}) > 5 OR CAST({0} AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15'))"


def _off(day):
    return is_weekend(day) | day.isin([F.lit(d).cast("date") for d in HOLIDAYS])


@register("gap_tolerance", f"""
    WITH h AS (SELECT user_id, event_type, CAST(ts AS DATE) AS dt, hour(ts) AS hour_bin, {_OFF.format("any_value(ts)")} AS weekend, sum({CENTS}) AS v FROM events GROUP BY GROUPING SETS ((user_id, event_type, CAST(ts AS DATE), hour(ts)), (user_id, CAST(ts AS DATE), hour(ts)))),
    s AS (SELECT DATE '2024-01-29' AS dt UNION ALL SELECT DATE '2024-01-30'),
    k AS (SELECT DISTINCT user_id, event_type, hour_bin FROM h),
    a AS (SELECT * FROM h UNION ALL SELECT user_id, event_type, s.dt, hour_bin, {_OFF.format("s.dt")}, NULL FROM k CROSS JOIN s),
    w AS (SELECT *, sum(v) OVER w AS past, count(v) OVER w AS days FROM a WINDOW w AS (PARTITION BY user_id, event_type, hour_bin, weekend ORDER BY dt RANGE BETWEEN INTERVAL 60 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT DISTINCT user_id, event_type, dt, hour_bin, weekend, CAST(past AS BIGINT) AS past_cents, days AS past_days,
      CASE WHEN event_type IS NULL THEN CASE WHEN past >= 6000 * days THEN 5 WHEN past >= 3000 * days THEN 10 WHEN past >= 1000 * days THEN 15 ELSE 20 END END AS tolerance
    FROM w WHERE dt IN (SELECT dt FROM s) AND past IS NOT NULL""", "C4 E6 RANGE frame GROUPING SETS")
def q_tolerance(spark, sf_dir):
    """Study days get the mean of up to 60 days of their kind before them, by class and in all; they are padded, so that a day without rows has one too."""
    e = _events(spark, sf_dir).select("user_id", "event_type", F.to_date("ts").alias("dt"), F.hour("ts").alias("hour_bin"), "cents")
    h = e.groupingSets([["user_id", "event_type", "dt", "hour_bin"], ["user_id", "dt", "hour_bin"]], "user_id", "event_type", "dt", "hour_bin").agg(F.sum("cents").alias("v"))
    study = spark.sql("SELECT explode(array(DATE'2024-01-29', DATE'2024-01-30')) AS dt")
    padded = h.select("user_id", "event_type", "hour_bin").distinct().join(F.broadcast(study), how="cross").withColumn("v", F.lit(None).cast("long"))
    every = h.unionByName(padded).withColumn("weekend", _off(F.col("dt")))
    w = Window.partitionBy("user_id", "event_type", "hour_bin", "weekend").orderBy(F.datediff("dt", F.lit("2000-01-01"))).rangeBetween(-60, -1)
    a = every.select("user_id", "event_type", "dt", "hour_bin", "weekend", F.sum("v").over(w).alias("past_cents"), F.count("v").over(w).alias("past_days"))
    per = lambda n: F.col("past_cents") >= n * F.col("past_days")
    of_all = F.when(per(6000), 5).when(per(3000), 10).when(per(1000), 15).otherwise(20)
    found = a.join(F.broadcast(study), "dt", "left_semi").where("past_cents is not null").distinct()
    return found.withColumn("tolerance", F.when(F.col("event_type").isNull(), of_all))


@register("rolling_averages", f"""
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum({CENTS}) AS BIGINT) AS cents FROM events GROUP BY ALL)
    SELECT user_id, day, cents, CAST(sum(cents) OVER w7 AS BIGINT) AS week, count(*) OVER w7 AS week_days, CAST(sum(cents) OVER w60 AS BIGINT) AS season FROM d
    WINDOW w7 AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), w60 AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 59 DAY PRECEDING AND CURRENT ROW)""", "E6 rolling")
def q_rolling(spark, sf_dir):
    d = _events(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum("cents").alias("cents"))
    by = Window.partitionBy("user_id").orderBy(F.datediff("day", F.lit("2000-01-01")))
    week, season = by.rangeBetween(-6, 0), by.rangeBetween(-59, 0)
    return d.select("user_id", "day", "cents", F.sum("cents").over(week).alias("week"), F.count("*").over(week).alias("week_days"), F.sum("cents").over(season).alias("season"))


@register("rolling_hour", f"""
    SELECT event_id, count(*) OVER w AS n, CAST(sum({CENTS}) OVER w AS BIGINT) AS cents FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW)""", "E6 60 minutes")
def q_rolling_hour(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-60 * 60 * 1_000_000, 0)
    return _events(spark, sf_dir).select("event_id", F.count("*").over(w).alias("n"), F.sum("cents").over(w).alias("cents"))


@register("padded_new_sensors", """
    WITH k AS (SELECT s_suppkey, TIMESTAMP '2024-01-01' + to_minutes(CAST(s_suppkey * 60 AS INTEGER)) AS begun, CASE WHEN s_suppkey % 3 = 0 THEN TIMESTAMP '2024-01-01' + to_minutes(CAST(s_suppkey * 60 + 600 AS INTEGER)) END AS ended FROM supplier),
    l AS (SELECT s_suppkey, greatest(begun, TIMESTAMP '2024-01-02') AS lo, least(coalesce(ended, TIMESTAMP '2024-01-04'), TIMESTAMP '2024-01-04') AS hi FROM k)
    SELECT s_suppkey, unnest(generate_series(lo, hi - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS bin, 0 AS volume FROM l WHERE lo < hi""", "B4")
def q_padded_new(spark, sf_dir):
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    begun = at("2024-01-01 00:00:00") + F.make_dt_interval(mins=(F.col("s_suppkey") * 60).cast("int"))
    k = table(spark, sf_dir, "supplier").select("s_suppkey", begun.alias("begun"), F.when(F.col("s_suppkey") % 3 == 0, begun + F.expr("INTERVAL 10 HOURS")).alias("ended"))
    return padded_for_new(k, "s_suppkey", "begun", "ended", at("2024-01-02 00:00:00"), at("2024-01-04 00:00:00"), 15, volume=F.lit(0))


@register("islands", """
    WITH b AS (SELECT DISTINCT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS bin FROM events),
    r AS (SELECT *, date_diff('hour', TIMESTAMP '2000-01-01', bin) - row_number() OVER (PARTITION BY user_id ORDER BY bin) AS run FROM b)
    SELECT user_id, min(bin) AS "start", max(bin) AS "end", count(*) AS bins FROM r GROUP BY user_id, run""", "C5")
def q_islands(spark, sf_dir):
    return islands(table(spark, sf_dir, "events").select("user_id", floor_bin("ts", 60).alias("bin")), "user_id", "bin", 60)


@register("sensor_outages", """
    WITH b AS (SELECT user_id, time_bucket(INTERVAL 15 MINUTE, ts) AS bin FROM events GROUP BY ALL HAVING sum(value) > 0),
    p AS (SELECT user_id, bin, lag(bin) OVER (PARTITION BY user_id ORDER BY bin) AS previous FROM b)
    SELECT user_id, previous + INTERVAL 15 MINUTE AS outage_start, bin - INTERVAL 15 MINUTE AS outage_end, date_diff('minute', previous, bin) // 15 - 1 AS bins_missing
    FROM p WHERE previous < bin - INTERVAL 30 MINUTE""", "C6")
def q_outages(spark, sf_dir):
    counted = table(spark, sf_dir, "events").groupBy("user_id", floor_bin("ts", 15).alias("bin")).agg(F.sum("value").alias("v")).where("v > 0")
    return outages(counted.select("user_id", "bin"), "user_id", "bin", 15)


@register("network_outages", """
    WITH u AS (SELECT time_bucket(INTERVAL 5 MINUTE, max(ts)) + INTERVAL 1 HOUR AS bin FROM events), b AS (SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, ts) AS bin FROM events UNION SELECT bin FROM u),
    p AS (SELECT bin, lag(bin) OVER (ORDER BY bin) AS previous FROM b)
    SELECT 'network' AS scope, previous + INTERVAL 5 MINUTE AS outage_start, bin - INTERVAL 5 MINUTE AS outage_end, date_diff('minute', previous, bin) // 5 - 1 AS bins_missing
    FROM p WHERE previous < bin - INTERVAL 10 MINUTE""", "C6 network ongoing")
def q_network(spark, sf_dir):
    bins = table(spark, sf_dir, "events").select(floor_bin("ts", 5).alias("bin"))
    now = bins.agg((F.max("bin") + F.expr("INTERVAL 1 HOUR")).cast("string")).first()[0]
    return network_outages(bins, "bin", 5, until=F.lit(now).cast("timestamp_ntz"))


_CALENDAR = """
    cal AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day),
    d AS (SELECT u.user_id, cal.day, count(e.event_id) AS n FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN cal
          LEFT JOIN events e ON e.user_id = u.user_id AND CAST(e.ts AS DATE) = cal.day GROUP BY ALL)"""


def _calendar_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-30')) AS day")
    counts = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("event_id").alias("n"))
    return e.select("user_id").distinct().join(F.broadcast(days), how="cross").join(counts, ["user_id", "day"], "left").fillna(0, ["n"])


@register("day_outage_runs", f"""
    WITH cal AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day),
    d AS (SELECT u.user_id, cal.day, count(DISTINCT time_bucket(INTERVAL 12 HOUR, e.ts)) AS bins FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN cal LEFT JOIN events e ON e.user_id = u.user_id AND CAST(e.ts AS DATE) = cal.day GROUP BY ALL),
    f AS (SELECT *, bins <> 2 AS o, CASE WHEN (bins <> 2) IS NOT DISTINCT FROM lag(bins <> 2) OVER (PARTITION BY user_id ORDER BY day) THEN 0 ELSE 1 END AS turn FROM d),
    r AS (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY day) AS run FROM f)
    SELECT user_id, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM r WHERE o GROUP BY user_id, run""", "C7")
def q_day_runs(spark, sf_dir):
    """A day is out if it lacks one of its two half-day bins."""
    e = table(spark, sf_dir, "events")
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-30')) AS day")
    bins = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count_distinct(floor_bin("ts", 720)).alias("bins"))
    every = e.select("user_id").distinct().join(F.broadcast(days), how="cross").join(bins, ["user_id", "day"], "left").fillna(0, ["bins"])
    return day_runs(every, "user_id", "day", F.col("bins") != 2)


@register("availability", f"WITH {_CALENDAR} SELECT day, count_if(n = 0) AS silent, count(*) AS sensors, CAST(sum(n) AS BIGINT) AS n FROM d GROUP BY day", "E11 Q11")
def q_availability(spark, sf_dir):
    return _calendar_counts(spark, sf_dir).groupBy("day").agg(F.count_if(F.col("n") == 0).alias("silent"), F.count("*").alias("sensors"), F.sum("n").alias("n"))


@register("sessions", """
    WITH l AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR AND event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS brk FROM events
               WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM l)
    SELECT user_id, CAST(session AS BIGINT) AS session, min(ts) AS begun, max(ts) AS ended, count(*) AS n FROM s GROUP BY user_id, session""", "C8")
def q_sessions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    w = row_window(["user_id"], ["ts", "event_id"])
    apart = (F.expr("ts - INTERVAL 12 HOURS") > F.lag("ts").over(w)) | (F.lag("event_type").over(w) != F.col("event_type"))
    marked = sessions(e, ["user_id"], ["ts", "event_id"], apart)
    return marked.groupBy("user_id", "session").agg(F.min("ts").alias("begun"), F.max("ts").alias("ended"), F.count("*").alias("n"))


@register("daily_caveats", f"""
    SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum({CENTS}) AS BIGINT) AS cents, 1440 - count(DISTINCT time_bucket(INTERVAL 1 MINUTE, ts)) AS missing_minutes,
      CASE WHEN count(DISTINCT time_bucket(INTERVAL 1 MINUTE, ts)) < 3 THEN 'sparse' ELSE 'normal' END AS caveat
    FROM events GROUP BY ALL HAVING count(*) FILTER (WHERE event_type = 'error') = 0""", "C13 FILTER HAVING")
def q_daily(spark, sf_dir):
    minutes = F.count_distinct(floor_bin("ts", 1))
    out = _events(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.sum("cents").alias("cents"), (1440 - minutes).alias("missing_minutes"), F.when(minutes < 3, "sparse").otherwise("normal").alias("caveat"), F.count_if(F.col("event_type") == "error").alias("_bad"))
    return out.where("_bad = 0").drop("_bad")


@register("zero_ranges", """
    WITH g AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, count_if(value > 200) AS big FROM events
               GROUP BY GROUPING SETS ((user_id, CAST(ts AS DATE)), (user_id, event_type, CAST(ts AS DATE)))),
    z AS (SELECT * FROM g WHERE big = 0)
    SELECT z.user_id, z.event_type, z.day FROM z WHERE z.event_type IS NULL OR NOT EXISTS (SELECT 1 FROM z c WHERE c.event_type IS NULL AND c.user_id = z.user_id AND c.day = z.day)""", "C9 C15 GROUPING SETS")
def q_zero(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    g = e.groupingSets([["user_id", "day"], ["user_id", "event_type", "day"]], "user_id", "event_type", "day").agg(F.count_if(F.col("value") > 200).alias("big")).where("big = 0")
    return coarsest(g.drop("big"), ["user_id", "day"], "event_type")


@register("merged_ranges", """
    WITH r AS (SELECT user_id % 7 AS k, ts AS lo, ts + to_minutes(CAST(value AS INTEGER)) AS hi FROM events),
    m AS (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY k ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS brk FROM r),
    n AS (SELECT *, sum(brk) OVER (PARTITION BY k ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM m)
    SELECT k, min(lo) AS lo, max(hi) AS hi FROM n GROUP BY k, run""", "C11 Q10")
def q_merged(spark, sf_dir):
    return merge_ranges(_spans(spark, sf_dir), ["k"])


def _spans(spark, sf_dir):
    minutes = F.bround("value").cast("int")
    return table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("k"), F.col("ts").alias("lo"), (F.col("ts") + F.make_dt_interval(mins=minutes)).alias("hi"))


@register("split_ranges", """
    WITH r AS (SELECT user_id % 7 AS k, ts AS lo, ts + to_minutes(CAST(value * 20 AS INTEGER)) AS hi FROM events),
    p AS (SELECT k, lo, least(hi, TIMESTAMP '2024-01-10') AS hi FROM r UNION ALL SELECT k, greatest(lo, TIMESTAMP '2024-01-11') AS lo, hi FROM r)
    SELECT k, lo, hi FROM p WHERE lo < hi""", "C10")
def q_split(spark, sf_dir):
    minutes = F.bround(F.col("value") * 20).cast("int")
    r = table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("k"), F.col("ts").alias("lo"), (F.col("ts") + F.make_dt_interval(mins=minutes)).alias("hi"))
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    return cut_out(r, "lo", "hi", at("2024-01-10 00:00:00"), at("2024-01-11 00:00:00"))


@register("session_windows", """
    WITH l AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY event_type ORDER BY ts) + INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS brk FROM events),
    s AS (SELECT *, sum(brk) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM l)
    SELECT event_type, min(ts) AS begun, max(ts) + INTERVAL 10 MINUTE AS ended, count(*) AS n FROM s GROUP BY event_type, run""", "C8 I session_window")
def q_session_windows(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.session_window("ts", "10 minutes").alias("w")).agg(F.count("*").alias("n")).select("event_type", F.col("w.start").alias("begun"), F.col("w.end").alias("ended"), "n")


@register("routine_timebins", """
    SELECT unnest(generate_series(TIMESTAMP '2024-01-15 07:30:00', TIMESTAMP '2024-01-15 09:15:00', INTERVAL 15 MINUTE)) AS bin
    UNION ALL SELECT unnest(generate_series(TIMESTAMP '2024-01-15 10:00:00', TIMESTAMP '2024-01-15 11:45:00', INTERVAL 15 MINUTE))
    UNION ALL SELECT unnest(generate_series(TIMESTAMP '2024-01-15 16:00:00', TIMESTAMP '2024-01-15 17:45:00', INTERVAL 15 MINUTE))""", "B18")
def q_routine(spark, sf_dir):
    ranges = [("07:30", "09:15"), ("10:00", "11:45"), ("16:00", "17:45")]
    return spark.range(1).select(F.explode(routine_bins("2024-01-15", ranges)).alias("bin"))
