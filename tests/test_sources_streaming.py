"""Readers, writers and streams on files in a temporary folder."""

import datetime as dt
import struct

from pyspark.sql import functions as F

from curbline.sources import readers, writers
from curbline.streaming import binned


def test_csv_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("tx,link_dir,length,mean,stddev,min_spd,max_spd,confidence,pct_50,pct_85\n2024-01-02 03:04:05,12F,30,40.5,1.5,1,80,9,40,55\n")
    r = readers.link_readings(spark, str(tmp_path / "a.csv")).first()
    assert (r.confidence, r.pct_50, r.tod, r.dt) == (9, 40, 3 * 3600 + 4 * 60 + 5, dt.date(2024, 1, 2))


def test_fixed_width_lines(spark):
    line = lambda at, d, n: f"{at:<6}{'':8}{d:<12}{n:>10}"
    df = spark.createDataFrame([(line("0015", "DE1", "42"),), (line("0030", "DE1", ""),), (line("0045", "DE2", "-1"),)], "value string")
    assert sorted(map(tuple, readers.fixed_width(df).collect())) == [("DE1", "0015", 42), ("DE1", "0030", None)]


def test_lane_bytes(spark):
    record = lambda *v: struct.pack("<BHHH", *v) + b"\0" * 8
    df = spark.createDataFrame([(1, record(1, 5025, 900, 1250) + record(2, 65535, 0, 65535)), (2, None), (3, b"xx")], "vds_id int, lanedata binary")
    assert sorted(map(tuple, readers.lanes(df, "vds_id", "lanedata").collect())) == [(1, 1, 50.25, 900, 12.5), (1, 2, None, 0, None)]


def test_geometry_bytes():
    assert readers.geometry(struct.pack("<idd", 1, -79.5, 43.5)) == "POINT (-79.5 43.5)"
    assert readers.geometry(struct.pack("<idddd", 2, -79.5, 43.5, -79.0, 44.0)) == "LINESTRING (-79.5 43.5, -79.0 44.0)"
    assert readers.geometry(None) is None


def test_nested_json(spark):
    df = spark.createDataFrame([(1, '{"Road": "A", "LaneApproaches": [{"Direction": "N", "LanesAffected": "LOLC"}]}'), (2, "not json")], "id int, lanesaffected string")
    out = readers.lane_approaches(df, "id", "lanesaffected")
    assert [tuple(r) for r in out.collect()] == [(1, "A", "N", "LOLC")]
    lookup = spark.createDataFrame([("LO", "car", "open"), ("LC", "car", "closed")], "code string, mode string, state string")
    assert tuple(readers.lane_states(out, "id", "LanesAffected", lookup).first()) == (1, "car", 1, 1)


def test_xml_and_counts(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<ds><detector><id>1</id><name>x</name></detector><detector><id>2</id></detector></ds>")
    assert sorted(map(tuple, readers.xml(spark, str(tmp_path / "d.xml"), "detector", "id int, name string").collect()), key=str) == [(1, "x"), (2, None)]
    records = spark.createDataFrame([(1, "t", [("10", "2"), ("", "1")]), (2, "t", None)], "api_id int, datetime_bin string, counter array<struct<speed:string,count:string>>")
    assert sorted(map(tuple, readers.nested_counts(records).collect()), key=str) == [(1, "t", 10, 2), (1, "t", None, 1), (2, "t", None, None)]


def test_validation(spark):
    good, bad = readers.validated(spark.createDataFrame([(1, "a"), (None, "b"), (-1, "")], "x int, s string"), positive="x > 0", named="s <> ''")
    assert [r.x for r in good.collect()] == [1] and sorted(r.broken for r in bad.collect()) == [["positive"], ["positive", "named"]]


def test_restatement_is_idempotent(spark, tmp_path):
    at = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01", 5), (2, "2024-01-01", 6), (1, "2024-01-02", 7)], "k int, day string, v int")
    writers.restate(df, at, ["day"], ["k"])
    for _ in range(2):
        writers.restate(df.where("day = '2024-01-02'").withColumn("v", F.lit(9)), at, ["day"])
    assert sorted((r.k, str(r.day), r.v) for r in spark.read.parquet(at).collect()) == [(1, "2024-01-01", 5), (1, "2024-01-02", 9), (2, "2024-01-01", 6)]
    assert writers.replicate(df, str(tmp_path / "copy")) == 3


def test_geojson(spark):
    df = spark.createDataFrame([(1, -79.5, 43.5)], "id int, lon double, lat double")
    assert writers.feature_collection(df, "lon", "lat", ["id"]).first()[0] == '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Point","coordinates":[-79.5,43.5]},"properties":{"id":1}}]}'


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "event_type", "value")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    n = F.count("*")
    binned.to_table(binned.binned(stream, "ts", ["event_type"], 15, "40 days", n=n), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    query = binned.merged(stream, str(tmp_path / "m"), ["event_type"], "event_id", str(tmp_path / "c2"), parts=3)
    query.awaitTermination()
    want = {r.event_type: r.event_id for r in events.groupBy("event_type").agg(F.max("event_id").alias("event_id")).collect()}
    got = binned.current(spark, str(tmp_path / "m"))
    assert got.count() == 5 and got.select("event_type").distinct().count() == 5 and {r.event_type for r in got.collect()} == want.keys()
    # another batch with one kind writes its part only
    more = events.where("event_type = 'click'").limit(1).withColumn("event_id", F.lit(10**9))
    more.write.mode("append").parquet(str(tmp_path / "in"))
    binned.merged(stream, str(tmp_path / "m"), ["event_type"], "event_id", str(tmp_path / "c2"), parts=3).awaitTermination()
    assert {r.event_type: r.event_id for r in binned.current(spark, str(tmp_path / "m")).collect()}["click"] == 10**9
    assert binned.tidy(spark, str(tmp_path / "m")) > 0 and binned.current(spark, str(tmp_path / "m")).count() == 5
    twice = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    binned.to_table(binned.first_wins(twice, "ts", ["event_type"], "60 days"), str(tmp_path / "f"), str(tmp_path / "c3")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "f")).count() == 5


def test_sheets(spark, tmp_path):
    import zipfile

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as book:
        book.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Main </t><r><t>Street</t></r></si><si><t>x</t></si></sst>")
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>2.5</v></c></row><row r="3"><c r="B3" t="inlineStr"><is><t>in</t></is></c><c r="C3" t="s"><v>1</v></c></row></sheetData></worksheet>')
    got = readers.sheet(spark, str(tmp_path), 1, ["a", "b", "c"]).orderBy("row").collect()
    assert [tuple(r)[1:] for r in got] == [(1, "Main Street", None, "2.5"), (3, None, "in", "x")]


def test_tables_of_a_database(spark):
    url = "jdbc:derby:memory:curbline;create=true"
    df = spark.range(50).select(F.col("id").alias("K"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("V"))
    writers.to_database(df, url, "T", 4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    back = readers.jdbc(spark, url, "T", "K", (0, 50), 4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert back.rdd.getNumPartitions() == 4 and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_pages_that_are_left(spark):
    body = lambda more: f'{{"exceededTransferLimit": {more}, "features": [{{"attributes": {{"objectid": 1, "name": "a{more}"}}}}]}}'
    landed = spark.createDataFrame([(0, body("true")), (1, body("false")), (2, "no json")], "page int, body string")
    assert [tuple(r) for r in readers.pages(landed, "page", "objectid: bigint, name: string").collect()] == [(1, "afalse")]
    assert readers.pages_left(landed, "page").count() == 0
    assert [r.page for r in readers.pages_left(landed.where("page = 0"), "page").collect()] == [0]
