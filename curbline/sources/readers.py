"""Readers with declared schemas, and decoders of raw records."""

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Readings of links as delivered in CSV with a header: fixed columns.
LINK_READINGS = "tx timestamp_ntz, link_dir string, length int, mean double, stddev double, min_spd int, max_spd int, confidence int, pct_50 int, pct_85 int"
#: Bytes of a lane record: lane (1), speed in hundredths (2), vehicles per hour (2), occupancy in hundredths (2), low bytes first, then bytes without use here.
LANE_BYTES = 15


def csv(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """CSV by column name; never inferred. Gzip is read as it is."""
    return spark.read.schema(schema).options(header=True, mode="FAILFAST", enforceSchema=False, **options).csv(path)


def link_readings(spark: SparkSession, path: str) -> DataFrame:
    """Link readings with their day and second of day."""
    from curbline.functions.timebin import seconds_of_day

    return csv(spark, path, LINK_READINGS).withColumn("dt", F.to_date("tx")).withColumn("tod", seconds_of_day("tx"))


def fixed_width(lines: DataFrame, column: str = "value") -> DataFrame:
    """Detector lines (id 15-26, time 1-6, count 27-36): blank counts are null, negative ones are dropped."""
    part = lambda a, n: F.nullif(F.trim(F.substring(column, a, n)), F.lit(""))
    rows = lines.select(part(15, 12).alias("detector_id"), part(1, 6).alias("at"), part(27, 10).try_cast("int").alias("n"))
    return rows.where("n IS NULL OR n >= 0")


def nested_counts(records: DataFrame) -> DataFrame:
    """(api_id, datetime, counter array<struct<speed, count>>) to one row per speed; empty strings are null."""
    c = records.select("api_id", "datetime_bin", F.explode_outer("counter").alias("c"))
    number = lambda x: F.nullif(F.trim(F.col(x).cast("string")), F.lit("")).try_cast("int")
    return c.select("api_id", "datetime_bin", number("c.speed").alias("speed"), number("c.count").alias("count"))


def lane_approaches(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """Explodes ``LaneApproaches`` of a JSON column; text that isn't JSON yields nothing."""
    schema = "Road string, LaneApproaches array<struct<Direction:string,LanesAffected:string>>"
    parsed = rows.select(id_col, F.from_json(text, schema).alias("j"))
    return parsed.select(id_col, F.col("j.Road").alias("road_toplevel"), F.inline("j.LaneApproaches"))


def lane_states(rows: DataFrame, id_col: str, code: str, lookup: DataFrame) -> DataFrame:
    """Two-letter lane codes, counted open and closed by mode of the lookup (code, mode, state)."""
    pairs = rows.select(id_col, F.explode(F.regexp_extract_all(code, F.lit("(..)"))).alias("code"))
    return pairs.join(F.broadcast(lookup), "code").groupBy(id_col, "mode").agg(F.count_if(F.col("state") == "open").alias("open"), F.count_if(F.col("state") == "closed").alias("closed"))


def lanes(rows: DataFrame, id_col: str, data: str) -> DataFrame:
    """Decodes lane bytes: one row per record (lane, speed_kmh, veh_per_hr, occupancy_percent); 0 and 65535 are no speed."""
    raw = F.col(data)
    byte = lambda at: F.conv(F.hex(F.substring(raw, at + 1, F.lit(1))), 16, 10).cast("int")
    word = lambda at: byte(at) + 256 * byte(at + 1)
    records = F.when(F.length(raw) >= LANE_BYTES, F.sequence(F.lit(0), (F.floor(F.length(raw) / LANE_BYTES) - 1).cast("int")))
    at = rows.select(id_col, data, F.explode(records).alias("_k")).withColumn("_at", F.col("_k") * LANE_BYTES)
    lane, speed, flow, occupancy = byte(F.col("_at")), word(F.col("_at") + 1), word(F.col("_at") + 3), word(F.col("_at") + 5)
    return at.select(id_col, lane.alias("lane"), F.when(~speed.isin(0, 65535), speed / 100.0).alias("speed_kmh"), flow.alias("veh_per_hr"), F.when(occupancy != 65535, occupancy / 100.0).alias("occupancy_percent"))


def geometry(raw: bytes | None) -> str | None:
    """Well-known text of an int count and (lon, lat) doubles; null if the bytes are too few."""
    if not raw or len(raw) < 4 or (n := struct.unpack_from("<i", raw)[0]) < 1 or len(raw) < 4 + 16 * n:
        return None
    points = ["%r %r" % struct.unpack_from("<dd", raw, 4 + 16 * k) for k in range(n)]
    return f"POINT ({points[0]})" if n == 1 else f"LINESTRING ({', '.join(points)})"


def geometries(rows: DataFrame, id_col: str, data: str, name: str = "wkt") -> DataFrame:
    """(id, well-known text) of binary geometries, on Arrow batches."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([geometry(x) for x in batch.column(1).to_pylist()], pa.string())], names=[id_col, name])

    return rows.select(id_col, data).mapInArrow(run, f"{id_col} {rows.schema[id_col].dataType.simpleString()}, {name} string")


def text_columns(lines: DataFrame, names: list[str], column: str = "value") -> DataFrame:
    """Columns of lines that are parted by blanks, as text; blank lines are left out, missing columns are null."""
    parts = F.split(F.trim(column), r"\s+")
    return lines.where(F.trim(column) != "").select(*[F.get(parts, F.lit(k)).alias(n) for k, n in enumerate(names)])


def pages(rows: DataFrame, page: str, attributes: str) -> DataFrame:
    """Attributes (a schema) of the features on landed pages of a map layer: each object once, the last page's copy; pages that aren't JSON yield nothing."""
    schema = f"exceededTransferLimit boolean, features array<struct<attributes: struct<{attributes}>>>"
    found = rows.select(F.col(page).alias("_page"), F.from_json("body", schema).alias("j")).select("_page", F.explode("j.features").alias("f"))
    key = attributes.split(":")[0].strip()
    return found.select("_page", "f.attributes.*").groupBy(key).agg(F.max_by(F.struct("*"), "_page").alias("r")).select("r.*").drop("_page")


def pages_left(rows: DataFrame, page: str) -> DataFrame:
    """Pages that say that more is to come, where no later page has landed."""
    more = rows.select(page, F.coalesce(F.from_json("body", "exceededTransferLimit boolean")["exceededTransferLimit"], F.lit(False)).alias("more"))
    return more.agg(F.max_by(F.struct(page, "more"), page).alias("last")).where("last.more").select(f"last.{page}")


def day_chunks(spark: SparkSession, start: str, end: str, days: int) -> DataFrame:
    """Spans (lo, hi) of at most ``days`` days that make up a period, for pulls that are limited; ``end`` is exclusive."""
    step = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1), F.expr(f"INTERVAL {days} DAYS"))).alias("lo"))
    return step.select("lo", F.least(F.date_add("lo", days), F.lit(end).cast("date")).alias("hi"))


def html_rows(rows: DataFrame, id_col: str, html: str) -> DataFrame:
    """(id, row, cells) of the table rows of a page, tags and entities taken out of the cells; rows without cells are left out."""
    found = rows.select(id_col, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))).alias("row", "tr"))
    clean = lambda c: F.trim(F.replace(F.replace(F.replace(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", ""), r"\s+", " "), F.lit("&nbsp;"), F.lit(" ")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&")))
    cells = F.transform(F.regexp_extract_all("tr", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)), clean)
    return found.select(id_col, "row", cells.alias("cells")).where("size(cells) > 0")


def sheet(spark: SparkSession, path: str, number: int, names: list[str]) -> DataFrame:
    """(file, row, columns as text) of a sheet of spreadsheets (xlsx) under a path; a file is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import io
        import re
        import zipfile
        from xml.etree import ElementTree

        import pyarrow as pa

        space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        for batch in batches:
            for at, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    texts = []
                    if "xl/sharedStrings.xml" in book.namelist():
                        texts = ["".join(t.text or "" for t in si.iter(f"{space}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{space}si")]
                    out = []
                    for row in ElementTree.fromstring(book.read(f"xl/worksheets/sheet{number}.xml")).iter(f"{space}row"):
                        cells: dict[int, str | None] = {}
                        for c in row.iter(f"{space}c"):
                            column = 0
                            for letter in re.match(r"[A-Z]+", c.get("r", "A"))[0]:
                                column = 26 * column + ord(letter) - 64
                            v, inline = c.find(f"{space}v"), c.find(f"{space}is")
                            text = "".join(t.text or "" for t in inline.iter(f"{space}t")) if inline is not None else None if v is None else v.text
                            cells[column - 1] = texts[int(text)] if c.get("t") == "s" and text is not None else text
                        out.append((at, int(row.get("r")), *[cells.get(k) for k in range(len(names))]))
                    columns = list(zip(*out)) or [()] * (2 + len(names))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), *[pa.array(c, pa.string()) for c in columns[2:]]], names=["file", "row", *names])

    return files.mapInArrow(run, "file string, row int, " + ", ".join(f"`{n}` string" for n in names))


def xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def jdbc(spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], parts: int, **options) -> DataFrame:
    """A database table read in ranges of a key, in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts, fetchsize=100_000, **options).load()


def validated(rows: DataFrame, **rules: str) -> tuple[DataFrame, DataFrame]:
    """(rows that meet every rule, others with the names of the rules that they break); a rule that is null is broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(r), F.lit(False)), F.lit(n)) for n, r in rules.items()]))
    marked = rows.withColumn("broken", broken)
    return marked.where("size(broken) = 0").drop("broken"), marked.where("size(broken) > 0")


