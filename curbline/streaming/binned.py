"""The daily pipelines as streams: watermarked bins, runs, first-wins keys, and batches that restate or merge."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbline.operators.changes import upsert


def binned(stream: DataFrame, ts: str, keys: Sequence[str], minutes: int, late: str, **sums: Column) -> DataFrame:
    """Sums per key and bin; rows later than ``late`` are left out. ``ts`` may be NTZ (taken as UTC)."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    out = timed.groupBy(F.window("_ts", f"{minutes} minutes").alias("w"), *keys).agg(*[c.alias(n) for n, c in sums.items()])
    return out.select(F.col("w.start").alias("bin"), *keys, *sums)


def runs(stream: DataFrame, ts: str, keys: Sequence[str], silence: str, late: str) -> DataFrame:
    """Sessions per key that end after ``silence``."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    out = timed.groupBy(F.session_window("_ts", silence).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("w.start").alias("begun"), F.col("w.end").alias("ended"), "n")


def first_wins(stream: DataFrame, ts: str, keys: Sequence[str], late: str) -> DataFrame:
    """Rows whose keys haven't come within the watermark."""
    return stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late).dropDuplicatesWithinWatermark(list(keys)).drop("_ts")


def to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all that is there, then stops."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(stream: DataFrame, path: str, keys: Sequence[str], order: str, checkpoint: str, parts: int = 64) -> StreamingQuery:
    """Upserts each batch into a Parquet table whose rows lie in ``parts`` by hash of their keys; of rows with one key the last by ``order`` counts.

    A batch writes only the parts that it touches, under ``v=<batch>``, from what the batches before left of them; a batch that
    runs again writes the same. :func:`current` reads the table, :func:`tidy` deletes what newer versions replace."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        w = Window.partitionBy(*keys).orderBy(F.desc(order))
        new = batch.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r").withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
        touched = [r.part for r in new.select("part").distinct().collect()]  # at most ``parts`` numbers
        old = current(spark, path, number, touched)
        out = new if old is None else upsert(old.select(new.columns), new, keys)
        out.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{path}/v={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """The newest version of each part, from the names of folders."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[int, int] = {}
    for folder in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v=*/part=*")) or ():
        part, version = (int(x.getName().split("=")[1]) for x in (folder.getPath(), folder.getPath().getParent()))
        if before is None or version < before:
            out[part] = max(version, out.get(part, version))
    return out


def current(spark: SparkSession, path: str, before: int | None = None, parts: Sequence[int] | None = None) -> DataFrame | None:
    """The table that :func:`merged` keeps, or some parts of it as they were before a version; None if there is none yet."""
    found = [f"{path}/v={v}/part={p}" for p, v in sorted(_versions(spark, path, before).items()) if parts is None or p in parts]
    if not found:
        return None
    return spark.read.option("basePath", path).parquet(*found).drop("v")


def tidy(spark: SparkSession, path: str) -> int:
    """Deletes parts that newer versions replace; returns how many."""
    newest, gone = _versions(spark, path), 0
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v=*/part=*")):
        part, version = (int(x.getName().split("=")[1]) for x in (folder.getPath(), folder.getPath().getParent()))
        if version < newest[part]:
            files.delete(folder.getPath(), True)
            gone += 1
    return gone
