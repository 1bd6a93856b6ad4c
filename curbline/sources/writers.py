"""Writers: restatement by partition, snapshots with checks, exports."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def restate(df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str] = ()) -> None:
    """Replaces just the partitions that ``df`` has: idempotent per day. Rows of a partition go to few files, sorted so
    that min/max statistics skip row groups."""
    out = df.repartition(*partitions) if not sort else df.repartition(*partitions).sortWithinPartitions(*partitions, *sort)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def snapshot(df: DataFrame, path: str, version: str) -> None:
    """Adds a version to a snapshot table."""
    restate(df.withColumn("version_date", F.lit(version).cast("date")), path, ["version_date"])


def replicate(source: DataFrame, path: str) -> int:
    """Copies a table, read once: the copy must have rows, and as many as were read."""
    from pyspark.sql import Observation

    seen = Observation()
    source.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    if not (n := seen.get["n"]):
        raise ValueError("the source is empty")
    if (copied := source.sparkSession.read.parquet(path).count()) != n:
        raise ValueError(f"{copied} of {n} rows arrived")
    return n


def csv_by_year(df: DataFrame, path: str, ts: str) -> None:
    df.withColumn("year", F.year(ts)).repartition("year").write.mode("overwrite").partitionBy("year").option("header", True).csv(path)


def feature_collection(df: DataFrame, lon: str, lat: str, properties: Sequence[str]) -> DataFrame:
    """One GeoJSON FeatureCollection of a small set of points (an export of sites, not of facts)."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties"))
    features = df.agg(F.array_sort(F.collect_list(feature)).alias("features"))
    return features.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("geojson"))


def retained(spark, path: str, partition: str, since: str) -> int:
    """Deletes a table's partitions (dates) before ``since``; returns how many are left."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    left = 0
    for folder in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}=*")) or ():
        if folder.getPath().getName().split("=", 1)[1] < since:
            files.delete(folder.getPath(), True)
        else:
            left += 1
    return left


def routed(df: DataFrame, path: str, route: Column, name: str = "route") -> None:
    """Inserts rows into the table's parts that a rule sends them to."""
    df.withColumn(name, route).repartition(name).write.mode("append").partitionBy(name).parquet(path)


def to_database(df: DataFrame, url: str, table: str, parts: int, batch: int = 10_000, **options) -> None:
    """Appends rows to a database table, in batches over ``parts`` connections."""
    df.coalesce(parts).write.format("jdbc").options(url=url, dbtable=table, batchsize=batch, **options).mode("append").save()
