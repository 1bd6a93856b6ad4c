"""Sessions and lineage."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "curbline", **conf: str) -> SparkSession:
    """A session with the settings that the operators are written for; cluster settings come from ``spark-submit``."""
    builder = SparkSession.builder.appName(app)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.timestampType": "TIMESTAMP_NTZ"}
    for k, v in (settings | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that executors share (``spark.checkpoint.dir``); a local one is made only where none is set."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        local = tempfile.mkdtemp(prefix="curbline-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        at = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written into the shared folder and read back: computed once, and lineage ends there."""
    at = f"{shared_folder(df.sparkSession)}/step-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores, where a small file with many rows gives fewer tasks; for work that is heavy by row."""
    n = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df
