"""What the corpus operators share: Arrow batch mapping, the shared folder, and packed-chunk exchange."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that one Arrow batch carries to a Python worker (one longer row is a batch of its own).
BATCH_BYTES = 2 << 20
#: Text bytes that an operator handles (and emits results for) at a time.
SLICE_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the bytes of Arrow batches of the session, so that long texts don't meet in one batch by the thousands; other work only gets smaller batches by it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session; set here only where it is unset."""
    if at := spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    at = tempfile.mkdtemp(prefix="curbline-")
    atexit.register(shutil.rmtree, at, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{at}")
    return f"file://{at}"


#: Folders of the tables that ``written`` made, by the frame that reads them.
_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_TABLES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table into the shared folder and read back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    release(spark)
    out = spark.read.schema(df.schema).parquet(at)
    _WRITTEN[out] = at
    return out


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Like ``written``, with rows dealt to files by hash of ``column``: joins on it need no shuffle of this table if Spark has no more shuffle partitions than ``buckets``."""
    spark = df.sparkSession
    number = uuid.uuid4().hex
    at, table = f"{shared_dir(spark)}/{name}-{number}", f"{name}_{number}"
    df.write.bucketBy(buckets, column).option("path", at).saveAsTable(table)
    release(spark)
    out = spark.table(table)
    _WRITTEN[out] = at
    _TABLES[out] = table
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` or ``bucketed`` returned; nothing may read them any more."""
    for table in tables:
        if name := _TABLES.pop(table, None):
            table.sparkSession.sql(f"DROP TABLE {name}")
        at = table.sparkSession._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop(table))
        at.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def text_key(text: Column) -> Column:
    """64 bits of a text's hash; null and empty texts are alike."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


#: Bits of a map of keys (fixed, so that it can go to every worker); rows that it lets through wrongly are told by a join.
MAP_BITS = 1 << 24


def key_map(keys: DataFrame) -> np.ndarray:
    """A map with a bit for each key of a one-column frame, by bytes. At most MAP_BITS bits come to the driver."""
    place = F.pmod(F.col(keys.columns[0]), F.lit(MAP_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(31)).cast("int"))
    marks = keys.groupBy(F.shiftright(place, 5).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(MAP_BITS // 32, "<u4")
    if marks.num_rows:
        words[marks.column("word").to_numpy()] = marks.column("bits").to_numpy().astype(np.uint32)
    return words.view(np.uint8)


def in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys & MAP_BITS - 1
    return bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0


def rows_with(documents: DataFrame, id_col: str, text_col: str, touched: DataFrame, touched_key: Callable[[Column], Column], stay: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns.

    All rows do whose ``touched_key`` of the text isn't in ``touched`` (keys); of the others those whose id and text (by its hash)
    are in ``stay`` (id, key), and of rows that repeat both only one. ``again`` (id, key) tells which may repeat; without it they are looked for.
    Only rows that a map of ``touched`` lets through are moved for that."""
    spark, names = documents.sparkSession, documents.columns
    bits = spark.sparkContext.broadcast(key_map(touched))
    touched = touched.toDF("_touched").distinct()

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(in_map(bits.value, keys.to_numpy().astype(np.int64)))

    text = F.col(f"`{text_col}`")
    wide = documents.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], F.col(f"`{id_col}`").cast("long").alias("_i"), text_key(text).alias("_k"), touched_key(text).alias("_t"))
    marked = wide.withColumn("_maybe", maybe("_t"))
    free, held = marked.where("not _maybe"), marked.where("_maybe")
    stay = stay.toDF("_si", "_sk").distinct()
    if again is None:
        again = held.select("_i", "_k").groupBy("_i", "_k").count().where("count > 1").drop("count")
    again = written(again.toDF("_ai", "_ak").distinct(), "repeated")
    kept = held.join(stay, F.col("_i").eqNullSafe(F.col("_si")) & (F.col("_k") == F.col("_sk")), "left_semi")
    if not again.isEmpty():
        same = F.col("_i").eqNullSafe(F.col("_ai")) & (F.col("_k") == F.col("_ak"))
        kept = kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["_i", "_k"]))
    on = F.col("_t") == F.col("_touched")
    wrong, kept = held.join(touched, on, "left_anti"), kept.join(touched, on, "left_semi")
    return free.unionByName(wrong).unionByName(kept).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps whose results are written: it does so once their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of rows of about ``most`` bytes; one long text is a run of its own."""
    begin = size = 0
    for k, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
        if size and size + (n or 0) > most:
            yield begin, k
            begin, size = k, 0
        size += n or 0
    if begin < len(texts):
        yield begin, len(texts)


def map_texts(df: DataFrame, columns: list, f: Callable[..., dict], schema: str, setup: Callable | None = None) -> DataFrame:
    """Runs ``f(state, *columns as Python lists) -> {name: list}`` over slices of the first column, a text.

    Only ``columns`` reach Python. ``setup()`` makes the worker's state once per task."""
    small_batches(df.sparkSession)
    chosen = df.select(*columns)
    names = chosen.columns

    def run(batches):
        state = setup() if setup else None
        for batch in batches:
            for a, b in slices(batch.column(0)):
                part = batch.slice(a, b - a)
                out = f(state, *[part.column(k).to_pylist() for k in range(len(names))])
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return chosen.mapInArrow(run, schema)
