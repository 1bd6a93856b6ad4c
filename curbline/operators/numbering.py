"""Consecutive numbers without a global window."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.session import checkpointed


def serial(rows: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Numbers ``rows`` by ``order`` (unique) from ``start`` on, like a sequence.

    Rows are sorted into ranges once and written, so that their range is fixed; each range is numbered on its own, after the
    sizes of the ranges before it. Only a row for each range meets in one task."""
    dealt = checkpointed(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_range").alias("_r"), (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    met = dealt.withColumn("_place", place).join(before, F.col("_range") == F.col("_r"))
    return met.withColumn(name, F.col("_before") + F.col("_place") - 1 + start).drop("_range", "_r", "_before", "_place")
