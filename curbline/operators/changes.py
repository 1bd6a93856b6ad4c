"""Change data: upserts, audits, snapshots, quarantine."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with the same names behind ``prefix``."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _named(rows: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return rows.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same keys (null keys equal); ``new`` must be unique by key."""
    return old.join(_named(new, keys, "_n_").distinct(), _same(keys, "_n_"), "left_anti").unionByName(new)


def insert_new(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` and the rows of ``new`` whose keys it hasn't (null keys equal)."""
    return old.unionByName(new.join(_named(old, keys, "_o_").distinct(), _same(keys, "_o_"), "left_anti"))


def merge(old: DataFrame, new: DataFrame, keys: Sequence[str], delete_matched: Column | None = None, insert: Column | None = None, delete_absent: Column | None = None) -> DataFrame:
    """The table after a merge of ``new`` (unique by key, with the columns of ``old``) into ``old``; null keys are equal.

    Matched rows take the new values, or go where ``delete_matched`` (of the new values) holds; others of ``new`` come in where
    ``insert`` holds; rows that ``new`` lacks go where ``delete_absent`` (of the old values) holds. One full join."""
    a = old.select(F.struct(*old.columns).alias("_old"), *[F.col(k).alias(f"_a_{k}") for k in keys])
    b = new.select(F.struct(*old.columns).alias("_new"), *[F.col(k).alias(f"_b_{k}") for k in keys])
    both = a.join(b, reduce(lambda x, y: x & y, [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys]), "full")
    absent = F.col("_new").isNull()
    rows = both.select(F.coalesce("_new", "_old").alias("_row"), F.col("_old").isNotNull().alias("_was"), (~absent).alias("_came")).select("_row.*", "_was", "_came")
    no = F.lit(False)
    gone = F.when(F.col("_was") & F.col("_came"), no if delete_matched is None else delete_matched).when(F.col("_came"), no if insert is None else ~insert).otherwise(no if delete_absent is None else delete_absent)
    return rows.where(~F.coalesce(gone, no)).select(old.columns)


def update_from(rows: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``rows`` with ``columns`` taken from ``source`` (unique by key) where the keys match."""
    s = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.struct(*columns).alias("_s"))
    met = rows.join(s, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys]), "left")
    return met.select(*[F.when(F.col("_s").isNotNull(), F.col(f"_s.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns])


def delete_using(rows: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose keys ``source`` hasn't."""
    return rows.join(source.select(*keys).distinct(), list(keys), "left_anti")


def before_insert(rows: DataFrame, columns: dict[str, Column], accept: Column) -> DataFrame:
    """Rows as row triggers would leave them: refused ones out, ``columns`` derived from the row as it came."""
    return rows.where(accept).withColumns(columns)


def audit(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per changed key: (keys, action I/U/D, changed columns); unchanged rows are skipped; null keys are equal. One full join."""
    values = [c for c in old.columns if c not in keys]
    a = old.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.struct(*values).alias("_old"))
    b = new.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.struct(*values).alias("_new"))
    differ = F.array_compact(F.array(*[F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in values]))
    both = a.join(b, reduce(lambda x, y: x & y, [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys]), "full")
    both = both.select(*[F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys], "_old", "_new")
    action = F.when(F.col("_old").isNull(), "I").when(F.col("_new").isNull(), "D").otherwise("U")
    changed = F.when(F.col("_old").isNull() | F.col("_new").isNull(), F.array().cast("array<string>")).otherwise(differ)
    rows = both.select(*keys, action.alias("action"), changed.alias("changed"))
    return rows.where((F.col("action") != "U") | (F.size("changed") > 0))


def latest(rows: DataFrame, keys: Sequence[str], *order) -> DataFrame:
    """One row per key, first by ``order``: arg-max per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def quarantine(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is unique in the batch, rows that share one)."""
    marked = rows.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    return marked.where("_n = 1").drop("_n"), marked.where("_n > 1").drop("_n")


def seen_bounds(old: DataFrame, new: DataFrame, key: str, ts: str) -> DataFrame:
    """First and last seen per key over what is stored and a new batch."""
    fresh = new.groupBy(key).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))
    return old.select(key, "first_seen", "last_seen").unionByName(fresh).groupBy(key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
