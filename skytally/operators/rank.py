"""Ranking: global top/bottom-k, per-group top/bottom-k, full ordering.

Every ranked output carries an explicit ``rank`` column (1 = first),
because row order does not survive joins or distributed writes.  Equal
counts are broken by the code, ascending, in both directions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

def _order(value: str, key: str, ascending: bool) -> list[Column]:
    v = F.col(value).asc() if ascending else F.col(value).desc()
    return [v, F.col(key).asc()]


def top_k(df: DataFrame, value: str, key: str, k: int, ascending: bool) -> DataFrame:
    """The ``k`` rows with the smallest (``ascending``) or largest ``value``.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each task
    keeps its own k best rows and one final merge sees k x tasks rows.
    The rank is then numbered over those k rows only.
    """
    order = _order(value, key, ascending)
    best = df.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))


def top_k_per_group(
    df: DataFrame, group: str | list[str], value: str, key: str, k: int, ascending: bool
) -> DataFrame:
    """The ``k`` best rows of every group, numbered 1..k in ``rank``.

    ``row_number() <= k`` over a partitioned window is planned with a
    partial ``WindowGroupLimit`` before the shuffle on the group key, so
    at most k rows per group and task are shuffled, however large (or
    skewed) a group is.
    """
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*_order(value, key, ascending))
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def rank_all(df: DataFrame, value: str, key: str, ascending: bool, folder: str | None = None) -> DataFrame:
    """All rows numbered by ``value`` (a total order: ties broken by ``key``).

    Rows are range partitioned by the order, sorted in their partitions and
    written to ``folder`` (by default a new one below the shared work folder), so that
    every later step sees the same partitions.  A row's rank is its number in
    its partition plus the rows of the partitions before, and only the counts of
    the partitions are added up in one place.
    """
    spark = df.sparkSession
    folder = folder or scratch_dir(spark, "ranked")
    order = _order(value, key, ascending)
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    placed.write.mode("errorifexists").parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_here"), F.min("_at").alias("_first"))
    before = F.sum("_here").over(Window.orderBy("_part")) - F.col("_here")  # one row per partition
    shifts = counts.select("_part", (before - F.col("_first") + 1).alias("_shift"))
    return placed.join(shifts, "_part").withColumn("rank", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")
