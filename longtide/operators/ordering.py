"""Numbers in a total order without one task that sorts everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

#: Up to so many rows one task may number them all.
ONE_TASK_ROWS = 200_000


def numbered(df: DataFrame, name: str, *order: str | Column, one_task: int = ONE_TASK_ROWS) -> DataFrame:
    """Adds ``name``, the place of each row from 1 in ``order``, which should be total. A small table is numbered by one window;
    a larger one is sorted by ranges, numbered within each range, and shifted by the sizes of the ranges before it, of
    which there are as many as partitions."""
    if df.limit(one_task + 1).count() <= one_task:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))
    keyed = df.orderBy(*order).withColumn("__range", F.spark_partition_id())
    kept = staged(keyed, "ordered")
    sizes = sorted((r[0], r[1]) for r in kept.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect())
    before, shift = 0, []
    for part, n in sizes:
        shift += [F.lit(part), F.lit(before)]
        before += n
    w = Window.partitionBy("__range").orderBy(*order)
    return kept.withColumn(name, (F.row_number().over(w) + F.create_map(*shift)[F.col("__range")]).cast("bigint")).drop("__range")
