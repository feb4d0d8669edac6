"""Continuous update: micro-batches of observations merged into a store under the same contract as the batch merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import KEYS, changed_keys, merge_and_write


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str] = KEYS, changed_path: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Merges every micro-batch into the table at ``path``; appends what each changed to ``changed_path``. A batch that is run
    again after a failure merges to the same table, as the last row of a key wins."""

    def write(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            _, _, changed = merge_and_write(spark, path, batch, keys=list(keys), report_changed=changed_path is not None)
            if changed is not None:
                changed.withColumn("batch", F.lit(number)).write.mode("append").parquet(changed_path)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_activity(events: DataFrame, time: str, width: str, late: str, by: list[str]) -> DataFrame:
    """Counts and sums per tumbling window; rows later than ``late`` behind the newest are dropped from a stream's windows."""
    w = events.withWatermark(time, late) if events.isStreaming else events
    return w.groupBy(F.window(time, width), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), *by, "n", "total")


__all__ = ["changed_keys", "upsert_stream", "windowed_activity"]
