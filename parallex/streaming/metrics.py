"""Streaming log of scalar metrics (A7): append, and the last value of each step.

The metric log is append-only and needs no state: a stream of
``(run, tag, step, value, ts)`` rows is written as Parquet partitioned by tag,
with a checkpoint so a restarted query neither loses nor repeats rows.

A step may be logged more than once (a validation that runs twice at one step).
``last_values_stream`` keeps, in keyed state, the value logged last for each (run,
tag, step) and writes what a micro-batch changed under the batch's own name. A
batch that is run again after a failure starts from the same state and replaces
its own output, so the log holds every change exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parallex.sources.runlog import METRIC_SCHEMA


def metrics_stream(stream: DataFrame, out_path: str, checkpoint_path: str,
                   available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the append query; ``available_now`` drains what is there and stops."""
    writer = (stream.select(*[f.name for f in METRIC_SCHEMA]).writeStream
              .format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_path)
              .partitionBy("tag"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(out_path)


KEYS = ("run", "tag", "step")


def last_values_stream(stream: DataFrame, out_path: str, checkpoint_path: str, lateness: str | None = None) -> StreamingQuery:
    """Start the query that keeps the last value of each step (by time, then by the
    greater value); it drains what is there and stops. The state holds a row per
    step; with ``lateness`` (an interval) rows older than the newest by more than it
    are not expected any more and their state is let go."""
    rows = stream.select(*[f.name for f in METRIC_SCHEMA])
    keys = list(KEYS)
    if lateness:
        rows = rows.withWatermark("ts", lateness)
        keys.append("day")
        rows = rows.withColumn("day", F.window("ts", "1 day")["start"])
    last = rows.groupBy(*keys).agg(F.max(F.struct("ts", "value")).alias("last")).select(*KEYS, "last.ts", "last.value")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return (last.writeStream.outputMode("update").option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).foreachBatch(write).start())


def read_last_values(spark: SparkSession, out_path: str) -> DataFrame:
    """``(run, tag, step, ts, value)``: the newest state of every step."""
    log = spark.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in METRIC_SCHEMA)}, batch long").parquet(out_path)
    return log.groupBy(*KEYS).agg(F.max(F.struct("ts", "value")).alias("last")).select(*KEYS, "last.ts", "last.value")
