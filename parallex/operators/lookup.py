"""Skew-safe many-to-one lookup join.

A lookup where many rows share one key (every prompt starts with [SOS], "the"
is a few percent of all words, one key may hold a third of all rows) must not
send a hot key to one task.

* A small side (row count checked against a byte bound) is broadcast.
* Otherwise the hot keys of the big side are found first: keys with more rows
  than one partition's fair share (``total / partitions``). There are at most
  ``partitions`` of them, so that table is broadcast safely. A hot key with
  ``n`` rows is split over ``ceil(n / fair_share)`` salts on the big side, and
  only its row on the small side is replicated that many times; every other
  key joins with salt 0. The replication is bounded by twice the partition
  count in total, whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallex.session import DEFAULT_ROW_BYTES, is_broadcastable, work_partitions


def hot_keys(big: DataFrame, key: str, partitions: int) -> DataFrame:
    """``(key, _salts)`` for keys holding more than ``total / partitions`` rows."""
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    fair = max(total // max(partitions, 1), 1)
    return counts.where(F.col("_n") > fair).select(
        key, F.ceil(F.col("_n") / F.lit(fair)).cast("int").alias("_salts"))


def lookup_join(big: DataFrame, big_key: Column, small: DataFrame, small_key: str,
                how: str = "left", small_rows: int | None = None,
                row_bytes: int = DEFAULT_ROW_BYTES, salt_source: Column | None = None,
                partitions: int | None = None) -> DataFrame:
    """Join ``big`` to ``small`` (unique ``small_key``) on ``big_key == small_key``.

    ``salt_source`` is a big-side expression that differs among the rows sharing
    a key (a row id, with the position if a row has several); it spreads a hot
    key's rows over its salts.
    """
    n = small_rows if small_rows is not None else small.count()
    if is_broadcastable(n, row_bytes):
        return big.join(F.broadcast(small), big_key == F.col(small_key), how)
    parts = partitions or work_partitions(big.sparkSession)
    b = big.withColumn("_k", big_key)
    # at most ``parts`` rows, found once: the plan below mentions ``big`` once
    found = hot_keys(b, "_k", parts)
    hot = F.broadcast(big.sparkSession.createDataFrame(found.collect(), found.schema))
    src = salt_source if salt_source is not None else F.monotonically_increasing_id()
    b = b.join(hot, "_k", "left").withColumn(
        "_salt", F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(src), F.col("_salts")).cast("int"))).drop("_salts")
    s = small.join(hot.withColumnRenamed("_k", small_key), small_key, "left").withColumn(
        "_salt2", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    joined = b.join(s, (F.col("_k") == F.col(small_key)) & (F.col("_salt") == F.col("_salt2")), how)
    return joined.drop("_k", "_salt", "_salt2")
