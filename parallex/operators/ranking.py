"""Exact global rank without moving every row into one task.

``row_number()`` over an un-partitioned window sends the whole table to a
single task. Instead the rows are range-partitioned on the ordering (so every
task gets an even, contiguous slice), sorted inside each partition, and numbered
locally; a tiny per-partition count table (one row per partition and group)
turns local numbers into global ones. The count table is bounded by the number
of partitions plus the number of groups, so it is broadcast safely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parallex.session import broadcast_checked, pin

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def exact_rank(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (),
               rank_col: str = "rank", num_partitions: int | None = None,
               total_col: str | None = None) -> DataFrame:
    """Add a 1-based ``rank_col``: the row's position in ``order`` within ``group``.

    ``order`` must be a total order (end it with a unique key), which makes the
    numbering deterministic when a partition is recomputed. The numbered rows
    are written to the shared checkpoint folder first: range bounds are sampled,
    so the count pass and the numbering pass must read the same partitions. ``total_col``
    adds the row count of the row's group.
    """
    keys = [F.col(g) for g in group] + list(order)
    # Without an explicit count AQE may merge neighbouring ranges; merged
    # partitions stay contiguous in the order, so the numbering still holds.
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    numbered = pin(
        ranged
        .sortWithinPartitions(*keys)
        .withColumn("_rid", F.monotonically_increasing_id())
    )
    part = F.shiftright(F.col("_rid"), _LOCAL_BITS)
    numbered = numbered.withColumn("_part", part).withColumn(
        "_local", F.col("_rid") - F.shiftleft(F.col("_part"), _LOCAL_BITS))

    gcols = list(group)
    counts = numbered.groupBy("_part", *gcols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    w = Window.partitionBy(*gcols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*gcols)
    offsets = counts.select(
        "_part", *gcols, "_first",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"),
        F.sum("_n").over(whole).alias("_total"))
    # without groups the table has one row per partition; the partition count of
    # a checkpointed frame is known without running anything
    bound = numbered.rdd.getNumPartitions() if not gcols else None
    offsets = broadcast_checked(offsets, known_rows=bound)
    ranked = numbered.join(offsets, ["_part", *gcols], "inner").withColumn(
        rank_col, F.col("_offset") + F.col("_local") - F.col("_first") + 1)
    drop = ["_rid", "_part", "_local", "_first", "_offset"]
    if total_col:
        ranked = ranked.withColumnRenamed("_total", total_col)
    else:
        drop.append("_total")
    return ranked.drop(*drop)


HASH_PREFIX_HEX = 4  # 65 536 buckets


def hash_rank(df: DataFrame, hash_col: str, tiebreak: Sequence[str], group: Sequence[str] = (),
              rank_col: str = "rank", total_col: str | None = None,
              prefix_hex: int = HASH_PREFIX_HEX, n_groups: int | None = None) -> DataFrame:
    """Exact rank in ``(hash_col, *tiebreak)`` order, for a uniform hex hash
    (md5) — deterministic, with no sampling and no checkpoint.

    The leading ``prefix_hex`` hex digits cut the order into ``16**prefix_hex``
    contiguous buckets of equal expected size. A rank is the number of rows in
    earlier buckets (from a per-bucket count table, at most one row per bucket
    and group, broadcast) plus the row number inside the bucket (a window
    partitioned by bucket, so buckets spread over all tasks). ``n_groups``
    (when known) bounds the count table without counting it.
    """
    gcols = list(group)
    bucket = F.conv(F.substring(F.col(hash_col), 1, prefix_hex), 16, 10).cast("int")
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy(*gcols, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*gcols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*gcols)
    offsets = counts.select(*gcols, "_bucket",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                            F.sum("_n").over(whole).alias("_total"))
    bound = 16 ** prefix_hex * (n_groups if n_groups is not None else 1) if (n_groups or not gcols) else None
    offsets = broadcast_checked(offsets, known_rows=bound)
    inside = Window.partitionBy(*gcols, "_bucket").orderBy(F.col(hash_col), *[F.col(c) for c in tiebreak])
    ranked = (b.withColumn("_rn", F.row_number().over(inside))
              .join(offsets, [*gcols, "_bucket"], "inner")
              .withColumn(rank_col, F.col("_offset") + F.col("_rn")))
    drop = ["_bucket", "_rn", "_offset"]
    if total_col:
        ranked = ranked.withColumnRenamed("_total", total_col)
    else:
        drop.append("_total")
    return ranked.drop(*drop)
