"""Exact split, per-epoch shuffle, batches, collate, schedule, sample (F1-F6).

Order comes from ``md5(key | seed [| epoch])``: reproducible, independent of
partitioning, and evenly spread. Ranks come from ``hash_rank``: buckets on the
hash prefix, a bounded per-bucket count table and a window per bucket (no
single-task window, no sampling, no checkpoint).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parallex.operators.ranking import hash_rank


def order_hash(keys: Sequence[str], *salt: Column | str | int) -> Column:
    parts = [F.col(k).cast("string") for k in keys]
    parts += [s if isinstance(s, Column) else F.lit(str(s)) for s in salt]
    return F.md5(F.concat_ws("|", *parts))


def split_exact(df: DataFrame, keys: Sequence[str], fraction: float = 0.9,
                seed: int = 42) -> DataFrame:
    """Random split with exact sizes: ``floor(fraction * N)`` rows get
    ``split = 'train'``, the rest ``'val'``. Adds ``split_rank``."""
    h = order_hash(keys, seed)
    ranked = hash_rank(df.withColumn("_h", h), "_h", keys, rank_col="split_rank", total_col="_total")
    cut = F.floor(F.lit(float(fraction)) * F.col("_total"))
    return ranked.withColumn(
        "split", F.when(F.col("split_rank") <= cut, F.lit("train")).otherwise(F.lit("val"))
    ).drop("_h", "_total")


def shuffle_rank(df: DataFrame, keys: Sequence[str], seed: int, epochs: Sequence[int] | int) -> DataFrame:
    """Reshuffle per epoch: one row per (row, epoch) with its 1-based ``rank`` in
    that epoch's order. ``epochs`` is a count or an explicit list."""
    ep = list(range(epochs)) if isinstance(epochs, int) else list(epochs)
    if not ep:
        raise ValueError("no epochs")
    per_epoch = df.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in ep])))
    h = order_hash(keys, seed, F.col("epoch").cast("string"))
    ranked = hash_rank(per_epoch.withColumn("_h", h), "_h", keys, group=["epoch"],
                       rank_col="rank", total_col="epoch_rows", n_groups=len(ep))
    return ranked.drop("_h")


def assign_batches(ranked: DataFrame, batch_size: int, rank_col: str = "rank") -> DataFrame:
    """``batch_id = (rank - 1) div batch_size``; the last batch may be partial."""
    return ranked.withColumn("batch_id", ((F.col(rank_col) - 1) / F.lit(batch_size)).cast("long"))


def collate(batched: DataFrame, fields: Sequence[str], by: Sequence[str] = ("epoch", "batch_id"),
            rank_col: str = "rank") -> DataFrame:
    """Stack each field of a batch into an array, in rank order. A group holds
    at most ``batch_size`` rows, so the collected arrays are bounded."""
    packed = F.array_sort(F.collect_list(
        F.struct(rank_col, *[f for f in fields if f != rank_col]))).alias("_rows")
    grouped = batched.groupBy(*by).agg(packed)
    return grouped.select(*by, *[F.transform("_rows", _field(f)).alias(f) for f in fields])


def _field(name: str):
    def get(r):
        return r[name]
    return get


def epoch_schedule(df: DataFrame, keys: Sequence[str], seed: int, batch_size: int,
                   initial_epoch: int = 0, num_epochs: int = 10, start_step: int = 0) -> DataFrame:
    """Every row's batch and global step over epochs ``initial..num_epochs-1``.

    ``global_step = start_step + (epoch - initial) * ceil(N / B) + batch_id``,
    i.e. the step counter of a resumed run that counts batches from 0.
    """
    ranked = shuffle_rank(df, keys, seed, range(initial_epoch, num_epochs))
    batched = assign_batches(ranked, batch_size)
    per_epoch = F.ceil(F.col("epoch_rows") / F.lit(batch_size)).cast("long")
    return batched.withColumn(
        "global_step",
        F.lit(start_step).cast("long") + (F.col("epoch") - initial_epoch) * per_epoch + F.col("batch_id"),
    ).drop("epoch_rows")


def sample_examples(df: DataFrame, n: int, order: Sequence[str] = ("rank",)) -> DataFrame:
    """The first ``n`` rows in ``order`` (a top-k: each task keeps ``n`` rows)."""
    return df.orderBy(*order).limit(n)


def first_shuffled(df: DataFrame, keys: Sequence[str], seed: int, epoch: int, n: int) -> DataFrame:
    """The first ``n`` rows of an epoch's shuffled order with their ``rank``: a
    top-k on the order hash, without ranking the other rows."""
    h = order_hash(keys, seed, str(epoch))
    top = df.withColumn("_h", h).orderBy("_h", *keys).limit(n)
    # at most n rows: numbering them in one task is bounded by the feature itself
    return top.withColumn("rank", F.row_number().over(Window.orderBy("_h", *keys)).cast("long")).drop("_h")
