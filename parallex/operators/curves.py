"""Loss curves from a metric log ``(run, tag, step, value, ts)`` (J1-J3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_step(log: DataFrame, order: str = "ts") -> DataFrame:
    """One value per ``(run, tag, step)``: the last one written (a run that logs a
    metric twice at one step keeps the later value; of values written at the
    same moment the largest). ``order`` is required: without it "last" has no
    meaning."""
    if order not in log.columns:
        raise ValueError(f"the log has no column {order!r} to tell which value was written last")
    return log.groupBy("run", "tag", "step").agg(F.max_by("value", F.struct(order, "value")).alias("value"))


def train_curve(log: DataFrame, tag: str = "train loss") -> DataFrame:
    """``(run, step, value)`` of the per-step training loss, in step order."""
    return last_per_step(log.where(F.col("tag") == tag)).select("run", "step", "value").orderBy("run", "step")


def train_epoch(step, steps_per_epoch: int):
    """Training losses are logged before the step counter moves: steps
    ``e*S .. (e+1)*S - 1`` belong to epoch ``e``."""
    return F.floor(step / F.lit(steps_per_epoch)).cast("long")


def val_epoch(step, steps_per_epoch: int):
    """Validation of epoch ``e`` is logged after its last batch, at step
    ``(e+1)*S``: steps ``e*S + 1 .. (e+1)*S`` belong to epoch ``e``."""
    return F.floor((step - 1) / F.lit(steps_per_epoch)).cast("long")


def val_curve(log: DataFrame, steps_per_epoch: int, tag: str = "validation loss") -> DataFrame:
    """One validation value per run and epoch (the last logged for that epoch)."""
    per = last_per_step(log.where(F.col("tag") == tag))
    return (per.withColumn("epoch", val_epoch(F.col("step"), steps_per_epoch))
            .groupBy("run", "epoch").agg(F.max_by("value", F.col("step")).alias("val_loss"))
            .orderBy("run", "epoch"))


def loss_curves(log: DataFrame, steps_per_epoch: int, train_tag: str = "train loss",
                val_tag: str = "validation loss") -> DataFrame:
    """Per run and epoch: mean training loss and the epoch's validation loss, aligned on
    the epoch (training steps ``e*S ..``, validation at ``(e+1)*S``)."""
    train = (last_per_step(log.where(F.col("tag") == train_tag))
             .withColumn("epoch", train_epoch(F.col("step"), steps_per_epoch))
             .groupBy("run", "epoch").agg(F.avg("value").alias("train_loss"),
                                   F.count(F.lit(1)).cast("long").alias("train_steps")))
    val = val_curve(log, steps_per_epoch, val_tag)
    return train.join(val, ["run", "epoch"], "left").orderBy("run", "epoch")
