"""Stand-in inputs derived from the driver tables.

* parallel corpus: a ``user`` turn of ``conversations`` with the ``assistant``
  turn right after it, ``pair_id = conv_id * 2**31 + turn``;
* evaluation set: expected = target text, predicted = source text, missing
  where the turn leaves 2 when divided by 3;
* score table: ``embeddings`` rows as positions (64 scores, label 0-9, label 0
  plays PAD), eight consecutive ``vec_id`` per example;
* metric log and artifact log: ``events`` (tag = ``event_type``,
  step = ``event_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.session import spread
from parallex.sources.corpus import TURN_ROOM, conversation_pairs, turn_id

POSITIONS_PER_EXAMPLE = 8
SCORE_PAD = 0
TRAIN_TAG, VAL_TAG = "click", "view"
STEPS_PER_EPOCH = 1000
RUNS = 7
BATCHES_PER_EPOCH = 50


TEXT_TABLES = ("conversations", "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Each is one file with a single row group, which a scan
    reads as one partition. Text tables feed CPU-heavy per-row work
    (tokenizing, edit distances), so ``spread`` deals them over the task
    slots; the other tables are cheap per row and are read as they are."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_pairs(table(spark, sf_dir, "conversations"))


def eval_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some predictions are missing, as those of rejected rows are."""
    turn = F.pmod("pair_id", F.lit(TURN_ROOM))
    return pairs(spark, sf_dir).select(
        "pair_id", F.col("src_text").alias("source"), F.col("trg_text").alias("expected"),
        F.when(turn % 3 != 2, F.col("src_text")).alias("predicted"))


def eval_by_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation set with the user turn of each pair as a grouping column."""
    return eval_set(spark, sf_dir).withColumn("turn", F.pmod(F.col("pair_id"), F.lit(TURN_ROOM)).cast("int"))


def routing_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as an input: user turns as their row id (found
    when a reply follows), other turns as text."""
    c = table(spark, sf_dir, "conversations")
    rid = turn_id(F.col("conv_id"), F.col("turn"))
    return c.select(rid.alias("input_id"),
                    F.when(F.col("role") == "user", rid.cast("string")).otherwise(F.col("text")).alias("input"))


def lookup_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn's row id as a lookup request (user turns with a
    reply are pairs; the other ids miss)."""
    c = table(spark, sf_dir, "conversations")
    return c.select(turn_id(F.col("conv_id"), F.col("turn")).alias("pair_id"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id",
                    (F.col("vec_id") / POSITIONS_PER_EXAMPLE).cast("long").alias("example_id"),
                    F.pmod(F.col("vec_id"), F.lit(POSITIONS_PER_EXAMPLE)).cast("int").alias("pos"),
                    F.col("embedding").alias("logits"), F.col("label").cast("int").alias("label"))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    # several runs, so that a reader that mixes them shows
    return e.select(F.pmod("user_id", F.lit(RUNS)).cast("string").alias("run"), F.col("event_type").alias("tag"),
                    F.col("event_id").cast("long").alias("step"), F.col("value").cast("double"),
                    F.col("ts"))


def artifact_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("run"), F.col("user_id").cast("int").alias("epoch"),
                    F.col("event_id").cast("long").alias("global_step"))
