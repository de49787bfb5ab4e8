"""Evaluation of dumped model scores (G3-G6).

Input is a table of per-position score vectors written by any system. Every
loss is a per-row expression plus a partial + final aggregate.

The ``_long`` forms read one score a row. Log-sum-exp merges: each chunk of the
vocabulary gives one number, and the log-sum-exp of those numbers is that of the
whole. No task holds an array as long as the vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallex.config import PAD_ID
from parallex.functions.scores import logsumexp, smoothed_nll


def flatten_scores(df: DataFrame, key: str, logits: str = "logits", labels: str = "labels") -> DataFrame:
    """``(key, logits: array<array<float>> [L][V], labels: array<int> [L])`` to one
    row per position ``(key, pos, logits: array<float>, label)``."""
    return (df.select(key, F.posexplode(F.arrays_zip(F.col(logits).alias("l"), F.col(labels).alias("y"))))
            .select(key, F.col("pos"), F.col("col.l").alias("logits"), F.col("col.y").alias("label")))


def masked_ce(scores: DataFrame, pad: int = PAD_ID, smoothing: float = 0.0,
              by: Sequence[str] = (), logits: str = "logits", label: str = "label") -> DataFrame:
    """Mean cross-entropy over positions whose label is not ``pad``, per ``by``
    group (one row without ``by``). ``smoothing`` > 0 gives label smoothing."""
    kept = scores.where(F.col(label) != F.lit(pad))
    loss = smoothed_nll(F.col(logits), F.col(label), smoothing)
    return kept.groupBy(*by).agg(F.avg(loss).alias("loss"),
                                 F.count(F.lit(1)).cast("long").alias("n_positions"))


def mean_val_loss(batch_losses: DataFrame, loss: str = "loss", by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean of per-batch mean losses; 0 when there is no batch."""
    return batch_losses.groupBy(*by).agg(
        F.coalesce(F.avg(loss), F.lit(0.0)).alias("mean_loss"),
        F.count(F.lit(1)).cast("long").alias("n_batches"))


def to_long(scores: DataFrame, keys: Sequence[str], logits: str = "logits",
            token: str = "token_id", score: str = "score") -> DataFrame:
    """Array scores to long form ``(*keys, token_id, score)``."""
    return scores.select(*keys, F.posexplode(logits).alias(token, score)).select(
        *keys, F.col(token).cast("int").alias(token), F.col(score).cast("double").alias(score))


def top1_long(scores_long: DataFrame, by: Sequence[str], token: str = "token_id",
              score: str = "score") -> DataFrame:
    """Best token per ``by`` group of a long score table (ties: lowest id). A
    partial + final ``max_by``: each map task keeps one candidate per group."""
    return scores_long.groupBy(*by).agg(
        F.max_by(token, F.struct(F.col(score), -F.col(token))).alias("top1"))


VOCAB_CHUNK = 1024  # scores of one position that one task holds together


def _chunk_sums(scores_long: DataFrame, by: Sequence[str], token: str, score: str, chunk: int,
                *extra: Column) -> DataFrame:
    """Per ``by``: ``lse`` (log-sum-exp of the scores), ``total`` and ``n``."""
    x = F.collect_list(F.col(score).cast("double")).alias("_x")
    parts = scores_long.groupBy(*by, F.expr(f"`{token}` div {chunk}").alias("_chunk")).agg(x, *[F.max(c).alias(f"_e{i}") for i, c in enumerate(extra)])
    parts = parts.select(*by, logsumexp(F.col("_x")).alias("_lse"), F.size("_x").alias("_n"), *[f"_e{i}" for i in range(len(extra))],
                         F.aggregate("_x", F.lit(0.0), lambda a, v: a + v).alias("_sum"))
    whole = parts.groupBy(*by).agg(F.collect_list("_lse").alias("_lses"), F.sum("_sum").alias("total"), F.sum("_n").cast("long").alias("n"),
                                   *[F.max(f"_e{i}").alias(f"_e{i}") for i in range(len(extra))])
    return whole.select(*by, logsumexp(F.col("_lses")).alias("lse"), "total", "n", *[f"_e{i}" for i in range(len(extra))])


def log_softmax_long(scores_long: DataFrame, by: Sequence[str], token: str = "token_id", score: str = "score",
                     chunk: int = VOCAB_CHUNK) -> DataFrame:
    """``scores_long`` with ``log_prob``: log-softmax over the tokens of each ``by``
    group. A token id occurs once in a group."""
    sums = _chunk_sums(scores_long, by, token, score, chunk).select(*by, "lse")
    return scores_long.join(sums, list(by)).withColumn("log_prob", F.col(score).cast("double") - F.col("lse")).drop("lse")


def masked_ce_long(scores_long: DataFrame, labels: DataFrame, keys: Sequence[str], pad: int = PAD_ID, smoothing: float = 0.0,
                   by: Sequence[str] = (), token: str = "token_id", score: str = "score", label: str = "label",
                   chunk: int = VOCAB_CHUNK) -> DataFrame:
    """``masked_ce`` over long scores: ``labels`` has one row ``(*keys, label)`` per
    position, ``by`` are among the keys. A label without a score row has no loss
    (NULL), which the mean leaves out."""
    kept = labels.where(F.col(label) != F.lit(pad)).select(*keys, F.col(label).alias("_label"))
    rows = scores_long.join(kept, list(keys))
    target = F.when(F.col(token) == F.col("_label"), F.col(score).cast("double"))
    sums = _chunk_sums(rows, keys, token, score, chunk, target)
    nll = F.col("lse") - F.col("_e0")
    loss = nll if smoothing == 0 else (1.0 - smoothing) * nll + smoothing * (F.col("lse") - F.col("total") / F.col("n"))
    return sums.groupBy(*by).agg(F.avg(loss).alias("loss"), F.count(F.lit(1)).cast("long").alias("n_positions"))
