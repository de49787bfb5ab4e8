"""End-to-end jobs composed from the operators.

``prepare`` is the data half of the training entry: vocabulary (get or build),
encode once, exact split, length check with quarantine, and the epoch schedule,
all written as tables (each write also cuts the lineage for what follows).
``evaluate`` is the metric half of validation: CER, WER and BLEU of an
evaluation table in one row, optionally appended to the metric log.
``log_losses`` writes the training and validation losses that the curves read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.config import PAD_ID, Options
from parallex.functions import arrays as A
from parallex.operators.curves import train_epoch
from parallex.operators.decoding import Scorer, greedy_decode, source_prompts
from parallex.operators.encode import decode, encode_sides
from parallex.operators.lengths import check_lengths
from parallex.operators.metrics import bleu, char_count, with_char_edits, with_word_edits
from parallex.operators.sampling import collate, epoch_schedule, first_shuffled, split_exact
from parallex.operators.scoring import masked_ce, mean_val_loss
from parallex.session import pin
from parallex.sources.runlog import append_metrics, comparison_report, write_report
from parallex.sources.vocab_store import get_or_build_vocab

# The metric tags the training and validation steps log under.
CER_TAG, WER_TAG, BLEU_TAG = "validation cer", "validation wer", "validation BLEU"
TRAIN_LOSS_TAG, VAL_LOSS_TAG = "train loss", "validation loss"
SIDES = {"src_ids": "src_text", "trg_ids": "trg_text"}


def prepare(spark: SparkSession, pairs: DataFrame, out_dir: str, opts: Options = Options(),
            vocab_path: str | None = None, mode: str = "word", min_count: int = 1,
            initial_epoch: int = 0, start_step: int = 0, shared_vocab: bool = True) -> DataFrame:
    """Prepare a corpus ``(pair_id, src_text, trg_text)`` for training.

    Writes ``vocab`` (unless ``vocab_path`` already holds one; with
    ``shared_vocab=False`` one for each side, ``vocab_src`` and ``vocab_trg``),
    ``encoded`` (every pair once: unpadded ids, lengths, and the ``reason`` of a
    pair that does not fit ``opts.seq_len``, partitioned by ``status`` and
    ``split``; examples are padded on read with ``build_examples``) and
    ``schedule`` (train rows per epoch with batch and global step). Both name a
    row by ``row_id``, so rows whose ``pair_id`` is NULL or repeated are split,
    scheduled and batched like any other. Returns a summary per split.
    """
    path = vocab_path or f"{out_dir}/vocab"
    sides = {"src": pairs.select(F.col("src_text").alias("text")), "trg": pairs.select(F.col("trg_text").alias("text"))}
    if shared_vocab:
        both = get_or_build_vocab(spark, path, sides["src"].unionByName(sides["trg"]), "text", mode, min_count)
        vocabs = {"src_ids": both, "trg_ids": both}
    else:
        vocabs = {f"{s}_ids": get_or_build_vocab(spark, f"{path}_{s}", t, "text", mode, min_count) for s, t in sides.items()}
    # the rank in the split's order names a row; its pair_id may be NULL or repeated
    named = split_exact(pairs.select("pair_id", "src_text", "trg_text"), ["pair_id", "src_text", "trg_text"],
                        opts.train_fraction, opts.seed).withColumnRenamed("split_rank", "row_id")
    annotated = check_lengths(encode_sides(named, SIDES, vocabs, mode), opts.seq_len, "annotate")
    (annotated.select("row_id", "pair_id", "src_text", "trg_text", "src_ids", "trg_ids", F.size("src_ids").alias("n_src"),
                      F.size("trg_ids").alias("n_trg"), "reason",
                      F.when(F.col("reason").isNull(), "kept").otherwise("rejected").alias("status"), "split")
     .write.mode("overwrite").partitionBy("status", "split").parquet(f"{out_dir}/encoded"))
    encoded = read_prepared(spark, out_dir)
    train = encoded.where(F.col("split") == "train").select("row_id", "pair_id")
    (epoch_schedule(train, ["row_id"], opts.seed, opts.batch_size, initial_epoch, opts.num_epochs, start_step)
     .select("epoch", "batch_id", "global_step", "rank", "row_id", "pair_id")
     .write.mode("overwrite").partitionBy("epoch").parquet(f"{out_dir}/schedule"))
    return encoded.groupBy("split").agg(
        F.count(F.lit(1)).cast("long").alias("pairs"),
        F.max("n_src").cast("long").alias("max_src"),
        F.max("n_trg").cast("long").alias("max_trg"))


ENCODED_SCHEMA = ("row_id bigint, pair_id bigint, src_text string, trg_text string, src_ids array<int>, "
                  "trg_ids array<int>, n_src int, n_trg int, reason string, status string, split string")


def read_prepared(spark: SparkSession, out_dir: str, split: str | None = None, status: str = "kept") -> DataFrame:
    """Encoded pairs of one split or all of them, those that fit or (``status``
    ``rejected``) those that do not: partition filters."""
    enc = spark.read.schema(ENCODED_SCHEMA).parquet(f"{out_dir}/encoded").where(F.col("status") == status).drop("status")
    enc = enc.drop("reason") if status == "kept" else enc
    return enc if split is None else enc.where(F.col("split") == split)


BATCH_FIELDS = ("encoder_input", "decoder_input", "label", "encoder_mask", "dec_valid")


def training_batches(encoded: DataFrame, schedule: DataFrame, seq_len: int, key: str = "row_id") -> DataFrame:
    """The batches that training reads: ``(epoch, batch_id, global_step, pair_id,
    *BATCH_FIELDS)``, each field the stacked rows of the batch in their order.

    Rows are matched by ``key``, one that names a row in both tables. The ids
    travel unpadded through the join and into the batches; padding is the last
    projection, over the at most ``batch_size`` rows of a batch.
    """
    fits = check_lengths(encoded.select(key, "pair_id", "src_ids", "trg_ids"), seq_len)
    by = ["epoch", "batch_id", "global_step"]
    rows = schedule.select(*by, "rank", key).join(fits, key)
    stacked = collate(rows, ["pair_id", "src_ids", "trg_ids"], by)
    fields = {"encoder_input": F.transform("src_ids", lambda x: A.encoder_input(x, seq_len)),
              "decoder_input": F.transform("trg_ids", lambda x: A.decoder_input(x, seq_len)),
              "label": F.transform("trg_ids", lambda x: A.label(x, seq_len)),
              "encoder_mask": F.transform("src_ids", lambda x: A.filled(F.size(x) + 2, seq_len)),
              "dec_valid": F.transform("trg_ids", lambda x: A.filled(F.size(x) + 1, seq_len))}
    return stacked.select(*by, "pair_id", *[fields[f].alias(f) for f in BATCH_FIELDS])


def log_losses(scores: DataFrame, metric_log: str, run: str, steps_per_epoch: int, pad: int = PAD_ID,
               smoothing: float = 0.1, val_scores: DataFrame | None = None) -> None:
    """Append what a run logs: the smoothed loss of every training batch (the
    batch is ``example_id``, and its step) under the training tag and, at the
    end of each epoch, the unweighted mean of the validation batches' losses
    under the validation tag. ``val_scores`` has an ``epoch``; without it the
    training batches of an epoch are scored."""
    per_step = masked_ce(scores, pad, smoothing, by=["example_id"])
    train = per_step.select(F.lit(run).alias("run"), F.lit(TRAIN_LOSS_TAG).alias("tag"),
                            F.col("example_id").cast("long").alias("step"), F.col("loss").alias("value"))
    if val_scores is None:
        val_scores = scores.withColumn("epoch", train_epoch(F.col("example_id"), steps_per_epoch))
    per_batch = masked_ce(val_scores, pad, 0.0, by=["epoch", "example_id"])
    val = mean_val_loss(per_batch, by=["epoch"]).select(
        F.lit(run).alias("run"), F.lit(VAL_LOSS_TAG).alias("tag"),
        ((F.col("epoch") + 1) * steps_per_epoch).cast("long").alias("step"), F.col("mean_loss").alias("value"))
    append_metrics(train.unionByName(val).withColumn("ts", F.current_timestamp()), metric_log)


def evaluate(ev: DataFrame, pred: str = "predicted", exp: str = "expected",
             metric_log: str | None = None, step: int = 0, run: str = "default") -> DataFrame:
    """CER, WER and BLEU of an evaluation table in one row; with ``metric_log``,
    the three values are appended to it at ``step``."""
    scored = with_char_edits(with_word_edits(ev.select(pred, exp), pred, exp, "_wedits", "_wlen"), pred, exp, "_cedits").select(
        "_wedits", "_wlen", "_cedits", char_count(F.col(exp)).alias("_clen"))
    rates = scored.agg(
        (F.sum("_cedits") / F.nullif(F.sum("_clen"), F.lit(0))).alias("cer"),
        (F.sum("_wedits") / F.nullif(F.sum("_wlen"), F.lit(0))).alias("wer"),
        F.lit(None).cast("double").alias("bleu"))
    b = bleu(ev, pred, exp).select(
        F.lit(None).cast("double").alias("cer"), F.lit(None).cast("double").alias("wer"), "bleu")
    # two one-row results stacked and folded, instead of a join on a constant
    out = rates.unionByName(b).agg(*[F.max(c).alias(c) for c in ("cer", "wer", "bleu")])
    if metric_log:
        spark = ev.sparkSession
        vals = out.first()
        # an empty set has no rate: its value is NULL, the entry stays
        log = spark.createDataFrame(
            [(run, tag, step, None if vals[c] is None else float(vals[c]))
             for tag, c in ((CER_TAG, "cer"), (WER_TAG, "wer"), (BLEU_TAG, "bleu"))],
            "run string, tag string, step long, value double").withColumn("ts", F.current_timestamp())
        append_metrics(log, metric_log)
    return out


def validate(val_pairs: DataFrame, vocab: DataFrame, scorer: Scorer, opts: Options = Options(),
             num_examples: int | None = None, epoch: int = 0, scores: DataFrame | None = None,
             metric_log: str | None = None, step: int = 0, report_path: str | None = None,
             strip_special: bool = False, mode: str = "word", run: str = "default") -> dict[str, DataFrame]:
    """The validation entry: greedy-decode the validation pairs from [SOS] given
    their encoder input, decode the ids to text, and score the predictions
    against the targets.

    ``val_pairs`` holds ``(pair_id, src_text, trg_text, src_ids)``; rows are named
    by a generated id, so a pair_id may be NULL or repeated. A pair whose
    source does not fit ``opts.seq_len`` keeps its row, without a prediction,
    and counts as one in full error.
    ``num_examples`` keeps only the first rows of the epoch's shuffled order (the
    reference stops after 2; ``None`` keeps all). ``scores`` (per-position
    score vectors with ``example_id``, ``logits`` and ``label``) adds the mean
    validation loss. Returns ``eval`` (pair_id, source, expected, predicted),
    ``metrics`` (cer, wer, bleu[, mean_loss]) and ``report``; the metrics are
    appended to ``metric_log`` and the report written to ``report_path`` when
    given.
    """
    rows = pin(val_pairs.select("pair_id", "src_text", "trg_text", "src_ids").withColumn("_row", F.monotonically_increasing_id()))
    if num_examples is not None:
        first = first_shuffled(rows.drop("src_ids"), ["pair_id", "src_text", "trg_text"], opts.seed, epoch, num_examples)
        rows = rows.join(F.broadcast(first.select("_row")), "_row", "left_semi")  # num_examples rows
    out = greedy_decode(source_prompts(rows, opts.seq_len, "_row"), scorer, opts.seq_len, key="_row")
    text = decode(out.select("_row", "ids"), {"predicted": "ids"}, vocab, mode, strip_special=strip_special)
    # written once to the shared folder: the metrics and the report both read it
    ev = pin(rows.select("_row", "pair_id", F.col("src_text").alias("source"), F.col("trg_text").alias("expected"))
             .join(text.drop("ids"), "_row", "left").drop("_row"))
    metrics = evaluate(ev, metric_log=metric_log, step=step, run=run)
    if scores is not None:
        per_example = masked_ce(scores, smoothing=0.0, by=["example_id"])
        loss = mean_val_loss(per_example).select("mean_loss")
        # two one-row results stacked and folded (no join)
        metrics = metrics.unionByName(loss, allowMissingColumns=True).agg(
            *[F.max(c).alias(c) for c in ("cer", "wer", "bleu", "mean_loss")])
    report = comparison_report(ev)
    if report_path:
        write_report(report, report_path)
    return {"eval": ev, "metrics": metrics, "report": report}

