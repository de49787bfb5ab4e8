"""Model-ready examples (E1-E8) and the causal mask (E6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.config import EOS_ID, PAD_ID, SOS_ID
from parallex.functions import arrays as A
from parallex.operators.lengths import check_lengths


def build_examples(encoded: DataFrame, seq_len: int, on_error: str = "fail",
                   sos: int = SOS_ID, eos: int = EOS_ID, pad: int = PAD_ID,
                   key: str = "pair_id") -> DataFrame:
    """Whole example records from encoded pairs (one projection, no shuffle).

    Columns: ``encoder_input``, ``decoder_input``, ``label`` (``array<int>`` of
    length ``seq_len``), ``encoder_mask`` (0/1 per position), ``dec_valid``
    (non-PAD vector of the decoder input, the compact form of the decoder
    mask; see ``decoder_mask``), and both texts. ``on_error="annotate"`` keeps
    a pair that does not fit: its arrays are NULL and ``reason`` says why.
    ``"quarantine"`` drops such pairs, ``"fail"`` (as the reference) raises.
    """
    checked = check_lengths(encoded, seq_len, on_error)
    if on_error == "quarantine":
        checked = checked[0]
    enc = A.encoder_input(F.col("src_ids"), seq_len, sos, eos, pad)
    dec = A.decoder_input(F.col("trg_ids"), seq_len, sos, pad)
    arrays = {"encoder_input": enc, "decoder_input": dec, "label": A.label(F.col("trg_ids"), seq_len, eos, pad),
              "encoder_mask": A.non_pad(enc, pad), "dec_valid": A.non_pad(dec, pad)}
    if on_error == "annotate":
        arrays = {n: F.when(F.col("reason").isNull(), a) for n, a in arrays.items()}
    keep = [c for c in ("split", "reason") if c in checked.columns]
    return checked.select(key, *[a.alias(n) for n, a in arrays.items()], "src_text", "trg_text", *keep)


def decoder_mask(examples: DataFrame, key: str = "pair_id") -> DataFrame:
    """Expand ``dec_valid`` into the full ``L x L`` decoder mask per example."""
    return examples.select(key, A.expand_decoder_mask(F.col("dec_valid")).alias("decoder_mask"))


def causal_mask(spark: SparkSession, size: int) -> DataFrame:
    """Rows ``(i, j, allowed)`` of the ``size x size`` causal mask (j <= i).

    Each row ``i`` of a parallel ``range`` expands its own ``j`` values with a
    generator, so the cells are produced where they are needed, without a join.
    """
    return (spark.range(size).select(F.col("id").alias("i"))
            .select("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long"))).alias("j"))
            .select("i", "j", (F.col("j") <= F.col("i")).alias("allowed")))


def assert_example_sizes(examples: DataFrame, seq_len: int) -> DataFrame:
    """One row: are all three id arrays exactly ``seq_len`` long, and how many rows
    (rows without arrays, see ``reason``, have no size to check)."""
    ok = ((F.size("encoder_input") == seq_len) & (F.size("decoder_input") == seq_len)
          & (F.size("label") == seq_len))
    return examples.agg(F.coalesce(F.bool_and(ok), F.lit(True)).alias("all_sized"),
                        F.count("encoder_input").cast("long").alias("n_examples"))
