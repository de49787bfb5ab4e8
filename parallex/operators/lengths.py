"""Token lengths (D1), corpus maxima (D2) and the length check (D3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def token_lengths(encoded: DataFrame, src: str = "src_ids", trg: str = "trg_ids",
                  key: str = "pair_id") -> DataFrame:
    """Token count per side, without SOS/EOS."""
    return encoded.select(key, F.size(src).cast("long").alias("n_src"),
                          F.size(trg).cast("long").alias("n_trg"))


def max_lengths(encoded: DataFrame, src: str = "src_ids", trg: str = "trg_ids") -> DataFrame:
    """Longest source and target over the whole corpus (partial + final max)."""
    return encoded.agg(F.max(F.size(src)).cast("long").alias("max_src"),
                       F.max(F.size(trg)).cast("long").alias("max_trg"))


TEXT_COLUMNS = ("src_text", "trg_text")


def length_reason(seq_len: int, src: str = "src_ids", trg: str = "trg_ids",
                  texts: tuple[str, ...] = ()):
    """NULL when the pair fits ``seq_len`` (source + SOS + EOS, target + SOS),
    else why it does not; a NULL text (when text columns are given) is
    ``null_text``."""
    rules = [(F.col(t).isNull(), "null_text") for t in texts]
    rules += [(F.size(src) > seq_len - 2, "src_too_long"), (F.size(trg) > seq_len - 1, "trg_too_long")]
    reason = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, why in rules[1:]:
        reason = reason.when(cond, F.lit(why))
    return reason


def check_lengths(encoded: DataFrame, seq_len: int, on_error: str = "fail",
                  src: str = "src_ids", trg: str = "trg_ids"):
    """Length check.

    ``fail``: the rows unchanged, with a ``raise_error`` evaluated per row, so the
    first action over a too-long pair fails as the reference does. A NULL
    ``src_text``/``trg_text`` (when present) counts as ``null_text``.
    ``quarantine``: ``(kept, rejected)`` where rejected carries ``reason``.
    ``annotate``: every row with a ``reason`` column (NULL when kept).
    """
    texts = tuple(t for t in TEXT_COLUMNS if t in encoded.columns)
    reason = length_reason(seq_len, src, trg, texts)
    if on_error == "fail":
        guard = F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit("Sentence is too long or missing: "), reason)))
        return encoded.where(guard.isNull())
    annotated = encoded.withColumn("reason", reason)
    if on_error == "annotate":
        return annotated
    if on_error == "quarantine":
        kept = annotated.where(F.col("reason").isNull()).drop("reason")
        rejected = annotated.where(F.col("reason").isNotNull())
        return kept, rejected
    raise ValueError(f"unknown on_error {on_error!r}")
