"""Vocabulary: build (C4), special ids (C2), size (C5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallex.config import SPECIAL_TOKENS
from parallex.functions.text import tokenize
from parallex.operators.ranking import exact_rank

VOCAB_SCHEMA = T.StructType([
    T.StructField("token", T.StringType(), False),
    T.StructField("id", T.IntegerType(), False),
    T.StructField("n", T.LongType(), False),
    T.StructField("is_special", T.BooleanType(), False),
])


def specials_frame(spark: SparkSession) -> DataFrame:
    rows = [(tok, i, 0, True) for i, tok in enumerate(SPECIAL_TOKENS)]
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


def build_vocab(texts: DataFrame, text_col: str = "text", mode: str = "word",
                min_count: int = 1, max_size: int | None = None,
                by: Sequence[str] = ()) -> DataFrame:
    """Vocabulary ``(*by, token, id, n, is_special)`` from a text column.

    Special tokens take ids 0-3; real tokens follow from id 4, most frequent
    first, ties by token. ``by`` builds one vocabulary per group (e.g. per
    language). Counting is a partial + final hash aggregate, so a very frequent
    token is pre-summed on every map task before the shuffle; ids come from an
    exact distributed rank, not a single-task window.
    """
    spark = texts.sparkSession
    by = list(by)
    counts = (
        texts.select(*by, F.explode(tokenize(F.col(text_col), mode)).alias("token"))
        .groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") >= min_count) & ~F.col("token").isin(*SPECIAL_TOKENS))
    )
    order = [F.col("n").desc(), F.col("token").asc()]
    ranked = exact_rank(counts, order, group=by)
    if max_size is not None:
        # a cut on the exact rank: distributed, unlike a limit of ``max_size`` rows
        ranked = ranked.where(F.col("rank") <= max(max_size - len(SPECIAL_TOKENS), 0))
    real = ranked.select(
        *by, "token",
        (F.col("rank") + len(SPECIAL_TOKENS) - 1).cast("int").alias("id"),
        F.col("n").cast("long").alias("n"),
        F.lit(False).alias("is_special"),
    )
    if not by:
        return specials_frame(spark).unionByName(real)
    specials = F.array(*[F.struct(F.lit(t).alias("token"), F.lit(i).alias("id"))
                         for i, t in enumerate(SPECIAL_TOKENS)])
    groups = texts.select(*by).distinct().select(*by, F.inline(specials))
    return groups.select(*by, "token", F.col("id").cast("int").alias("id"),
                         F.lit(0).cast("long").alias("n"), F.lit(True).alias("is_special")).unionByName(real)


def special_ids(vocab: DataFrame) -> dict[str, int]:
    """Ids of the special tokens (at most four rows reach the driver)."""
    rows = vocab.where(F.col("is_special")).select("token", "id").collect()
    ids = {r["token"]: int(r["id"]) for r in rows}
    missing = [t for t in SPECIAL_TOKENS if t not in ids]
    if missing:
        raise ValueError(f"vocabulary lacks special tokens {missing}")
    if len(set(ids.values())) != len(ids):
        raise ValueError(f"special tokens share ids: {ids}")
    return ids


ROW_OVERHEAD_BYTES = 32  # id, count, flag and row header of one broadcast vocabulary row


def vocab_stats(vocab: DataFrame, by: Sequence[str] = ()) -> tuple[int, int]:
    """``(rows, bytes per row)`` of a vocabulary: the input to the broadcast
    decision. Token lengths are measured, not assumed, so a vocabulary full of
    long junk tokens is not broadcast by mistake. A token with several rows (in
    a group of ``by``) is an error: a lookup would multiply its occurrences."""
    per = vocab.groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n"))
    r = per.agg(F.sum("n").alias("n"), F.sum(F.octet_length("token")).alias("b"), F.max("n").alias("most")).first()
    rows = int(r["n"] or 0)
    if (r["most"] or 0) > 1:
        raise ValueError("a token has more than one row in the vocabulary")
    total = int(r["b"] or 0) + ROW_OVERHEAD_BYTES * rows
    return rows, -(-total // max(rows, 1))


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count(F.lit(1)).cast("long").alias("vocab_size"))
