"""Corpus-level text metrics: CER (H1), WER (H2), BLEU (H3).

Each metric sums numerators and denominators over all rows (optionally per
``by`` group) and divides once. Character distances are Spark's built-in
``levenshtein`` (code points, inside codegen); word distances go by bit vectors,
a column of the table at once (``operators.edits``). Pairs too long for one task
are cut into blocks (``operators.edits``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from parallex.functions.text import chars, words
from parallex.operators.edits import BLOCK, bit_edits, long_edits
from parallex.session import by_key, pin

# Longest side, in tokens, that one task takes whole; beyond it a pair is cut into
# blocks of this size, or of ``BLOCK`` if that is less.
WORD_BLOCK, CHAR_BLOCK = 1 << 14, 1 << 14


@F.pandas_udf(IntegerType())
def _bit_edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([bit_edits(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="int32")


def char_edits(pred: Column, exp: Column) -> Column:
    """A missing prediction (or reference) counts as an empty text."""
    return F.levenshtein(F.coalesce(pred, F.lit("")), F.coalesce(exp, F.lit("")))


def char_count(exp: Column) -> Column:
    return F.coalesce(F.length(exp), F.lit(0))


def _with_edits(df: DataFrame, n_pred: Column, n_exp: Column, tokens: Sequence[Column], short: Callable[[DataFrame], DataFrame],
                out: str, block: int) -> DataFrame:
    """``df`` with the distance ``out``: ``short`` adds it to pairs of at most ``block``
    tokens a side; longer ones, if there are any, go by blocks."""
    sized = df.withColumn("_most", F.greatest(n_pred, n_exp))
    if (sized.agg(F.max("_most")).first()[0] or 0) <= block:
        return short(df)
    rows = pin(sized.withColumn("_rid", F.monotonically_increasing_id()))
    long = rows.where(F.col("_most") > block)
    found = long_edits(long.select("_rid", tokens[0].alias("_p"), tokens[1].alias("_e")), "_p", "_e", min(block, BLOCK))
    near = short(rows.where(F.col("_most") <= block).select(*df.columns))
    far = long.join(found, "_rid").select(*df.columns, F.col("edits").cast("int").alias(out))
    return near.unionByName(far.select(*near.columns))


def with_char_edits(df: DataFrame, pred: str, exp: str, out: str = "char_edits", block: int = CHAR_BLOCK) -> DataFrame:
    """Add the character edit distance of two text columns."""
    return _with_edits(df, char_count(F.col(pred)), char_count(F.col(exp)), [chars(F.col(pred)), chars(F.col(exp))],
                       lambda d: d.withColumn(out, char_edits(F.col(pred), F.col(exp))), out, block)


def with_word_edits(df: DataFrame, pred: str, exp: str, out: str = "word_edits",
                    ref_len: str | None = None, block: int = WORD_BLOCK) -> DataFrame:
    """Add the word-level edit distance of two text columns (and the reference's
    word count), exact for pairs of any length.
    """
    keep = df.columns

    def short(rows: DataFrame) -> DataFrame:
        w = rows.select(*keep, words(F.col(pred)).alias("_h"), words(F.col(exp)).alias("_r"))
        return w.select(*keep, _bit_edits("_h", "_r").alias(out))

    both = [words(F.col(pred)), words(F.col(exp))]
    edits = _with_edits(df, F.size(both[0]), F.size(both[1]), both, short, out, block)
    return edits.withColumn(ref_len, F.size(words(F.col(exp)))) if ref_len else edits


def _rate(df: DataFrame, edits: Column, total: Column, by: Sequence[str], name: str) -> DataFrame:
    out = df.groupBy(*by).agg(F.sum(edits).cast("long").alias("edits"),
                              F.sum(total).cast("long").alias("total"))
    return out.withColumn(name, F.col("edits") / F.nullif(F.col("total"), F.lit(0)))


def char_error_rate(ev: DataFrame, pred: str = "predicted", exp: str = "expected",
                    by: Sequence[str] = ()) -> DataFrame:
    """CER = sum of character edits / sum of expected characters."""
    scored = with_char_edits(ev.select(*by, pred, exp), pred, exp, "_edits")
    return _rate(scored, F.col("_edits"), char_count(F.col(exp)), by, "cer")


def word_error_rate(ev: DataFrame, pred: str = "predicted", exp: str = "expected",
                    by: Sequence[str] = ()) -> DataFrame:
    """WER = sum of word edits / sum of expected words."""
    scored = with_word_edits(ev.select(*by, pred, exp), pred, exp, "_edits", "_ref_len")
    return _rate(scored, F.col("_edits"), F.col("_ref_len"), by, "wer")


def _ngrams(tokens: Column, n: int) -> Column:
    grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1),
                        lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def _tagged(tokens: Column, n: int, side: int) -> Column:
    def tag(g):
        return F.struct(F.lit(side).alias("side"), F.lit(n).alias("n"), g.alias("gram"))
    return F.transform(_ngrams(tokens, n), tag)


def bleu_ngrams(ev: DataFrame, pred: str = "predicted", exp: str = "expected",
                max_n: int = 4, by: Sequence[str] = ()) -> DataFrame:
    """Clipped n-gram matches and candidate counts per ``n`` (and ``by``).

    Every row gets a generated id (its own may be NULL or repeated) and is
    hash-partitioned on it once; the per-(row, n, gram) count is then a local
    aggregate, counting hypothesis and reference occurrences in one pass, so no
    join is needed to clip.
    """
    key = "_rid"
    parted = by_key(ev.withColumn(key, F.monotonically_increasing_id()), key).select(key, *by, words(F.col(pred)).alias("_h"),
                                        words(F.col(exp)).alias("_r"))
    h, r = F.col("_h"), F.col("_r")  # column references: the n-gram lambdas capture them
    tagged = F.concat(*[_tagged(toks, n, side)
                        for n in range(1, max_n + 1) for side, toks in ((0, h), (1, r))])
    grams = parted.select(key, *by, F.inline(tagged))
    per_gram = grams.groupBy(key, *by, "n", "gram").agg(
        F.sum((F.col("side") == 0).cast("long")).alias("hc"),
        F.sum((F.col("side") == 1).cast("long")).alias("rc"))
    return per_gram.groupBy(*by, "n").agg(
        F.sum(F.least("hc", "rc")).cast("long").alias("matches"),
        F.sum("hc").cast("long").alias("candidates"))


def bleu(ev: DataFrame, pred: str = "predicted", exp: str = "expected", max_n: int = 4,
         by: Sequence[str] = ()) -> DataFrame:
    """Corpus BLEU with uniform weights, no smoothing (0 when any n has no
    match) and brevity penalty ``1`` if ``c > r`` else ``exp(1 - r / c)``.

    The n-gram statistics and the corpus lengths are stacked into one table and
    reduced by a single aggregate, so the final step needs no join.
    """
    by = list(by)
    stats = bleu_ngrams(ev, pred, exp, max_n, by).select(
        *by, F.col("n").cast("int").alias("n"), "matches", "candidates",
        F.lit(0).cast("long").alias("hyp_len"), F.lit(0).cast("long").alias("ref_len"))
    lens = ev.select(
        *by, F.lit(None).cast("int").alias("n"), F.lit(0).cast("long").alias("matches"),
        F.lit(0).cast("long").alias("candidates"),
        F.size(words(F.col(pred))).cast("long").alias("hyp_len"),
        F.size(words(F.col(exp))).cast("long").alias("ref_len"))
    is_n = F.col("n").isNotNull()
    log_p = F.log(F.col("matches") / F.nullif(F.col("candidates"), F.lit(0))) / max_n
    wide = stats.unionByName(lens).groupBy(*by).agg(
        F.min(F.when(is_n, F.col("matches"))).alias("_min_match"),
        F.sum(F.when(is_n, log_p)).alias("_log_p"),
        F.count(F.when(is_n, F.lit(1))).alias("_orders"),
        F.sum("hyp_len").cast("long").alias("hyp_len"),
        F.sum("ref_len").cast("long").alias("ref_len"))
    bp = F.when(F.col("hyp_len") > F.col("ref_len"), F.lit(1.0)).otherwise(
        F.exp(1 - F.col("ref_len") / F.nullif(F.col("hyp_len"), F.lit(0))))
    score = F.when(F.col("_orders") < max_n, F.lit(0.0)).when(
        F.col("_min_match") == 0, F.lit(0.0)).otherwise(bp * F.exp(F.col("_log_p")))
    return wide.select(*by, F.coalesce(score, F.lit(0.0)).alias("bleu"), "hyp_len", "ref_len")
