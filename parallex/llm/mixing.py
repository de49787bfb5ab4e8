"""Temperature mixing of sources under a repetition limit and a target entropy.

Source ``s`` with token share ``p_s`` gets the weight ``p_s ** a``, normalised.
``a = 1`` keeps the shares and ``a = 0`` makes them equal; the entropy of the
weights and the largest number of passes over a source both fall as ``a`` grows,
so the smallest ``a`` that meets the targets is bisected (32 intervals a round, one
aggregation over the table of sources). The target entropy may be given in bits or
as a place between that of the shares and the greatest one (equal weights), which
binds on any table whose sources differ in size. Unless a budget in tokens is given, it is the
one under which the largest source is read exactly once: no document is lost and
smaller sources repeat.

A source with budget ``B`` and ``T`` tokens is read in whole passes, ``B // T`` of
them, and one part pass of ``B % T`` tokens. Every pass permutes the source's
blocks and, within a block, its documents; the part pass takes documents while
the tokens before them are within the budget. Blocks are sized so that at most
about ``MAX_BLOCKS`` exist, so no window holds a whole source.

A text's tokens are its words plus one end token, so NULL and empty texts count
one. A NULL source is a source of its own. Repeated rows are separate documents.
An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parallex.llm.common import WORD, at, documents, named, numbered, stored, without
from parallex.session import broadcast_checked, pin

MAX_REPEATS = 2.0
ENTROPY_PLACE = 0.5  # 0: the entropy of the shares, 1: that of equal weights
BLOCK_TOKENS = 1 << 20
MAX_BLOCKS = 1 << 20
SEED = 50
_ROUNDS, _CUTS = 9, 32


def source_tokens(rows: DataFrame) -> DataFrame:
    """``(_s, tokens, share)`` of rows with a source key ``_s`` and ``_t`` tokens."""
    per = pin(rows.groupBy("_s").agg(F.sum("_t").alias("tokens")))
    total = per.agg(F.sum("tokens")).first()[0] or 0
    return per.withColumn("share", F.col("tokens") / F.lit(max(total, 1)))


def exponent(sources: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None,
             budget: int | None = None, entropy_place: float | None = None) -> float:
    """The smallest exponent in [0, 1] under which no source is read more than
    ``max_repeats`` times and the weights have at most ``target_entropy`` bits (or
    the entropy at ``entropy_place``); a target that is ``None`` is no limit. Without
    any exponent that meets them it is 1."""
    top = sources.agg(F.max("share"), F.sum("tokens"), -F.sum(F.col("share") * F.log2("share")), F.count(F.lit(1))).first()
    if top[0] is None:
        return 1.0
    if entropy_place is not None:
        target_entropy = top[2] + entropy_place * (math.log2(top[3]) - top[2])

    def meets(a: float, z: float, s: float, most: float) -> bool:
        if target_entropy is not None and (math.log(z) - s / z) / math.log(2) > target_entropy:
            return False
        # passes over a source: weight / share * budget / all tokens
        passes = most / (top[0] ** (a - 1)) if budget is None else most / z * budget / top[1]
        return max_repeats is None or passes <= max_repeats

    low, high = 0.0, 1.0
    for r in range(_ROUNDS):
        tries = [low + (high - low) * k / _CUTS for k in range(0 if r == 0 else 1, _CUTS)]
        a = F.col("a")
        got = (sources.withColumn("a", F.explode(F.array(*map(F.lit, tries)))).groupBy("a")
               .agg(F.sum(F.pow("share", a)).alias("z"), F.sum(F.pow("share", a) * a * F.log("share")).alias("s"),
                    F.max(F.pow("share", a - 1)).alias("most")).collect())
        ok = sorted(x["a"] for x in got if meets(x["a"], x["z"], x["s"], x["most"]))
        step = (high - low) / _CUTS
        if ok and ok[0] == 0.0:
            return 0.0
        high = ok[0] if ok else high
        low = max(low, high - step)
    return round(high, 9)


def budgets(sources: DataFrame, a: float, budget: int | None = None) -> DataFrame:
    """``(_s, tokens, weight, full, rest)``: whole passes and tokens of the part pass."""
    w = sources.withColumn("w", F.pow("share", F.lit(a)))
    z, top, largest, total = w.agg(F.sum("w"), F.max("w"), F.max("tokens"), F.sum("tokens")).first()
    weight = F.col("w") / F.lit(z or 1.0)
    # the largest source once: its budget is its tokens
    want = (F.lit(largest or 0) * F.col("w") / F.lit(top or 1.0)) if budget is None else weight * F.lit(budget)
    b = F.round(want).cast("long")
    return w.select("_s", "tokens", weight.alias("weight"), b.alias("b")).select(
        "_s", "tokens", "weight", F.floor(F.col("b") / F.col("tokens")).alias("full"), F.expr("b % tokens").alias("rest"))


def draw(rows: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None,
         budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED,
         entropy_place: float | None = None) -> DataFrame:
    """``(_rid, _s, weight, epoch, block_rank, position)``: one row for each time a
    document is read. ``rows`` has a frozen ``_rid``, a non-NULL ``_s`` and ``_t``."""
    sources = source_tokens(rows)
    plan = pin(budgets(sources, exponent(sources, max_repeats, target_entropy, budget, entropy_place), budget))
    total = plan.agg(F.sum("tokens")).first()[0] or 0
    per_block = max(block_tokens, total // MAX_BLOCKS)
    blocks_of = plan.select("_s", F.ceil(F.col("tokens") / F.lit(per_block)).alias("_n"))
    # a row per source: broadcast while that is small, else a shuffled join
    d = rows.join(broadcast_checked(blocks_of), "_s").select("_rid", "_s", "_t", F.expr(f"pmod(xxhash64(_rid, {seed}), _n)").alias("_b"))
    blocks = d.groupBy("_s", "_b").agg(F.sum("_t").alias("_bt")).join(broadcast_checked(plan), "_s").select(
        "*", F.explode(F.expr("sequence(0L, full)")).alias("epoch"))
    mixed = Window.partitionBy("_s", "epoch").orderBy(F.xxhash64("_s", "_b", "epoch", F.lit(seed + 1)), "_b")
    blocks = blocks.select(
        "_s", "_b", "weight", "full", "rest", "epoch", (F.row_number().over(mixed) - 1).cast("long").alias("block_rank"),
        (F.sum("_bt").over(mixed) - F.col("_bt")).alias("_start")).where("epoch < full or _start < rest")
    inner = Window.partitionBy("_s", "_b", "epoch").orderBy(F.xxhash64("_rid", "epoch", F.lit(seed + 2)), "_rid")
    read = d.join(blocks, ["_s", "_b"]).select(
        "_rid", "_s", "weight", F.col("epoch").cast("int").alias("epoch"), "full", "rest", "block_rank",
        (F.row_number().over(inner) - 1).cast("long").alias("position"),
        (F.col("_start") + F.sum("_t").over(inner) - F.col("_t")).alias("_at"))
    return read.where("epoch < full or _at < rest").drop("full", "rest", "_at")


def mix(docs: DataFrame, source: str = "source", text: str = "text", keep: list[str] | None = None, **how) -> DataFrame:
    """The documents of the mix: columns ``keep`` of ``docs`` (all by default) plus
    ``n_tokens``, ``weight`` (of the source), ``epoch`` (0 for the first pass),
    ``block_rank`` and ``position``. Columns with these names are replaced."""
    names = ["n_tokens", "weight", "epoch", "block_rank", "position"]
    kept = [c for c in without(docs, names) if keep is None or c in keep]
    rows, body, group = numbered(docs), F.col(at(docs, text)), F.col(at(docs, source)).cast("string")
    tokens = F.regexp_count(F.coalesce(body, F.lit("")), F.lit(WORD)).cast("long") + 1
    frozen = stored(rows.select(
        *[at(docs, c) for c in kept], tokens.alias("_t"), F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("_s"),
        F.monotonically_increasing_id().alias("_rid")))
    drawn = draw(frozen.select("_rid", "_s", "_t"), **how)
    return frozen.drop("_s").join(drawn.drop("_s"), "_rid").select(
        *[F.col(at(docs, c)).alias(c) for c in kept], F.col("_t").alias("n_tokens"), "weight", "epoch", "block_rank", "position")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir), keep=["doc_id", "source"], entropy_place=ENTROPY_PLACE).withColumn("weight", F.round("weight", 9))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents in the mix, repeated as often as they are read."""
    return named(mix(numbered(docs), at(docs, "source"), at(docs, "text"), entropy_place=ENTROPY_PLACE), docs)
