"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The rows are frozen with a row id that names their input partition. One row per
input partition (its count) goes to the driver, which draws how many rows of
each partition go to each shard: the partitions split the shards' capacities by
successive hypergeometric draws, which is the law of these counts under a
uniform permutation of all rows. Every partition then permutes its rows and
deals its first ``c_0`` to shard 0, the next ``c_1`` to shard 1 and so on; the
rows are exchanged; every shard permutes what it received. Shard sizes differ by
at most one row (law ``rows``).

Neither permutation needs a whole shard in one task: a shard is cut into buckets
by the leading part of its rows' random keys, numbered by bucket offsets.

NULL texts have size 1 and the CRC of no bytes. Rows may repeat and doc_ids may
be NULL: every row is a row. An empty table gives empty shards. Columns of the
input named like the added ones are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parallex.llm.common import at, documents, numbered, stored, without
from parallex.session import pin

SHARDS = 16
SEED = 20
BUCKET_ROWS = 1 << 16  # rows of a shard that one task permutes
_LOCAL_BITS = 33       # monotonically_increasing_id: partition above, row below


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn without return from ``good + bad`` are good.

    By inversion over mode +- 12 standard deviations (less than 1e-30 lies
    beyond); ratios of neighbouring probabilities keep it exact to rounding at
    any population size.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    sd = (n * (good / total) * (bad / total) * ((total - n) / max(total - 1, 1))) ** 0.5
    width = int(12 * sd) + 30
    first, last = max(low, mode - width), min(high, mode + width)
    k = np.arange(first, last, dtype=np.float64)
    logs = np.cumsum(np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1))
    weight = np.exp(np.concatenate([[0.0], logs]) - max(0.0, logs.max()))
    return first + int(np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), side="right").clip(0, last - first))


def matrix(sizes: list[int], capacities: list[int], seed: int) -> list[list[int]]:
    """Rows of the communication matrix: how many rows of each partition go to each shard."""
    rng, left, out = np.random.default_rng(seed), list(capacities), []
    for n in sizes:
        row, rest = [], sum(left)
        for s, c in enumerate(left):
            k = hypergeometric(rng, c, rest - c, n)
            row.append(k)
            rest -= c
            n -= k
            left[s] -= k
        out.append(row)
    return out


def assign(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(_rid, shard, slot)`` for rows with a frozen ``_rid`` from
    ``monotonically_increasing_id``."""
    spark = rows.sparkSession
    part = rows.select("_rid", F.shiftright("_rid", _LOCAL_BITS).alias("_p"))
    sizes = [(r["_p"], r["n"]) for r in part.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).orderBy("_p").collect()]
    total = sum(n for _, n in sizes)
    drawn = matrix([n for _, n in sizes], [total // shards + (s < total % shards) for s in range(shards)], seed)
    table = spark.createDataFrame(
        [(p, np.cumsum(row).tolist()) for (p, _), row in zip(sizes, drawn, strict=True)], "_p long, _upto array<long>")
    local = part.withColumn("_r", F.row_number().over(
        Window.partitionBy("_p").orderBy(F.xxhash64("_rid", F.lit(seed)), "_rid")))
    # past the bounds of the shards before it
    dealt = local.join(table, "_p").select(
        "_rid", F.size(F.filter("_upto", lambda b: b < F.col("_r"))).alias("shard"),
        F.xxhash64("_rid", F.lit(seed + 1)).alias("_h"))
    # the top 32 bits of the key, scaled: buckets follow the order of the key
    n = max(1, -(-total // (shards * bucket_rows)))
    bucket = F.shiftright(F.shiftrightunsigned("_h", 32) * F.lit(n).cast("long"), 32)
    dealt = pin(dealt.withColumn("_b", bucket))
    starts = dealt.groupBy("shard", "_b").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_start", F.sum("_n").over(Window.partitionBy("shard").orderBy("_b")) - F.col("_n"))
    numbered = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("shard", "_b").orderBy("_h", "_rid")))
    return numbered.join(starts, ["shard", "_b"]).select(
        "_rid", "shard", (F.col("_start") + F.col("_r") - 1).cast("long").alias("slot"))


def shuffle(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` plus ``shard`` and ``slot`` (position in the shard, from 0)."""
    kept = without(rows, ["shard", "slot"])
    frozen = stored(numbered(rows).select(*[at(rows, c) for c in kept], F.monotonically_increasing_id().alias("_rid")))
    out = frozen.join(assign(frozen, shards, seed, bucket_rows), "_rid")
    return out.select(*[F.col(at(rows, c)).alias(c) for c in kept], "shard", "slot")


def _digest(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("size", (F.octet_length(text) + 1).cast("long")).withColumn(
        "text_crc32", F.crc32(text)).withColumn("law", F.lit("rows"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    light = _digest(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    return shuffle(light).withColumn("grown_shard", F.lit(None).cast("int"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document with its shard and its slot in the shard."""
    return shuffle(_digest(docs)).withColumn("grown_shard", F.lit(None).cast("int"))
