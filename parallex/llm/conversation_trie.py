"""Prefix trie of conversations with subtree totals by centroid decomposition.

A node is a distinct sequence of first turns. Its name is a 128-bit sum over its
turns: each turn, hashed with its place, gives four 32-bit numbers (of an MD5),
which are added up. So the names of all prefixes of a conversation are running
sums, cut into chunks of CHUNK turns: no task holds a conversation whole, however
many turns it has, and turn texts travel only once, for the order of the turns.
Nodes, members and the weight of every subtree (the rows of member conversations
at or below a node) are plain aggregates with partial sums, so a prefix shared by
any share of the conversations meets nowhere in one task. The totals over
subtrees go by ``centroids.rollup``.

The members that end at a node are listed in ascending order by range partitions;
each task writes joined pieces of the list, and the digest of a node's list is
taken over its pieces as a stream.

Turns are ordered by turn (NULL first), ties by role and text; repeated rows are
turns of their own. NULL role or text is empty. Rows without a conv_id belong to
no conversation. Only the four columns are read, so other columns cannot clash.
An empty table has the root alone, with no members and a NULL conv_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parallex.llm.centroids import BLOCK, rollup
from parallex.llm.common import WORD, stored
from parallex.operators.ranking import exact_rank

CHUNK = 1024
HEADS = 4     # a conversation takes 0 to HEADS - 1 turns of another
EVERY = 20    # of the one at the last multiple of EVERY
LANES = 4
ROOT = bytes(16)
NO_ENDS = sha256(b"").hexdigest()
PIECE = 1 << 16  # bytes of a listed piece


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, n, digest, words)``: every turn with its place from 1 among
    the ``n`` of its conversation."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    # the row number only parts equal turns, which may be many
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    ranked = exact_rank(rows, order, ["conv_id"], "place", total_col="n")
    return stored(ranked.select(
        "conv_id", "place", "n", F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")))


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: ``(conv_id, depth, digest, words, length)`` and
    ``(conv_id, length)`` for every conversation, those without turns too."""
    convs = own.groupBy("conv_id").agg(F.first("n").alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % EVERY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"))
    size = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = stored(convs.join(size, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))).withColumn(
        "length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    heads = own.where(F.col("place") < HEADS).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "words")
    first = convs.where("h > 0").select("conv_id", "base", "h", "length").join(heads, "base").where("depth <= h")
    rest = own.drop("n").join(convs.select("conv_id", "h", "taken", "length"), "conv_id").where("place > h").withColumn(
        "depth", F.col("place") - F.col("h") + F.col("taken"))
    names = ["conv_id", "depth", "digest", "words", "length"]
    return first.select(*names).unionByName(rest.select(*names)), convs.select("conv_id", "length")


def _name(lanes: list[Column]) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0") for x in lanes]))


def prefixes(rows: DataFrame, convs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(way, depth, id, parent, words, length)``: every prefix of every rebuilt
    conversation, the empty one included."""
    mixed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), "digest"))
    items = rows.withColumn("m", mixed).select(
        "conv_id", "depth", "words", "length", F.expr(f"(depth - 1) div {chunk}").alias("chunk"),
        *[F.conv(F.substring("m", 8 * i + 1, 8), 16, 10).cast("long").alias(f"x{i}") for i in range(LANES)])
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = items.select("*", *[F.sum(f"x{i}").over(inside).alias(f"s{i}") for i in range(LANES)])
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier = items.where(F.col("length") > chunk).groupBy("conv_id", "chunk").agg(
        *[F.sum(f"x{i}").alias(f"x{i}") for i in range(LANES)]).select(
        "conv_id", "chunk", *[F.sum(f"x{i}").over(before).alias(f"b{i}") for i in range(LANES)]).where("chunk > 0")
    sums = sums.join(earlier, ["conv_id", "chunk"], "left")
    here = [F.col(f"s{i}") + F.coalesce(f"b{i}", F.lit(0)) for i in range(LANES)]
    named = sums.select(F.col("conv_id").alias("way"), "depth", _name(here).alias("id"),
                        _name([s - F.col(f"x{i}") for i, s in enumerate(here)]).alias("parent"), "words", "length")
    top = convs.select(F.col("conv_id").alias("way"), F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("id"),
                       F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("words"), "length")
    return stored(named.unionByName(top))


def ends(paths: DataFrame) -> DataFrame:
    """``(id, ends_sha256)`` of the conversations that end at a node, ascending."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string()))],
                                              names=["id", "first", "members"])
        node, first, members, size, out = None, None, [], 0, []
        for rows in batches:
            for key, conv in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                if key != node or size > PIECE:
                    if members:
                        out.append((node, first, ",".join(members)))
                    node, first, members, size = key, conv, [], 0
                members.append(str(conv))
                size += len(members[-1]) + 1
            if len(out) > 1000:
                yield batch(out)
                out = []
        if members:
            out.append((node, first, ",".join(members)))
        yield batch(out)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for rows in batches:
            out = []
            for key, members in zip(rows.column(0).to_pylist(), rows.column(2).to_pylist(), strict=True):
                if key == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = key, sha256()
                state.update(members.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())],
                                             names=["id", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["id", "ends_sha256"])

    last = paths.where("depth = length").select("id", F.col("way").alias("conv_id"))
    listed = stored(last.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(
        pieces, "id binary, first long, members string"))
    return listed.repartition("id").sortWithinPartitions("id", "first").mapInArrow(digests, "id binary, ends_sha256 string")


def trie(conversations: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """The nodes: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)``."""
    spark = conversations.sparkSession
    rows, convs = rebuilt(turns(conversations))
    paths = prefixes(rows, convs, chunk)
    nodes = paths.groupBy("id", "parent", "depth", "words").agg(
        F.min("way").alias("way"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") - F.col("depth") + 1).alias("sub"))
    if not convs.take(1):
        nodes = spark.createDataFrame([(ROOT, None, 0, 0, None, 0, 1)], nodes.schema)
    children = nodes.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
                   .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
                   .withColumn("saved_tokens", F.greatest(F.col("n_convs") - 1, F.lit(0)) * F.col("words")))
    totals = rollup(nodes, paths, ["n_leaves", "saved_tokens"], block)
    above = nodes.select(F.col("id").alias("parent"), F.col("way").alias("parent_conv_id"))
    return nodes.drop("n_leaves", "saved_tokens").join(totals, "id").join(ends(paths), "id", "left").join(above, "parent", "left").select(
        F.col("way").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = r"""
WITH bits AS (
  SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS t(i))),
own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
      FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base,
      xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, b: xor(a >> 8, tab[xor(a, b) % 256 + 1])), 4294967295) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM own), bits),
turns AS (
  SELECT c.conv_id, o.place AS turn, 0 AS part, role, text FROM convs c JOIN own o ON o.conv_id = c.base WHERE o.place <= h
  UNION ALL
  SELECT c.conv_id, o.place, 1, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id WHERE o.place > h),
seq AS (SELECT conv_id, text, md5(md5(role) || text) AS m, row_number() OVER (PARTITION BY conv_id ORDER BY part, turn) AS depth FROM turns),
keyed AS (SELECT conv_id, depth, text, string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY depth) AS k FROM seq),
paths AS (SELECT conv_id, depth, k AS id, substr(k, 1, 32 * (depth - 1)) AS parent,
                 len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM keyed
          UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM convs),
sizes AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
nodes AS (SELECT id, parent, depth, min(conv_id) AS way, count(*) AS n_convs, any_value(words) AS words,
      string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length) AS members
      FROM paths JOIN sizes USING (conv_id) GROUP BY ALL),
kids AS (SELECT parent AS id, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
own_values AS (SELECT n.*, coalesce(k.n, 0) AS n_children, (n_convs - 1) * words AS saved FROM nodes n LEFT JOIN kids k USING (id)),
totals AS (SELECT p.id, count(*) FILTER (u.n_children = 0) AS n_leaves, sum(u.saved) AS saved_tokens
      FROM own_values u JOIN paths p ON p.conv_id = u.way AND p.depth <= u.depth GROUP BY p.id)
SELECT o.way AS conv_id, o.depth, a.way AS parent_conv_id, o.n_convs, o.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(o.members, '')) AS ends_sha256
FROM own_values o JOIN totals USING (id) LEFT JOIN nodes a ON a.id = o.parent
"""
