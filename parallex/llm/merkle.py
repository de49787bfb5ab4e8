"""Merkle manifest of a dataset with checkpoint-and-recompute proofs.

Every row is a leaf: the SHA-256 of its identifying columns. The leaves of a group
(source) ascend by id; 16 neighbours at a time become one node until one is left,
the subroot of the group. The subroots, in the order of their groups, make the
root the same way.

Only every second level is written (levels 0, 2, 4 ... of every group), so what is
stored beside the leaves is less than a two-hundredth of them. Building a level
and extracting proofs both go by aligned subtrees of 256 stored nodes: a task gets
one of them, regenerates the level between, uses it and drops it. On the way down
it also gets the path of the subtree's top (the siblings from there up to the
root), and hands every node below a longer path; at the leaves the path is the
proof. So a task holds 256 digests and one path, however large a group is, and
positions within a group come from range partitions of all leaves, so a group may
hold any share of the rows. The driver only counts levels.

NULL values are part of a leaf as ``-``; a NULL source is a group of its own, the
first. Within a group NULL ids come first; rows with equal ids ascend by leaf, and
repeated rows are leaves of their own. A group of one row is its own subroot. Only
the identifying columns are read, so other columns cannot clash. An empty table
has no leaves and no root, and gives no rows.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.llm.common import documents, stored
from parallex.operators.ranking import exact_rank

FAN = 16
KEPT = 2  # a stored level is this many levels above the one before
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "grp string, pos long, n long, h binary"
_PATH = f"{_NODE}, left array<binary>, right array<binary>, subroot binary, root binary"


def leaf(columns: list[Column]) -> Column:
    """Digest of the values: ``-`` for NULL, else byte count, ``:`` and the value."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def _above(nodes: list[bytes]) -> list[bytes]:
    """The level above: the hash of every run's digests as hexadecimal text."""
    return [sha256(b"".join(nodes[i:i + FAN]).hex().encode()).digest() for i in range(0, len(nodes), FAN)]


def _levels(nodes: list[bytes], n: int) -> list[list[bytes]]:
    """An aligned subtree over ``nodes``, of a level that has ``n`` nodes in all: up
    to KEPT levels more, or up to the one that has a single node."""
    out = [nodes]
    for _ in range(KEPT):
        if n == 1:
            break
        out.append(_above(out[-1]))
        n = -(-n // FAN)
    return out


def _in_order(nodes: pa.Table) -> pa.Table:
    return nodes.sort_by("pos")


def _roll(nodes: pa.Table) -> pa.Table:
    nodes = _in_order(nodes)
    n = nodes["n"][0].as_py()
    levels = _levels(nodes["h"].to_pylist(), n)
    up = len(levels) - 1
    return pa.table({"grp": nodes["grp"].slice(0, 1), "pos": [nodes["pos"][0].as_py() // FAN ** KEPT],
                     "n": [-(-n // FAN ** up)], "h": levels[-1]},
                    pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("h", pa.binary())]))


def _block(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FAN ** KEPT}"))


def build(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The stored levels of all groups: ``(grp, pos, n, h)`` with ``n`` the number of
    nodes the group has there; ``most`` is the largest group. A group's last
    entry (``n`` = 1) is its top, whatever its height."""
    levels = [leaves.select("grp", "pos", "n", "h")]
    while most > 1:
        rows = _block(levels[-1].where("n > 1"))
        levels.append(stored(rows.groupBy("grp", "block").applyInArrow(_roll, _NODE)))
        most = -(-most // FAN ** KEPT)
    return levels


def _siblings(nodes: pa.Table) -> list[tuple[list[bytes], list[bytes]]]:
    """For every node of an aligned subtree: what stands left and right of it in its
    run, and so on for its ancestors below the subtree's top."""
    levels = _levels(nodes["h"].to_pylist(), nodes["n"][0].as_py())
    out = []
    for i in range(nodes.num_rows):
        left, right = [], []
        for level in levels[:-1]:
            first = i - i % FAN
            left.append(b"".join(level[first:i]))
            right.append(b"".join(level[i + 1:first + FAN]))
            i //= FAN
        out.append((left, right))
    return out


def _descend(nodes: pa.Table, top: pa.Table) -> pa.Table:
    nodes = _in_order(nodes)
    left, right = top["left"][0].as_py(), top["right"][0].as_py()
    paths = _siblings(nodes)
    k = nodes.num_rows
    return pa.table({**{c: nodes[c] for c in ("grp", "pos", "n", "h")},
                     "left": pa.array([a + left for a, _ in paths], pa.list_(pa.binary())),
                     "right": pa.array([b + right for _, b in paths], pa.list_(pa.binary())),
                     "subroot": pa.array(top["subroot"].to_pylist() * k, pa.binary()),
                     "root": pa.array(top["root"].to_pylist() * k, pa.binary())})


def _prove(nodes: pa.Table, top: pa.Table) -> pa.Table:
    """Proofs of an aligned subtree of leaves, folded from the tampered leaf where there is one."""
    nodes = _in_order(nodes)
    left, right = top["left"][0].as_py(), top["right"][0].as_py()
    subroot, root = top["subroot"][0].as_py().hex(), top["root"][0].as_py()
    proofs, folded = [], []
    for (a, b), h, bad in zip(_siblings(nodes), nodes["h"].to_pylist(), nodes["tampered"].to_pylist(), strict=True):
        path = list(zip(a + left, b + right, strict=True))
        proofs.append(sha256(b"".join([x + y for x, y in path]).hex().encode()).hexdigest())
        node = h if bad is None else bad
        for x, y in path:
            node = sha256((x + node + y).hex().encode()).digest()
        folded.append(node)
    k = nodes.num_rows
    return pa.table({"doc_id": nodes["doc_id"], "leaf": [h.hex() for h in nodes["h"].to_pylist()],
                     "subroot": [subroot] * k, "root": [root.hex()] * k, "proof_sha256": proofs,
                     "folded_root": [f.hex() for f in folded], "verified": [f == root for f in folded]})


def paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The paths of the nodes one stored level above the leaves. ``tops`` has the
    paths of the groups' tops: ``(grp, left, right, subroot, root)``."""
    below = None
    for nodes in levels[:0:-1]:
        own = nodes.where("n = 1").join(tops, "grp").select(*_names())
        if below is not None:
            rows = _block(nodes.where("n > 1"))
            own = own.unionByName(rows.groupBy("grp", "block").cogroup(
                below.withColumn("block", F.col("pos")).groupBy("grp", "block")).applyInArrow(_descend, _PATH))
        below = stored(own)
    if below is None:  # no group has more than one leaf
        below = stored(levels[0].where("false").join(tops, "grp").select(*_names()))
    return below


def _names() -> list[str]:
    return ["grp", "pos", "n", "h", "left", "right", "subroot", "root"]


def _largest(leaves: DataFrame) -> int:
    return leaves.agg(F.max("n")).first()[0] or 0


def manifest(rows: DataFrame, group: Column, ident: str, h: Column, tampered: Column) -> DataFrame:
    """Leaves ``h`` of ``rows``, ``group`` by ``group``, ascending by the column
    ``ident``: ``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``.

    ``tampered`` replaces a row's leaf, where it is not NULL, when its proof is
    folded back to the root.
    """
    # NULL first, then the names bytewise
    key = F.coalesce(F.concat(F.lit("="), group), F.lit(""))
    light = stored(rows.select(key.alias("grp"), F.col(ident).alias("doc_id"), h.alias("h"), tampered.alias("tampered")))
    # the row number only parts equal rows, which may be many
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("row")]
    leaves = stored(exact_rank(light.withColumn("row", F.monotonically_increasing_id()), order, ["grp"], "pos", total_col="n")
                    .withColumn("pos", F.col("pos") - 1).drop("row"))
    levels = build(leaves, _largest(leaves))

    # the tree over the subroots: one group, placed by name
    subroots = reduce(DataFrame.unionByName, [x.where("n = 1").select("grp", "h") for x in levels])
    subroots = stored(exact_rank(stored(subroots), [F.col("grp")], (), "pos", total_col="n").withColumn("pos", F.col("pos") - 1))
    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "pos", "n", "h")
    above = build(named, _largest(named))
    none = F.array().cast("array<binary>")
    root = above[-1].where("n = 1").select(
        "grp", none.alias("left"), none.alias("right"), F.lit(None).cast("binary").alias("subroot"), F.col("h").alias("root"))
    top = paths(above, root)
    tree = _block(named.where("n > 1")).groupBy("grp", "block").cogroup(
        top.withColumn("block", F.col("pos")).groupBy("grp", "block")).applyInArrow(_descend, _PATH)
    alone = named.where("n = 1").join(root, "grp").select(*_names())
    tops = stored(tree.unionByName(alone).join(named.select("pos", "name"), "pos").select(
        F.col("name").alias("grp"), "left", "right", F.col("h").alias("subroot"), "root"))

    first = paths(levels, tops)
    single = leaves.where("n = 1").join(tops, "grp").select("grp", "pos", "n", "h", "left", "right", "subroot", "root")
    reached = first.withColumn("block", F.col("pos")).unionByName(single.withColumn("block", F.col("pos")))
    return _block(leaves).groupBy("grp", "block").cogroup(reached.groupBy("grp", "block")).applyInArrow(
        _prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(*COLUMNS)
    columns = {c: F.col(c) for c in COLUMNS}
    altered = columns | {"text": F.translate("text", ascii_uppercase, ascii_lowercase)}
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return manifest(docs, F.col("source"), "doc_id", leaf(list(columns.values())),
                    F.when(hit, leaf(list(altered.values()))))


ORACLE = r"""
WITH RECURSIVE bits AS (
  SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS t(i))),
d AS (SELECT doc_id, source, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
      xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, b: xor(a >> 8, tab[xor(a, b) % 256 + 1])), 4294967295) % 5 = 0 AS hit
      FROM documents, bits),
leaves AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS g,
      sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
      sha256(head || coalesce(strlen(text) || ':' || CASE WHEN hit THEN
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS t FROM d),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h, r) - 1 AS pos,
      count(*) OVER (PARTITION BY g) AS n FROM leaves),
nodes(g, lv, pos, n, h) AS (
  SELECT g, 0, pos, n, h FROM placed
  UNION ALL
  SELECT g, lv + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY g, lv, pos // 16),
tops AS (SELECT g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
above(lv, pos, n, h) AS (
  SELECT 0, pos, n, h FROM tops
  UNION ALL
  SELECT lv + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(h, '' ORDER BY pos))
  FROM above WHERE n > 1 GROUP BY lv, pos // 16),
steps AS (
  SELECT g, lv, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY g, lv, pos // 16 ORDER BY pos)),
higher AS (
  SELECT lv, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM above WHERE n > 1 WINDOW w AS (PARTITION BY lv, pos // 16 ORDER BY pos)),
path AS (
  SELECT p.r, s.lv, s.a, s.b FROM placed p JOIN steps s ON s.g = p.g AND s.pos = p.pos // (16 ** s.lv)::BIGINT
  UNION ALL
  SELECT p.r, 100 + s.lv, s.a, s.b FROM placed p JOIN tops t ON t.g = p.g JOIN higher s ON s.pos = t.pos // (16 ** s.lv)::BIGINT),
proof AS (SELECT r, list([a, b] ORDER BY lv) AS p, string_agg(a || b, '' ORDER BY lv) AS s FROM path GROUP BY r),
folded AS (SELECT l.*, t.h AS subroot, (SELECT h FROM above WHERE n = 1) AS root, coalesce(s, '') AS s,
      list_reduce(list_prepend([l.t, ''], coalesce(p, [])), lambda x, y: [sha256(y[1] || x[1] || y[2]), ''])[1] AS f
      FROM leaves l JOIN tops t USING (g) LEFT JOIN proof USING (r))
SELECT doc_id, h AS leaf, subroot, root, sha256(s) AS proof_sha256, f AS folded_root, f = root AS verified FROM folded
"""
