"""Subtree sums over a forest by centroid decomposition.

Every node brings ``sub``, the weight of its subtree under positive node weights.
The centroid of a component is its deepest node whose subtree holds over half of
the component's weight; without it, each part that is left holds at most half. So
after a number of rounds that grows with the logarithm of the weight no component
is left, however deep or wide the forest is. In a round the components split: the
sums of a centroid's own value and of the components right below it are the
centroid's share, which is added to the nodes on the path from it to the top of
its component. All shares a node has got, its own included, are its subtree sum.

Components of more than ``block`` nodes are split by DataFrame rounds; a smaller
component is solved inside one task, several of them at once.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallex.llm.common import stored
from parallex.session import broadcast_checked

BLOCK = 1 << 16


def _tops(parent: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """The top of every living node's component, by pointer jumping."""
    me = np.arange(len(parent))
    jump = np.where(alive & (parent >= 0) & alive[parent], parent, me)
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump
        jump = further


def subtree_sums(parent: np.ndarray, sub: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the columns of ``values`` over the subtree of every node. ``parent`` is
    an index, less than the node's own, or -1."""
    sub, sums = sub.copy(), np.zeros_like(values)
    alive = np.ones(len(parent), bool)
    top = _tops(parent, alive)
    while alive.any():
        heavy = np.flatnonzero(alive & (2 * sub > sub[top]))
        centroid = np.full(len(parent), -1)
        np.maximum.at(centroid, top[heavy], heavy)  # they lie on one path; the deepest comes last
        c = centroid[centroid >= 0]
        alive[c] = False
        top = _tops(parent, alive)
        rest = np.flatnonzero(alive)
        totals = np.zeros_like(values)
        np.add.at(totals, top[rest], values[rest])
        below = rest[top[rest] == rest]
        below = below[parent[below] >= 0]
        below = below[np.isin(parent[below], c)]
        share = np.zeros_like(values)
        share[c] = values[c]
        np.add.at(share, parent[below], totals[below])
        sums[c] += share[c]
        # components have one centroid each, so no two paths meet
        add, weight, at = share[c], sub[c], parent[c]
        while True:
            on = (at >= 0) & alive[at]
            add, weight, at = add[on], weight[on], at[on]
            if not len(at):
                break
            sums[at] += add
            sub[at] -= weight
            at = parent[at]
    return sums


def _solve(columns: list[str]):
    def run(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("depth")
        ids = nodes["id"].to_pylist()
        index = {(c, i): k for k, (c, i) in enumerate(zip(nodes["comp"].to_pylist(), ids, strict=True))}
        parent = np.array([index.get(k, -1) for k in zip(nodes["comp"].to_pylist(), nodes["parent"].to_pylist(), strict=True)], np.int64)
        values = np.stack([nodes[c].to_numpy() for c in columns], axis=1)
        sums = subtree_sums(parent, nodes["sub"].to_numpy(), values)
        return pa.table({"id": nodes["id"]} | {c: pa.array(sums[:, i] + nodes[f"acc_{c}"].to_numpy())
                                               for i, c in enumerate(columns)})
    return run


def rollup(nodes: DataFrame, paths: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """``(id, *columns)``: the sums of ``columns`` over every node's subtree.

    ``nodes`` is a stored tree: ``id``, ``parent`` (NULL at the top), ``depth``,
    ``way``, ``sub`` and the columns. ``paths`` gives ``(way, depth, id, parent)``: the
    nodes on the way named ``way`` from the top down, which holds the node itself and
    its ancestors.
    """
    acc = [f"acc_{c}" for c in columns]
    root = bytes(nodes.where("parent IS NULL").first()["id"])
    live = nodes.select("id", "parent", "depth", "way", "sub", *columns, *[F.lit(0).cast("long").alias(a) for a in acc],
                        F.lit(root).alias("comp"))
    small, done = [], []
    while True:
        comps = stored(live.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.max("sub").alias("whole"), F.min("depth").alias("start")))
        big = comps.where(F.col("n") > block).drop("n")
        n_big = big.count()  # at most one for every ``block`` nodes
        if not n_big:
            small.append(live)
            break
        big = broadcast_checked(big, known_rows=n_big)
        small.append(live.join(big, "comp", "left_anti"))
        live = stored(live.join(big, "comp"))
        cent = broadcast_checked(stored(live.where("2 * sub > whole").groupBy("comp").agg(
            F.max_by(F.struct("id", "way", "depth", "sub"), "depth").alias("c"), F.first("start").alias("start"))), known_rows=n_big)
        # below the centroid, a node belongs to the child of it that its way passes
        child = paths.select(F.col("way"), F.col("depth").alias("next"), F.col("id").alias("child"), F.col("parent").alias("over"))
        sides = live.join(cent.drop("start"), "comp").withColumn("next", F.col("c.depth") + 1)
        sides = stored(sides.join(child, ["way", "next"], "left").withColumn(
            "under", F.coalesce((F.col("depth") > F.col("c.depth")) & (F.col("over") == F.col("c.id")), F.lit(False)))
            .withColumn("cut", F.col("id") == F.col("c.id")))
        shares = stored(sides.where("under OR cut").groupBy("comp").agg(*[F.sum(c).alias(f"share_{c}") for c in columns]))
        shares = broadcast_checked(shares, known_rows=n_big)
        done.append(sides.where("cut").join(shares, "comp").select(
            "id", *[(F.col(f"acc_{c}") + F.col(f"share_{c}")).alias(c) for c in columns]))
        above = paths.select(F.col("way"), F.col("depth").alias("at"), "id").join(
            cent.select("comp", F.col("c.way").alias("way"), F.col("c.depth").alias("end"), F.col("c.sub").alias("less"), "start"), "way").where(
            "at >= start AND at < end").join(shares, "comp").select("comp", "id", "less", *[f"share_{c}" for c in columns])
        live = stored(sides.where("NOT cut").join(above, ["comp", "id"], "left").select(
            "id", "parent", "depth", "way", (F.col("sub") - F.coalesce("less", F.lit(0))).alias("sub"), *columns,
            *[(F.col(f"acc_{c}") + F.coalesce(f"share_{c}", F.lit(0))).alias(f"acc_{c}") for c in columns],
            F.when(F.col("under"), F.col("child")).otherwise(F.col("comp")).alias("comp")))
    rest = stored(reduce(DataFrame.unionByName, [x.select("id", "parent", "depth", "sub", "comp", *columns, *acc) for x in small]))
    bins = max(1, rest.count() // block * 4, rest.sparkSession.sparkContext.defaultParallelism)
    solved = rest.withColumn("bin", F.pmod(F.xxhash64("comp"), F.lit(bins))).groupBy("bin").applyInArrow(
        _solve(columns), ", ".join(["id binary", *[f"{c} long" for c in columns]]))
    return reduce(DataFrame.unionByName, [solved, *done])
