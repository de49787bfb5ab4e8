"""Edit distance of very long sequences, cut into blocks (H1, H2).

The table of the dynamic program is cut into squares of ``BLOCK`` by ``BLOCK``. A
block needs the last row of the block above and the last column of the block to
its left, and nothing else; so all blocks of a diagonal, of all pairs, are
independent tasks, and only their borders travel to the next diagonal. A pair of
``n`` and ``m`` tokens takes ``n/BLOCK + m/BLOCK`` rounds, uses up to
``min(n, m)/BLOCK`` tasks at once, and no task ever holds more than two blocks of
tokens and four borders.

Tokens of such pairs are compared by a 64-bit hash; ``bit_edits``, for pairs that one
task takes whole, compares the tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallex.session import pin, work_partitions

BLOCK = 4096


def bit_edits(a: list, b: list) -> int:
    """Edit distance of two token lists. A column of the dynamic program is held as
    two bit vectors, where it rises and where it falls (Myers 1999, Hyyrö 2003): a
    token of ``b`` takes a few operations on integers of ``len(a)`` bits."""
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < hi_a and lo < hi_b and a[lo] == b[lo]:
        lo += 1
    while lo < hi_a and lo < hi_b and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
    a, b = a[lo:hi_a], b[lo:hi_b]
    if not a or not b:
        return len(a) + len(b)
    both, at = set(b), {}
    for i, x in enumerate(a):
        if x in both:
            at[x] = at.get(x, 0) | 1 << i
    every, last, found = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    rises, falls = every, 0
    for x in b:
        same = at.get(x, 0)
        level = (((same & rises) + rises) ^ rises) | same
        up, down = falls | ~(level | rises) & every, rises & level
        found += 1 if up & last else -1 if down & last else 0
        up, down, held = up << 1 | 1, down << 1, same | falls
        rises, falls = (down | ~(held | up)) & every, up & held & every
    return found


def block_borders(a: np.ndarray, b: np.ndarray, top: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last row and the last column of a block from its first ones (both with
    the corner)."""
    step, row, right = np.arange(len(b) + 1), top.astype(np.int64), np.empty(len(a) + 1, np.int64)
    right[0] = row[-1]
    for i, x in enumerate(a):
        new = np.empty_like(row)
        new[0] = left[i + 1]
        np.minimum(row[1:] + 1, row[:-1] + (b != x), out=new[1:])
        # an insertion costs one a place: the least value to the left, one more for each place
        row = np.minimum.accumulate(new - step) + step
        right[i + 1] = row[-1]
    return row, right


def _blocks(rows: DataFrame, tokens: str, index: str, block: int) -> DataFrame:
    arr = F.col(tokens)
    cut = F.transform(F.sequence(F.lit(0), F.expr(f"(size({tokens}) - 1) div {block}")), lambda i: F.slice(arr, i * block + 1, block))
    return rows.select("_rid", "_na", "_nb", F.posexplode(cut).alias(index, tokens))


def long_edits(pairs: DataFrame, a: str, b: str, block: int = BLOCK) -> DataFrame:
    """``(_rid, edits)`` for pairs ``(_rid, a, b)`` of token arrays; ``_rid`` names a row."""
    n_parts = work_partitions(pairs.sparkSession)

    def hashed(c: str) -> Column:
        return F.transform(c, lambda t: F.xxhash64(t))
    rows = pin(pairs.select("_rid", hashed(a).alias("_a"), hashed(b).alias("_b")).select(
        "*", F.expr(f"(size(_a) + {block - 1}) div {block}").alias("_na"), F.expr(f"(size(_b) + {block - 1}) div {block}").alias("_nb")))
    empty = (F.size("_a") == 0) | (F.size("_b") == 0)
    done = [rows.where(empty).select("_rid", F.greatest(F.size("_a"), F.size("_b")).cast("long").alias("edits"))]
    rows = rows.where(~empty)
    diagonals = rows.agg(F.max(F.col("_na") + F.col("_nb"))).first()[0] or 0
    left_blocks, right_blocks = pin(_blocks(rows, "_a", "_i", block)), pin(_blocks(rows.select("_rid", "_na", "_nb", "_b"), "_b", "_j", block))
    borders = None
    schema = "_rid long, _na long, _nb long, _i int, _j int, _side int, _line array<long>"

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                x, y, i, j = np.array(r["_a"], np.int64), np.array(r["_b"], np.int64), r["_i"], r["_j"]
                top = np.arange(len(y) + 1) + j * block if r["_top"] is None else np.array(r["_top"], np.int64)
                left = np.arange(len(x) + 1) + i * block if r["_left"] is None else np.array(r["_left"], np.int64)
                below, right = block_borders(x, y, top, left)
                head = (r["_rid"], r["_na"], r["_nb"])
                out += [(*head, i + 1, j, 0, below), (*head, i, j + 1, 1, right)]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)],
                                             names=["_rid", "_na", "_nb", "_i", "_j", "_side", "_line"])

    for d in range(max(diagonals - 1, 0)):
        cells = left_blocks.withColumn("_j", F.lit(d) - F.col("_i")).join(right_blocks.drop("_na", "_nb"), ["_rid", "_j"])
        for side, name in ((0, "_top"), (1, "_left")):
            if borders is None:
                cells = cells.withColumn(name, F.lit(None).cast("array<long>"))
            else:
                line = borders.where(F.col("_side") == side).select("_rid", "_i", "_j", F.col("_line").alias(name))
                cells = cells.join(line, ["_rid", "_i", "_j"], "left")
        # one block is a fair task: deal them out singly
        cells = cells.select("_rid", "_na", "_nb", "_i", "_j", "_a", "_b", "_top", "_left").repartition(n_parts, "_rid", "_i")
        borders = pin(cells.mapInArrow(solve, schema))
        last = (F.col("_side") == 0) & (F.col("_i") == F.col("_na")) & (F.col("_j") == F.col("_nb") - 1)
        done.append(borders.where(last).select("_rid", F.element_at("_line", -1).alias("edits")))
    return reduce(DataFrame.unionByName, done)
