"""Substring dedup over words by prefix-partitioned suffix trees.

Every word covered by a window of 35 words that also starts anywhere else is
removed. ``repeats`` samples suffixes (one for each run of windows) and deals them,
with the words around that their windows need, into groups by their first words:
12 of them, or 34, or a whole window where fewer give too large a group. In each
group the suffixes of all windows are sorted, neighbours' common prefixes are
taken, and from these the internal nodes of the group's suffix tree are built. The
windows below a node of depth 35 or more are the repeats; a maximal repeat is a
maximal run of them.

NULL, empty and blank texts have no words. A text of fewer words than a window
keeps all of them. Equal texts (repeated rows too) are repeats of each other.
Texts of any length are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from parallex.llm import repeats
from parallex.llm.common import at, documents, numbered, text_key, without

WINDOW = 35


class Words(repeats.Codec):
    symbol_bytes = 6

    def __init__(self, window: int = WINDOW, gram: int = 12, cell: int = 2):
        self.window, self.gram, self.cell = window, min(gram, window), cell

    def parse(self, text: bytes) -> list[bytes]:
        return text.split()

    def hashed(self, parsed: list[bytes], a: int, b: int) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxh64_digest, parsed[a:b])), ">u8").astype(np.uint64)

    def cut(self, parsed: list[bytes], a: int, b: int) -> bytes:
        return b" ".join(parsed[a:b])

    def solve(self, pieces: list[bytes], counts: list[int]) -> list[np.ndarray]:
        """For each window of each piece, the depth of the node it hangs under in the
        pieces' suffix tree, 0 if that is less than the window."""
        seen: dict[bytes, int] = {}
        split = [p.split() for p in pieces]
        sizes = np.array([len(w) for w in split], np.int64)
        words = np.array([seen.setdefault(w, len(seen)) for part in split for w in part], np.int64)
        # every piece ends with a symbol of its own, so no two suffixes are equal
        ends = np.cumsum(sizes)
        symbols = np.insert(words, ends, len(seen) + np.arange(len(sizes)))
        starts = ends - sizes + np.arange(len(sizes))
        windows = sizes - self.window + 1
        before = np.cumsum(windows) - windows
        first = np.repeat(starts - before, windows) + np.arange(windows.sum())
        depth = np.zeros(len(first), np.int64)
        leaves, common = suffix_leaves(symbols, first)
        node_depth, left, right = deep_nodes(common, self.window)
        edge = np.zeros(len(first) + 1, np.int64)
        np.add.at(edge, left, 1)
        np.add.at(edge, right + 1, -1)
        under = np.cumsum(edge[:-1]) > 0
        # of the nodes above a leaf, the deepest starts or ends a common prefix beside it
        beside = np.maximum(common, np.append(common[1:], 0))
        depth[leaves] = np.where(under, beside, 0)
        # a piece found twice is in the tree once: each of its suffixes is a node with two leaves
        rest = np.repeat(ends + np.arange(len(sizes)), windows) - first
        twice = np.repeat(np.array(counts) > 1, windows)
        return np.split(np.where(twice, rest, depth), np.cumsum(windows)[:-1])


def suffix_leaves(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that start ``at``, sorted (as places in ``at``), and the common
    prefix of each with the one before (0 for the first). Symbols are numbers below
    their count, and the last one is found once. Ranks by 1, 2, 4, ... symbols sort; compared from the longest down,
    they give the common prefixes."""
    rank = symbols.astype(np.int32)
    ranks = [rank]
    while np.bincount(rank[at]).max(initial=0) > 1:
        step = 1 << (len(ranks) - 1)
        below = np.concatenate([rank[step:], np.zeros(step, np.int32)])
        rank = np.unique(rank.astype(np.int64) * len(symbols) + below, return_inverse=True)[1].astype(np.int32)
        ranks.append(rank)
    order = np.argsort(rank[at], kind="stable")
    one, two = at[order[:-1]].copy(), at[order[1:]].copy()
    common = np.zeros(len(at), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        same = (ranks[k][one] == ranks[k][two]).astype(np.int64) << k
        one, two = one + same, two + same
        common[1:] += same
    return order, common


def deep_nodes(common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The internal nodes of depth ``least`` or more of the suffix tree whose sorted
    leaves have these common prefixes: depth, first and last leaf."""
    out: list[tuple[int, int, int]] = []
    path: list[tuple[int, int]] = []  # depth and first leaf of the nodes that are still open
    last = -1
    places = np.flatnonzero(common >= least)
    for leaf, depth in zip(places.tolist(), common[places].tolist(), strict=True):
        first = leaf - 1
        if first != last:
            out += [(d, a, last) for d, a in path]
            path = []
        while path and path[-1][0] > depth:
            closed, first = path.pop()
            out.append((closed, first, leaf - 1))
        if not path or path[-1][0] < depth:
            path.append((depth, first))
        last = leaf
    out += [(d, a, last) for d, a in path]
    nodes = np.array(out, np.int64).reshape(-1, 3)
    return nodes[:, 0], nodes[:, 1], nodes[:, 2]


def dedup(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``docs`` with the repeated words cut out of ``text`` (the words that stay,
    joined by one space), plus ``n_words``, ``n_removed`` and ``deepest``: the depth
    in words of the deepest node that a window hangs under, as far as its piece
    reaches (all words of a repeated text; 0: no repeat). Columns with these names
    are replaced; any others keep their names and values."""
    rows, column = numbered(docs), at(docs, text)
    cut = _cut_texts(rows, window, column, True)
    kept = without(docs, ["n_words", "n_removed", "deepest", text])
    return (rows.withColumn("key", text_key(F.col(column))).join(cut, "key")
            .select(*[F.col(at(docs, c)).alias(c) for c in kept], F.col("kept").alias(text), "n_words", "n_removed", "deepest"))


def _cut_texts(docs: DataFrame, window: int, text: str, whole: bool) -> DataFrame:
    """Per distinct text: counts, the words that stay or their digest, depth of the deepest node."""
    codec = Words(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in repeats._rows(batch):
                out = []
                for key, body, n, spans in rows:
                    words = body.split()
                    gone = repeats.covered(len(words), window, n.as_py(), spans.as_py())
                    removed = int(gone.sum())
                    kept = b" ".join(words if not removed else [w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                    twice = n.as_py() > 1 and len(words) >= window
                    deepest = len(words) if twice else max((x["depth"] for x in spans.as_py() or ()), default=0)
                    out.append((key, len(words), removed, sha256(kept).hexdigest(), kept.decode() if whole else None, deepest))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in out], t) for i, t in
                     enumerate((pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    names=["key", "n_words", "n_removed", "kept_sha256", "kept", "deepest"])

    return repeats.repeated(docs, codec, text).select("key", "text", "n", "spans").mapInArrow(
        run, "key binary, n_words long, n_removed long, kept_sha256 string, kept string, deepest long")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    cut = _cut_texts(docs, WINDOW, "text", False)
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(cut, "key").select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35),
k AS (SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS g FROM w),
c AS (SELECT r, i FROM k QUALIFY count(*) OVER (PARTITION BY g) > 1),
p AS (SELECT DISTINCT r, i + j AS pos FROM c, range(0, 35) AS x(j)),
n AS (SELECT r, count(*) AS gone FROM p GROUP BY r),
t AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
s AS (SELECT t.r, string_agg(word, ' ' ORDER BY t.pos) AS kept FROM t ANTI JOIN p ON t.r = p.r AND t.pos = p.pos GROUP BY t.r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN s USING (r)
"""
