"""Suffix-array dedup over bytes by difference-cover blockwise sorting.

Every byte covered by a 400-byte string that also starts anywhere else is
removed; strings never cross documents. ``repeats`` deals the candidate suffixes
into groups that fit in memory. In a group, the suffixes at the positions of a
difference cover modulo 16 (5 of 16) are ranked beforehand by doubling. Then one
suffix bucket (a first byte) is sorted at a time: by the first and last 16 bytes
of the 400, and ties, which may be long, by the cover: for any two positions
some shift below 16 takes both into the cover, where their ranks over the next
384 bytes decide. All ties of a bucket are resolved at once by ternary
partitioning around one suffix each.

NULL and empty texts have no bytes. A text shorter than a window stays whole.
Equal texts (repeated rows too) are repeats of each other. Texts of any length
are handled whole. Removal may cut a multi-byte character; the bytes that remain
are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.llm import repeats
from parallex.llm.common import at, documents, numbered, text_key, without

WINDOW = 400
PERIOD = 16
COVER = (0, 1, 2, 5, 8)  # every difference modulo 16 is one of two elements
_IN = np.array([COVER.index(r) if r in COVER else -1 for r in range(PERIOD)])
_SHIFT = np.array([[next(d for d in range(PERIOD) if _IN[(p + d) % PERIOD] >= 0 and _IN[(q + d) % PERIOD] >= 0)
                    for q in range(PERIOD)] for p in range(PERIOD)])
_BYTE = np.random.default_rng(8).integers(0, 1 << 64, 256, np.uint64)


class Bytes(repeats.Codec):
    """``window`` is a multiple of 16, 48 at least."""

    def __init__(self, window: int = WINDOW, gram: int = 64, cell: int = 8):
        if window % PERIOD or window < 3 * PERIOD:
            raise ValueError("the window must be a multiple of 16 bytes, 48 at least")
        self.window, self.gram, self.cell = window, min(gram, window), cell

    def parse(self, text: bytes) -> bytes:
        return text

    def hashed(self, parsed: bytes, a: int, b: int) -> np.ndarray:
        return _BYTE[np.frombuffer(parsed, np.uint8, b - a, a)]

    def cut(self, parsed: bytes, a: int, b: int) -> bytes:
        return parsed[a:b]

    def solve(self, pieces: list[bytes], counts: list[int]) -> list[np.ndarray]:
        sizes = np.array([len(p) for p in pieces])
        windows = sizes - self.window + 1
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(windows)])[:-1], windows) + np.arange(windows.sum())
        data = b"".join(pieces) + bytes(self.window + 2 * PERIOD)
        word = np.ndarray((len(data) - 8,), ">u8", data, strides=(1,))  # the 8 bytes from each position
        rank = self._cover_ranks(word, int(sizes.sum()))
        twice = np.repeat(np.array(counts), windows) > 1
        tail = self.window - PERIOD
        first = np.frombuffer(data, np.uint8)[at]
        order = np.argsort(first, kind="stable")
        for bucket in np.split(order, np.flatnonzero(np.diff(first[order])) + 1):
            p = at[bucket]
            keys = [word[p + tail + 8], word[p + tail], word[p + 8], word[p]]
            inner = np.lexsort(keys)
            same = np.ones(len(p) - 1, bool)
            for k in keys:
                k = k[inner]
                same &= k[1:] == k[:-1]
            self._resolve(at, bucket[inner], np.concatenate([[0], np.cumsum(~same)]), rank, twice)
        return np.split(twice, np.cumsum(windows)[:-1])

    def _cover_ranks(self, word: np.ndarray, n: int) -> np.ndarray:
        """Ranks of the cover positions by their ``window - 16`` bytes."""
        base = np.arange(0, n + PERIOD, PERIOD)
        p = np.minimum((base[:, None] + np.array(COVER)).ravel(), len(word) - 9)
        order = np.lexsort([word[p + 8], word[p]])
        new = np.ones(len(p), bool)
        new[1:] = (word[p][order][1:] != word[p][order][:-1]) | (word[p + 8][order][1:] != word[p + 8][order][:-1])
        rank = np.empty(len(p), np.int64)
        rank[order] = np.cumsum(new)
        levels, length, want = {1: rank}, 1, self.window // PERIOD - 1  # in periods
        while length < want:
            # the largest known length that still fits: doubling, then the rest
            step = max(k for k in levels if k <= want - length)
            shift = len(COVER) * length
            tail = np.concatenate([levels[step][shift:], np.zeros(min(shift, len(rank)), np.int64)])
            rank = np.unique(rank * (len(rank) + 2) + tail, return_inverse=True)[1] + 1
            length += step
            levels[length] = rank
        return rank

    @staticmethod
    def _resolve(at: np.ndarray, who: np.ndarray, group: np.ndarray, rank: np.ndarray, twice: np.ndarray) -> None:
        """Mark the members of ``who`` that equal another one of their group."""
        while len(who):
            size = np.bincount(group)
            stay = size[group] > 1
            who, group = who[stay], group[stay]
            if not len(who):
                return
            head = np.concatenate([[True], group[1:] != group[:-1]])
            group = np.cumsum(head) - 1
            size = np.bincount(group)
            pivot = at[who[np.flatnonzero(head) + size // 2]][group]
            p = at[who]
            d = _SHIFT[p % PERIOD, pivot % PERIOD]
            a, b = p + d, pivot + d
            side = np.sign(rank[a // PERIOD * len(COVER) + _IN[a % PERIOD]] - rank[b // PERIOD * len(COVER) + _IN[b % PERIOD]])
            equal = side == 0
            many = np.bincount(group[equal], minlength=len(size))
            twice[who[equal & (many[group] > 1)]] = True
            who, group = who[~equal], (2 * group + (side > 0))[~equal]
            order = np.argsort(group, kind="stable")
            who, group = who[order], group[order]
            if len(group):
                group = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))


def _cut_texts(docs: DataFrame, window: int, text: str, whole: bool) -> DataFrame:
    """Per distinct text: counts and the bytes that stay, or their digest."""
    codec = Bytes(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in repeats._rows(batch):
                out = []
                for key, body, n, spans in rows:
                    gone = repeats.covered(len(body), window, n.as_py(), spans.as_py())
                    removed = int(gone.sum())
                    kept = np.frombuffer(body, np.uint8)[~gone].tobytes() if removed else body
                    n_spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                    out.append((key, len(body), removed, n_spans, sha256(kept).hexdigest(), kept if whole else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in out], t) for i, t in
                     enumerate((pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                    names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return repeats.repeated(docs, codec, text).select("key", "text", "n", "spans").mapInArrow(
        run, "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def dedup(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``docs`` with ``kept`` (the bytes that stay), ``n_bytes``, ``n_removed`` and
    ``n_spans``. Columns with these names are replaced."""
    names = ["kept", "n_bytes", "n_removed", "n_spans"]
    rows, column = numbered(docs), at(docs, text)
    cut = _cut_texts(rows, window, column, True)
    return (rows.withColumn("key", text_key(F.col(column))).join(cut, "key")
            .select(*[F.col(at(docs, c)).alias(c) for c in without(docs, names)], *names))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    cut = _cut_texts(docs, WINDOW, "text", False)
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(cut, "key").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM d WHERE len(h) >= 800),
k AS (SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS g FROM w),
c AS (SELECT r, i FROM k QUALIFY count(*) OVER (PARTITION BY g) > 1),
e AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 400, true) AS starts FROM c),
u AS (SELECT r, i, count(*) FILTER (starts) OVER (PARTITION BY r ORDER BY i) AS run FROM e),
v AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM u GROUP BY r, run),
x AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM v),
y AS (SELECT r, any_value(h) AS h, sum(b - a) AS gone, count(*) AS runs, max(b) AS tail,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM x JOIN d USING (r) GROUP BY r)
SELECT doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN y.r IS NULL THEN d.h ELSE kept || substr(d.h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN y USING (r)
"""
