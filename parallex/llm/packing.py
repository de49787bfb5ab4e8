"""Packing of tokenised documents into windows by best-fit decreasing.

A document is its token ids and one end id. Overlong documents are first cut into
full windows; what is left over is a piece shorter than a window. Pieces are
placed longest first, each into the tightest open window that takes it; a segment
tree over the remaining capacities finds that window.

The law only looks at lengths, so it runs exactly, for the whole corpus, on the
number of pieces of each length: at most ``window`` rows reach the driver at any
input size. Windows of equal remaining capacity are held as ranges of ids, and
one step places a run of equal pieces into a range of windows. At most ``3 *
window`` ranges exist at a time (a step leaves at most two pieces of a range
behind), so there are at most ``3 * window ** 2`` steps (about 3 million of 40
bytes at 1024; some thousands on real lengths). They are broadcast, and every
piece finds its place from its rank among the pieces of its length. Ranks are
counted inside the tasks that cut the documents and joined with the counts of
the partitions before; no length, however common, meets in one task.

NULL and empty texts are one piece, the end id. A text that spells a special
token is ordinary text. doc_ids may be NULL or repeat: every row is a document.
Only ``doc_id`` and the text are read, so other columns cannot clash. An empty
table gives no pieces.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parallex.llm.common import documents, slices, stored

WINDOW = 1024
END = 0
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Token ids, as little-endian 32-bit integers, by a byte-level BPE vocabulary
    file. Its pairs and ids run in the faster of the two installed BPE libraries;
    the ids are the same (tests hold them against the file's own library)."""

    def __init__(self, path: str):
        import public_tokenizers
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["content"] for t in model["added_tokens"] if t["special"]}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        byte = {chr(b): b for b in plain}
        byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(map(byte.__getitem__, s)): i for s, i in model["model"]["vocab"].items() if s not in special}
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        ids = {t: self.bpe.encode_to_numpy(t).astype("<u4", copy=False).tobytes() for t in set(texts)}
        return [ids[t] for t in texts]


def cut(docs: DataFrame, window: int = WINDOW, path: str | None = None, text: str = "text") -> DataFrame:
    """The pieces of every document: ``doc_id``, ``start`` (ids before it), ``length``,
    ``tokens`` (its ids, little-endian 32-bit), ``doc_tokens``, and the piece's
    ``local`` rank among those of its length in input partition ``part``."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(path), END.to_bytes(4, "little")
        part, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch in batches:
            for rows in slices(batch, 1):
                ids, starts, tokens, totals = [], [], [], []
                texts = [t or "" for t in rows.column(1).to_pylist()]
                for doc_id, body in zip(rows.column(0).to_pylist(), encoder.encode(texts), strict=True):
                    body += end
                    for a in range(0, len(body), 4 * window):
                        ids.append(doc_id)
                        starts.append(a // 4)
                        tokens.append(body[a:a + 4 * window])
                        totals.append(len(body) // 4)
                length = np.array([len(t) // 4 for t in tokens], np.int64)
                local = np.empty(len(length), np.int64)
                order = np.argsort(length, kind="stable")
                same = length[order]
                first = np.searchsorted(same, same)
                local[order] = np.arange(len(same)) - first + seen[same]
                seen += np.bincount(length, minlength=window + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(length), pa.array(tokens, pa.binary()),
                     pa.array(totals, pa.int64()), pa.array(np.full(len(length), part, np.int32)), pa.array(local)],
                    names=["doc_id", "start", "length", "tokens", "doc_tokens", "part", "local"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, tokens binary, doc_tokens long, part int, local long")


class OpenWindows:
    """Ranges ``(first id, count)`` of open windows by remaining capacity, under a
    segment tree that knows which capacities are present."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.present = np.zeros(2 * self.leaves, bool)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def _set(self, capacity: int) -> None:
        i = self.leaves + capacity
        self.present[i] = bool(self.ranges[capacity])
        while i > 1:
            i //= 2
            self.present[i] = self.present[2 * i] or self.present[2 * i + 1]

    def add(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.ranges[capacity].append((first, count))
            self._set(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        got = self.ranges[capacity].pop()
        self._set(capacity)
        return got

    def tightest(self, length: int) -> int | None:
        """The least capacity present that is at least ``length``."""
        i = self.leaves + length
        if self.present[i]:
            return length
        while i > 1:
            if i % 2 == 0 and self.present[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.present[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Steps ``(length, first rank, first window, pieces per window, first offset)``,
    sorted by length and rank, that place ``counts[length]`` pieces of each length."""
    open_windows, steps, used = OpenWindows(window), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = open_windows.tightest(length)
            if capacity is None:
                capacity, first, n = window, used, -(-left // (window // length))
                used += n
            else:
                first, n = open_windows.take(capacity)
            # the window just served is the tightest again until it is full
            each = capacity // length
            steps.append((length, rank, first, each, window - capacity))
            full, rest = min(n, left // each), 0
            if full < n:
                rest = left - full * each
            open_windows.add(capacity - each * length, first, full)
            if rest:
                open_windows.add(capacity - rest * length, first + full, 1)
            done = full + (rest > 0)
            open_windows.add(capacity, first + done, n - done)
            rank += full * each + rest
            left -= full * each + rest
    return np.array(sorted(steps), np.int64).reshape(-1, 5)


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (a stored result of ``cut``; ``part`` and ``local`` go) with
    ``sequence_id`` and ``offset``."""
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank"))
    # one row per length: at most ``window`` rows
    steps = best_fit_decreasing({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, window)
    steps = pieces.sparkSession.sparkContext.broadcast(steps)
    kept = [c for c in pieces.columns if c not in ("part", "local")]
    ranked = pieces.join(offsets, ["part", "length"]).select(
        *kept, (F.col("rank") + F.col("local")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    at = ranked.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = steps.value
        top = int(table[:, 1].max(initial=0)) + 1
        starts = table[:, 0] * top + table[:, 1]
        for batch in batches:
            length, rank = batch.column(at).to_numpy(), batch.column(len(kept)).to_numpy()
            step = table[np.searchsorted(starts, length * top + np.minimum(rank, top - 1), side="right") - 1]
            into, nth = np.divmod(rank - step[:, 1], step[:, 3])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(step[:, 2] + into), pa.array(step[:, 4] + nth * length)],
                names=batch.schema.names)

    return ranked.mapInArrow(run, ranked.schema)


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None, text: str = "text") -> DataFrame:
    """Every piece of every document with its tokens and its place."""
    return place(stored(cut(docs, window, path, text)), window)


def sequences(packed: DataFrame, window: int = WINDOW, pad: int = END) -> DataFrame:
    """``(sequence_id, n_tokens, tokens)``: the packed windows, filled with ``pad`` up
    to ``window`` unless their length is a power of two."""
    whole = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "tokens"))).alias("parts"))
    body = F.aggregate("parts", F.unhex(F.lit("")), lambda a, p: F.concat(a, p["tokens"]))
    free = F.when(F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0, 0).otherwise(window - F.col("n_tokens"))
    filler = F.unhex(F.repeat(F.lit(pad.to_bytes(4, "little").hex()), free.cast("int")))
    return whole.select("sequence_id", "n_tokens", F.concat(body, filler).alias("tokens"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut(documents(spark, sf_dir)).withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")
    return place(stored(pieces)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
