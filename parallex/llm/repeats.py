"""Shared plan of the two exact-repeat operators: find every window of ``window``
symbols (words or bytes) whose symbols also start anywhere else.

1. Equal texts are one row with a count (``texts``); the text is shuffled once,
   and every later step reads that exchange.
2. Suffixes are sampled: of the suffixes that start within a window, the one whose
   first ``gram`` symbols have the least hash (its anchor) stands for the window.
   Equal windows sample equal places, and neighbouring windows mostly the same, so
   a text is a few runs ``(anchor, first window, windows)``.
3. Only prefixes found at two places can hold a repeated window. Their runs are cut
   out as pieces (the symbols of all windows of a run, as one string) and dealt by
   a prefix of variable length: the first ``gram`` symbols of the sampled suffix; for
   a prefix with more runs than fit in ``CHUNK_BYTES``, the first symbols of the suffix
   at the last start of a narrow cell of windows, as many as all its windows share;
   and where the distinct pieces of that do not fit either, single windows by all
   their symbols. A prefix is thus lengthened until its group fits in memory or
   holds equal windows only. Equal pieces of a task are sent at most twice.
4. A task sorts its pieces by key, takes as many whole keys at a time as fit in
   ``CHUNK_BYTES`` and lets the operator's solver find the repeated windows.
5. Runs of repeated windows go back to the texts by piece digest.

No step holds all occurrences of a window, and no pair of occurrences is formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallex.llm.common import slices, text_key

CHUNK_BYTES = 2 << 20    # piece bytes solved together
CHUNK_SYMBOLS = 1 << 20  # symbols of one text hashed together
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 14)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` symbols from each position, by a rolling polynomial."""
    up, down = _power(len(symbols))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(symbols * up, dtype=np.uint64)])
    n = len(symbols) - gram + 1
    h = (sums[gram:] - sums[:-gram]) * down[:n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Least value among ``width`` neighbours from each position."""
    span, least = 1, h
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(h) - width + 1], least[width - span:width - span + len(h) - width + 1])
    return least


def _short(content: bytes) -> int:
    return int.from_bytes(md5(content).digest()[:8], "big", signed=True)


class Codec:
    """What the plan needs to know about symbols; see the operators."""

    window: int
    gram: int
    cell: int

    symbol_bytes = 1  # expected bytes of a symbol

    def hot(self) -> int:
        """Runs of an anchor whose pieces would no longer fit in one chunk."""
        return max(2, CHUNK_BYTES // (self.symbol_bytes * (self.window + (self.window - self.gram) // 2)))

    def full(self) -> int:
        """Distinct pieces of a cell that would no longer fit in one chunk."""
        return max(2, CHUNK_BYTES // (self.symbol_bytes * (self.window + self.cell - 1)))

    def parse(self, text: bytes):
        """The text as something ``hashed`` and ``cut`` understand, with ``len()``."""
        raise NotImplementedError

    def hashed(self, parsed, a: int, b: int) -> np.ndarray:
        """Symbols ``a..b`` as well-mixed uint64 values."""
        raise NotImplementedError

    def cut(self, parsed, a: int, b: int) -> bytes:
        """Symbols ``a..b`` as bytes that ``parse`` reads back."""
        raise NotImplementedError

    def solve(self, pieces: list[bytes], counts: list[int]) -> list[np.ndarray]:
        """For each distinct piece, which of its windows start twice or more, as a
        depth (the symbols that the window's repeat reaches; 0: none) or as a flag."""
        raise NotImplementedError

    def runs(self, parsed) -> tuple[np.ndarray, ...]:
        """Anchor, first window and number of windows of every run, and whether the
        anchor changes its place within the run (the text repeats itself there)."""
        last = len(parsed) - self.window + 1
        out = []
        for a in range(0, max(last, 0), CHUNK_SYMBOLS):
            b = min(a + CHUNK_SYMBOLS, last)
            h, width = gram_hashes(self.hashed(parsed, a, b + self.window - 1), self.gram), self.window - self.gram + 1
            least = window_min(h, width)
            start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
            count = np.diff(np.concatenate([start, [b - a]]))
            # leftmost place of the anchor in the run's first window; up to it, no window of the run loses it
            place = (sliding_window_view(h, width)[start] == least[start][:, None]).argmax(axis=1)
            out.append((least[start].view(np.int64), start + a, count, place < count - 1))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def pieces(self, parsed, anchor: int, first: int, count: int, hot: bool,
               deep: frozenset[int] = frozenset()) -> Iterator[tuple[int, int, bytes]]:
        """``(key, first window, content)`` of a run; of a hot anchor, one for each
        cell of neighbouring windows, keyed by what all windows of the cell share;
        where that key is in ``deep``, one for each window, keyed by all of it."""
        if not hot:
            yield anchor, first, self.cut(parsed, first, first + count + self.window - 1)
            return
        h = gram_hashes(self.hashed(parsed, first, first + count + self.window - 1), self.gram).view(np.int64)
        at = np.flatnonzero(h == anchor)
        place = at[np.searchsorted(at, np.arange(count))]  # leftmost anchor of each window
        cell = (place - np.arange(count)) // self.cell
        start = np.concatenate([[0], np.flatnonzero((place[1:] != place[:-1]) | (cell[1:] != cell[:-1])) + 1])
        for i, j in zip(start.tolist(), [*start[1:].tolist(), count], strict=True):
            a = int(place[i]) - int(cell[i]) * self.cell  # the cell's last possible start
            core = self.cut(parsed, first + a, first + a - self.cell + 1 + self.window)
            key = _short(core + b"|%d" % cell[i])
            if key not in deep:
                yield key, first + i, self.cut(parsed, first + i, first + j + self.window - 1)
                continue
            for k in range(first + i, first + j):
                whole = self.cut(parsed, k, k + self.window)
                yield _short(whole), k, whole


def texts(docs: DataFrame, text: str) -> DataFrame:
    """``(key, text, n)``: distinct texts and how many rows have each."""
    keyed = docs.select(F.coalesce(text_key(F.col(text)), F.lit(b"")).alias("key"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    return keyed.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))


def _fixed(values: list[bytes], repeat: np.ndarray) -> pa.Array:
    """16-byte keys, each repeated, as a binary Arrow array."""
    flat = np.repeat(np.frombuffer(b"".join(values), np.uint8).reshape(-1, 16), repeat, axis=0)
    offsets = np.arange(0, 16 * (len(flat) + 1), 16, dtype=np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for part in slices(batch, 1):
        yield list(zip(part.column(0).to_pylist(), part.column(1).cast(pa.large_binary()).to_pylist(),
                       *[part.column(i) for i in range(2, part.num_columns)], strict=True))


def _runs(t: DataFrame, codec: Codec) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _rows(batch):
                found = [codec.runs(codec.parse(r[1])) for r in rows]
                sizes = np.array([len(x[0]) for x in found], np.int64)
                cols = [np.concatenate(x) for x in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [_fixed([r[0] for r in rows], sizes), pa.array(cols[0]), pa.array(cols[1].astype(np.int32)),
                     pa.array(cols[2].astype(np.int32)), pa.array(cols[3])], names=["key", "anchor", "first", "windows", "moves"])
    return t.select("key", "text", "n").mapInArrow(run, "key binary, anchor long, first int, windows int, moves boolean")


def _cut(t: DataFrame, marked: DataFrame, codec: Codec, content: bool) -> DataFrame:
    """Pieces of the marked runs: ``(prefix, content)``, each at most twice a task,
    or ``(piece, key, first)`` for every occurrence."""
    schema = T.StructType.fromDDL("prefix long, content binary" if content else "piece binary, key binary, first int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[bytes, int] = {}
        for batch in batches:
            for rows in _rows(batch):
                out = []
                for key, text, _, todo, deep in rows:
                    parsed, full = codec.parse(text), frozenset(deep.as_py() or ())
                    for r in todo.as_py():
                        for prefix, first, body in codec.pieces(parsed, r["anchor"], r["first"], r["windows"], r["hot"], full):
                            name = md5(body).digest()
                            if not content:
                                out.append((name, key, first))
                            elif sent.get(name, 0) < 2:
                                sent[name] = sent.get(name, 0) + 1
                                out.append((prefix, body))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[i] for x in out], pa.int64() if f.dataType == T.LongType() else pa.int32()
                                  if f.dataType == T.IntegerType() else pa.binary()) for i, f in enumerate(schema)],
                        names=schema.names)

    joined = t.select("key", "text", "n").join(marked, "key").select("key", "text", "n", "todo", "deep")
    return joined.mapInArrow(run, schema)


def _cells(t: DataFrame, marked: DataFrame, codec: Codec) -> DataFrame:
    """``(prefix, key, name)``: the pieces of hot anchors, without content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _rows(batch):
                out = []
                for key, text, _, todo in rows:
                    parsed = codec.parse(text)
                    out += [(prefix, key, _short(body)) for r in todo.as_py()
                            for prefix, _, body in codec.pieces(parsed, r["anchor"], r["first"], r["windows"], True)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in
                                                  enumerate((pa.int64(), pa.binary(), pa.int64()))], names=["prefix", "key", "name"])

    hot = marked.select("key", F.filter("todo", lambda r: r["hot"]).alias("todo")).where(F.size("todo") > 0)
    joined = t.select("key", "text", "n").join(hot, "key").select("key", "text", "n", "todo")
    return joined.mapInArrow(run, "prefix long, key binary, name long")


def _with_deep(t: DataFrame, marked: DataFrame, codec: Codec) -> DataFrame:
    """``marked`` with the cells of the text whose distinct pieces do not fit in a chunk."""
    cells = _cells(t, marked, codec)
    full = (cells.groupBy("prefix").agg(F.approx_count_distinct("name").alias("pieces"))
            .where(F.col("pieces") > codec.full()).select("prefix"))
    deep = cells.select("prefix", "key").join(full, "prefix", "left_semi").groupBy("key").agg(F.collect_set("prefix").alias("deep"))
    return marked.join(deep, "key", "left")


def _solve(pieces: DataFrame, codec: Codec) -> DataFrame:
    """``(piece, a, b, depth)``: runs ``a..b`` of repeated windows within a piece."""
    def flush(held: dict[bytes, int]) -> pa.RecordBatch:
        bodies, out = list(held), []
        for body, twice in zip(bodies, codec.solve(bodies, list(held.values())), strict=True):
            step = np.diff(np.concatenate([[0], twice > 0, [0]]).astype(np.int8))
            start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            if len(start):
                depth, name = np.maximum.reduceat(twice.astype(np.int32), start), md5(body).digest()
                out += [(name, *x) for x in zip(start.tolist(), end.tolist(), depth.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.binary(), pa.int32(), pa.int32(), pa.int32()))],
            names=["piece", "a", "b", "depth"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        size, last = 0, None
        for batch in batches:
            for prefix, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if size > CHUNK_BYTES and prefix != last:
                    yield flush(held)
                    held, size = {}, 0
                if body not in held:
                    size += len(body)
                held[body] = held.get(body, 0) + 1
                last = prefix
        if held:
            yield flush(held)

    return (pieces.repartition("prefix").sortWithinPartitions("prefix")
            .mapInArrow(run, "piece binary, a int, b int, depth int"))


def repeated(docs: DataFrame, codec: Codec, text: str = "text") -> DataFrame:
    """``(key, text, n, spans)`` for every distinct text: ``spans`` are the ranges
    of first symbols of repeated windows (NULL: none; not yet joined or sorted).
    With ``n > 1`` every window of the text is repeated, listed or not."""
    t = texts(docs, text)
    runs = _runs(t, codec)
    places = F.count(F.lit(1)) + F.count_if("moves")
    often = runs.groupBy("anchor").agg(places.alias("n")).where("n > 1").select("anchor", (F.col("n") > codec.hot()).alias("hot"))
    marked = runs.join(often, "anchor").groupBy("key").agg(
        F.collect_list(F.struct("first", "windows", "anchor", "hot")).alias("todo"))
    marked = _with_deep(t, marked, codec)
    found = _solve(_cut(t, marked, codec, True), codec).groupBy("piece", "a", "b").agg(F.max("depth").alias("depth"))
    where = _cut(t, marked, codec, False)
    spans = (where.join(found, "piece")
             .groupBy("key").agg(F.collect_list(F.struct((F.col("first") + F.col("a")).alias("a"),
                                                         (F.col("first") + F.col("b")).alias("b"), "depth")).alias("spans")))
    return t.select("key", "text", "n").join(spans, "key", "left")


def covered(n: int, window: int, copies: int, spans: list | None) -> np.ndarray:
    """Which of ``n`` symbols lie in a repeated window."""
    edge = np.zeros(n + 1, np.int64)
    if copies > 1 and n >= window:
        spans = [{"a": 0, "b": n - window + 1}]
    for s in spans or ():
        edge[s["a"]] += 1
        edge[s["b"] + window - 1] -= 1
    return np.cumsum(edge[:-1]) > 0
