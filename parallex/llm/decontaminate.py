"""Benchmark decontamination with an Aho-Corasick automaton.

Texts and benchmark items are normalised alike: A-Z lower-cased, words are runs
of ASCII letters, digits and non-ASCII characters. A pattern is a window of 10
consecutive item words; an item with fewer words, but not none, is one pattern.
Every word of the benchmark has one of ``SYMBOLS`` symbols of the automaton and
every other word the symbol 0, so a text is scanned once, word by word, and all
windows that may occur anywhere are reported; those whose words are not the
window's own, only of the same symbols, are left out. A step looks through a
node's edges one by one, which a symbol for each word would make as many as the
benchmark has words. Hits are mapped back to code point offsets of the original
text.

The automaton is broadcast only in blocks of bounded size: a benchmark whose
distinct texts hold more than ``BLOCK_BYTES`` is dealt into several blocks, each
with an automaton of its own, and every text is scanned against each of them. The
dealt texts are written once; the driver holds one block at a time, on its way
into a broadcast. Items with equal texts are one text with several ids.

NULL and empty texts have no words and are never contaminated. NULL or wordless
items have no window. Items that share a window are all reported; repeated
item rows count once; an item with a NULL id taints text but has no id to list.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.llm.common import add_columns, at, documents, named, numbered, stored, without

WINDOW = 10
SYMBOLS = 32  # most edges of a node; fewer make short windows look alike, to be told apart word by word
BLOCK_BYTES = 1 << 20  # UTF-8 bytes of item texts in one automaton (about 100 MB in a worker)
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(c if c in _WORD else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def normalised(text: bytes | None) -> bytes:
    """Same length as ``text``: word bytes lower-cased, all others blank."""
    return (text or b"").translate(_TABLE)


def windows(text: bytes | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    words = normalised(text).split()
    return [tuple(words[i:i + window]) for i in range(max(len(words) - window, 0) + 1)] if words else []


class Automaton:
    """Windows of some items as one Aho-Corasick automaton over word symbols."""

    def __init__(self, items: Iterable[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.ids: dict[bytes | None, set] = {}  # of each distinct text
        for item, text in items:
            self.ids.setdefault(text, set()).add(item)
        self.owners: dict[tuple, set] = {}  # texts of each window
        for text in self.ids:
            alone = {text}  # one set for all windows of this text only
            for w in windows(text, window):
                texts = self.owners.setdefault(w, alone)
                if len(texts) > 1:
                    texts.add(text)
                elif text not in texts:
                    self.owners[w] = texts | alone
        self.symbol: dict[bytes, str] = {}
        self.machine = ahocorasick.Automaton()
        for w in self.owners:
            key = "".join([self.symbol.setdefault(x, chr(len(self.symbol) % SYMBOLS + 1)) for x in w])
            self.machine.add_word(key, len(w))
        if self.owners:
            self.machine.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, list, list, list]:
        """Number of words; maximal runs of hit words as word positions and as
        code point offsets of the original (end exclusive); ids of the items hit."""
        flat = normalised(text)
        words = flat.split()
        if not self.owners or not words:
            return len(words), [], [], []
        may = self.machine.iter("".join(map(self.symbol.get, words, repeat("\0"))))
        found = [(end + 1 - n, end + 1, owners) for end, n in may if (owners := self.owners.get(tuple(words[end + 1 - n:end + 1])))]
        if not found:
            return len(words), [], [], []
        edge = np.zeros(len(words) + 1, np.int64)
        texts: set = set()
        for start, end, owners in found:
            edge[start] += 1
            edge[end] -= 1
            texts |= owners
        ids = set().union(*(self.ids[t] for t in texts)) - {None}
        hit = np.diff(np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]]).astype(np.int8))
        runs = list(zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist(), strict=True))
        raw = np.frombuffer(flat, np.uint8)
        step = np.diff(np.concatenate([[0], raw != 32, [0]]).astype(np.int8))
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # code points before a byte offset
        point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        spans = [(int(point[first[a]]), int(point[last[b - 1]])) for a, b in runs]
        return len(words), runs, spans, sorted(ids)


def blocks(items: DataFrame, item_id: str = "item_id", text: str = "text",
           block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[bytes, list[str | None]]]]:
    """The distinct item texts with their ids, dealt into lists of about
    ``block_bytes`` of text, one after the other."""
    light = items.where(F.col(text).isNotNull()).select(
        F.col(item_id).cast("string").alias("i"), F.encode(F.col(text), "utf-8").alias("t"))
    # a NULL id stands in the list as NULL, so that its text is still looked for
    texts = stored(light.groupBy("t").agg(F.collect_set(F.struct("i")).alias("ids")))
    size = texts.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(-(-size // block_bytes), 1)
    dealt = stored(texts.withColumn("b", F.pmod(F.xxhash64("t"), F.lit(n))).repartitionByRange("b", "t")) if n > 1 else texts.withColumn("b", F.lit(0))
    for k in range(n):
        yield [(bytes(r["t"]), [x["i"] for x in r["ids"]]) for r in dealt.where(F.col("b") == k).collect()]


def hits(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES, drop: Sequence[str] = ()) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit`` (words inside any occurrence of a
    window), ``spans`` (runs of hit words as offsets into the original text),
    ``items`` (sorted ids of the items with an occurring window) and
    ``contaminated``. Columns of ``docs`` with these names are replaced."""
    spark = docs.sparkSession
    names = ["n_words", "n_hit", "spans", "items", "contaminated"]
    out = docs.select(*without(docs, [n for n in names if n != text]))
    # the driver lets go of a block once it is broadcast
    sent = [spark.sparkContext.broadcast(part) for part in blocks(items, text="text", block_bytes=block_bytes)]
    for k, part in enumerate(sent):
        out = add_columns(out, text, _scanner(part, window),
                          f"_n{k} long, _r{k} array<struct<a:int,b:int>>, _s{k} array<struct<start:int,end:int>>, _i{k} array<string>",
                          drop=drop if k == len(sent) - 1 else ())
    every = range(len(sent))
    gather = lambda c: F.concat(*[F.col(f"_{c}{k}") for k in every])
    if len(sent) == 1:  # runs of one automaton do not overlap
        n_hit = F.aggregate("_r0", F.lit(0).cast("long"), lambda x, r: x + r["b"] - r["a"])
    else:
        n_hit = F.size(F.array_distinct(F.flatten(F.transform(gather("r"), lambda r: F.sequence(r["a"], r["b"] - 1))))).cast("long")
    keep = [c for c in out.columns if c not in {f"_{x}{k}" for x in "nrsi" for k in every}]
    return out.select(*keep, F.col("_n0").alias("n_words"), n_hit.alias("n_hit"), F.array_sort(F.array_distinct(gather("s"))).alias("spans"),
                      F.array_sort(F.array_distinct(gather("i"))).alias("items")).withColumn("contaminated", F.col("n_hit") > 0)


def _scanner(sent, window: int):
    name = uuid.uuid4().hex

    def run(texts: list) -> list[list]:
        machine = _machine(name, sent, window)
        rows = [machine.scan(t) for t in texts]
        return [list(x) for x in zip(*rows, strict=True)] if rows else [[]] * 4
    return run


_machines: dict[str, Automaton] = {}


def _machine(name: str, sent, window: int) -> Automaton:
    """The automaton of a block; a worker holds one at a time."""
    if name not in _machines:
        _machines.clear()
        _machines[name] = Automaton(((i, text) for text, ids in sent.value for i in ids), window)
    return _machines[name]


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = hits(documents(spark, sf_dir).select("doc_id", "text"), items, drop=("text",))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without any benchmark window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return named(hits(numbered(docs), items, text=at(docs, "text")).where("not contaminated"), docs)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id,
       regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
i AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS gram
      FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM b WHERE len(ws) > 0)),
g AS (SELECT r, n, p, array_to_string(ws[p:p + n - 1], ' ') AS gram
      FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM i) WHERE len(ws) >= n)),
h AS (SELECT r, p, g.n, item_id FROM g JOIN i ON g.gram = i.gram AND g.n = i.n),
w AS (SELECT r, count(DISTINCT x)::BIGINT AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS x FROM h) GROUP BY r),
t AS (SELECT r, list_sort(list(DISTINCT item_id)) AS ids FROM h GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN w USING (r) LEFT JOIN t USING (r)
"""
