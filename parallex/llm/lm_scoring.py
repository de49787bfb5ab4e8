"""Language-model scoring by online logistic context mixing.

The model (``bitmix``) codes a text unit by unit and a unit bit by bit. A unit's
first byte is predicted from the unit before; the rest does not depend on the other
units of the text, so that work is done once per distinct unit:

1. Distinct units of all texts with their counts in the training texts, and from
   them the counts of the training words (for the base score).
2. Counts of the low-order contexts: one small table per task, summed.
3. Units are dealt by their first three bytes, so the counts of every longer
   prefix are whole within a partition. A prefix that more than ``GROUP_UNITS``
   units share is hot: its units are dealt by a byte more, and so on; what
   follows a hot prefix is counted over all partitions beforehand (at most 256
   counts each). No prefix count depends on the dealing. There the mixing weights are learned
   online on every training unit, in an order that a hash fixes; weights and
   refinement counts of the partitions are averaged.
4. Every unit is scored with the counts of all training units.
5. First bytes: each task counts the contexts of its training texts piece by piece and
   learns their mixing weights on the way, every occurrence without itself; counts are
   summed and weights averaged.
6. Texts are dealt into blocks of about ``BLOCK_BYTES``. A block's distinct units
   are looked up once, and its texts add up the scores of their units and those of
   the first bytes, each distinct pair of context and byte once.

Tables that are sent around have fixed sizes; what grows with the corpus (units, words, lookups) is
spread by hash and never meets in one task or in the driver.

Training texts are those whose CRC-32 of the doc_id's digits is not a multiple of
10; a NULL doc_id counts as empty digits and is held out. NULL and empty texts
have one token, the end. Repeated rows are separate texts, each learned from.
Without training texts every token is unknown and the mixer keeps its first
weights. Texts and words of any length are scored whole.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.llm import bitmix
from parallex.llm.common import binary, documents, slices, stored
from parallex.session import work_partitions

HOLD_OUT = 10            # one in so many doc_ids
BLOCK_BYTES = 32 << 20   # texts whose units are looked up together
GROUP_UNITS = 1 << 20    # units of one dealing prefix that a task can hold
PART_UNITS = 1 << 18     # units of a partition, on average
SEND_KEYS = 600_000      # distinct units a task gathers before it sends them
FIRST_CODES = 1 << 21    # first bytes of units that are gathered before they are learned
_BATCH, _SMALL = 32_768, 8_192
_PRIOR = 0.1


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HOLD_OUT == 0


def _coded(keys: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct keys, in the order in which they first come, and for each key which of them it is."""
    coded = keys.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def _finder(keys: pa.Array) -> Callable[[pa.Array], np.ndarray]:
    """Gives the places of keys among ``keys``, which are distinct and hold all that are asked for."""
    found = bitmix.hashes(keys)
    order = np.argsort(found)
    found = found[order]
    if (found[1:] == found[:-1]).any():  # two keys of one hash
        return lambda asked: pc.index_in(asked, value_set=keys).to_numpy()
    return lambda asked: order[np.searchsorted(found, bitmix.hashes(asked))]


def _units(docs: DataFrame) -> DataFrame:
    """``(key, train)``: every distinct unit and its count in the training texts."""
    def send(found: list[pa.Array], train: list[np.ndarray]) -> pa.RecordBatch:
        keys, at = _coded(pa.concat_arrays(found))
        n = np.bincount(at, np.concatenate(train), len(keys))  # 0: only in held-out texts
        return pa.RecordBatch.from_arrays([keys.cast(pa.binary()), pa.array(n.astype(np.int64))], names=["key", "train"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.Array] = []
        train: list[np.ndarray] = []
        waiting = 0
        for batch in batches:
            for part in slices(batch, 1):
                keys, of = bitmix.split(binary(part.column(1)))
                keys, at = _coded(keys)
                trained = np.array([not held_out(d) for d in part.column(0).to_pylist()], float)
                found.append(keys)
                train.append(np.bincount(at, trained[of], len(keys)))
                waiting += len(keys)
                if waiting > SEND_KEYS:
                    sent, waiting = send(found, train), 0
                    if sent.num_rows > SEND_KEYS:
                        yield sent
                        found, train = [], []
                    else:
                        found, train = [sent.column(0).cast(pa.large_binary())], [sent.column(1).to_numpy()]
        if found:
            yield send(found, train)

    found = docs.mapInArrow(run, "key binary, train long").groupBy("key").agg(F.sum("train").alias("train"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = [bitmix.word_of(k) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of, pa.binary())], names=["key", "train", "word"])

    return stored(found.mapInArrow(words, "key binary, train long, word binary"))


def _only_units(units: DataFrame) -> DataFrame:
    return units.where(F.substring("key", 1, 1) != F.lit(bitmix.WORD_MARK)).select("key", "train")


def _hot(units: DataFrame) -> tuple[frozenset[bytes], int]:
    """Prefixes shared by more units than a task can hold, and how many partitions
    the units are dealt to. There are at most ``LONG + 1`` times units / GROUP_UNITS."""
    hot: set[bytes] = set()
    level = _only_units(units)
    for d in range(bitmix.LOCAL_FROM, bitmix.LONG + 2):
        sizes = level.where(F.length("key") >= d).groupBy(F.substring("key", 1, d).alias("p")).count()
        found = [bytes(r["p"]) for r in sizes.where(F.col("count") > GROUP_UNITS).select("p").collect()]
        if not found:
            break
        hot.update(found)
        over = units.sparkSession.createDataFrame([(bytearray(p),) for p in found], "p binary")
        level = _only_units(units).join(F.broadcast(over), F.substring("key", 1, d) == F.col("p"), "left_semi")
    total = _only_units(units).count()
    return frozenset(hot), max(work_partitions(units.sparkSession), -(-total // PART_UNITS))


def _dealt_by(key: bytes, hot: frozenset[bytes]) -> int:
    """Bytes of the key that decide its partition: no longer prefix is hot."""
    d = bitmix.LOCAL_FROM
    while d < len(key) and key[:d] in hot:
        d += 1
    return d


def _after_hot(units: DataFrame, hot: frozenset[bytes]) -> dict[bytes, list[tuple[bytes, int]]]:
    """For every hot prefix, itself with each next byte and how often that is in the training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()  # at most 256 for every hot prefix
        for batch in batches:
            for key, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for d in range(bitmix.LOCAL_FROM, len(key)):
                    if key[:d] not in hot:
                        break
                    seen[key[:d + 1]] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["key", "n"])

    out: dict[bytes, list[tuple[bytes, int]]] = {}
    if hot:
        train = _only_units(units).where("train > 0")
        for r in train.mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n")).collect():
            out.setdefault(bytes(r["key"])[:-1], []).append((bytes(r["key"]), r["n"]))
    return out


def _partitions(units: DataFrame, dealing: tuple[frozenset[bytes], int]) -> DataFrame:
    hot, parts = dealing
    if not hot:
        return _only_units(units).repartition(parts, F.substring("key", 1, bitmix.LOCAL_FROM))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by = [k[:_dealt_by(k, hot)] for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(by, pa.binary())], names=["key", "train", "by"])

    return (_only_units(units).mapInArrow(run, "key binary, train long, by binary")
            .repartition(parts, "by").select("key", "train"))


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[list[bytes], np.ndarray]:
    """All units of a partition, in an order that a hash fixes."""
    keys, counts = [pa.array([], pa.large_binary())], [np.zeros(0, np.int64)]
    for batch in batches:
        keys.append(batch.column(0).cast(pa.large_binary()))
        counts.append(batch.column(1).to_numpy())
    found = pa.concat_arrays(keys)
    found, n = found.take(order := pc.sort_indices(found)), np.concatenate(counts)[order.to_numpy()]
    by_hash = np.argsort(bitmix.crc(found), kind="stable")
    return found.take(pa.array(by_hash)).to_pylist(), n[by_hash]


def _chunks(keys: list[bytes], counts: np.ndarray, size: int, bits: int = bitmix.LOCAL_BITS,
            whole: np.ndarray | None = None) -> Iterator[bitmix.Units]:
    for i in range(0, len(keys), size):
        yield bitmix.Units(keys[i:i + size], counts[i:i + size], bits, None if whole is None else whole[i:i + size])


def _summed(parts: DataFrame) -> dict[str, np.ndarray]:
    """Arrays that are the sums over the partitions of arrays sent in ``(name,
    place, cells)`` rows; their total size is fixed by the model."""
    def add(_, table):
        total = sum(np.frombuffer(x, np.float64) for x in table.column("cells").to_pylist())
        return pa.table({"name": table.column("name")[:1], "place": table.column("place")[:1],
                         "cells": pa.array([total.tobytes()], pa.binary())})

    out: dict[str, dict[int, np.ndarray]] = {}
    got = parts.groupBy("name", "place").applyInArrow(add, "name string, place int, cells binary")
    for r in got.collect():
        out.setdefault(r["name"], {})[r["place"]] = np.frombuffer(bytes(r["cells"]), np.float64)
    return out


_CELLS = 1 << 14


def _rows(name: str, array: np.ndarray) -> Iterator[tuple]:
    flat = array.reshape(-1).astype(np.float64)
    for i in range(0, len(flat), _CELLS):
        part = flat[i:i + _CELLS]
        if part.any():
            yield name, i // _CELLS, part.tobytes()


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.binary()))],
        names=["name", "place", "cells"])


def _filled(got: dict[int, np.ndarray] | None, like: np.ndarray) -> np.ndarray:
    flat = np.zeros(like.size, np.float64)
    for place, cells in (got or {}).items():
        flat[place * _CELLS:place * _CELLS + len(cells)] = cells
    return flat.reshape(like.shape)


def _low_orders(units: DataFrame) -> list[np.ndarray]:
    """Count tables of the contexts that no partition holds alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = bitmix.new_global()
        for batch in batches:
            bitmix.learn_low_counts(bitmix.Grams(batch.column(0).to_pylist(), batch.column(1).to_numpy()), tables)
        yield _sent([r for i, t in enumerate(tables) for r in _rows(str(i), t)])

    train = _only_units(units).where("train > 0")
    got = _summed(train.mapInArrow(run, "name string, place int, cells binary"))
    return [_filled(got.get(str(i)), t).astype(np.float32) for i, t in enumerate(bitmix.new_global())]


def _tables(low: list[np.ndarray], keys: list[bytes], counts: np.ndarray,
            after: dict[bytes, list[tuple[bytes, int]]], bits: int) -> list[np.ndarray]:
    """The low-order tables and this partition's prefix tables. What follows a hot
    prefix comes from ``after``, counted over all partitions."""
    local = bitmix.new_local(bits)
    add = [*[None] * bitmix.N_GLOBAL, *local]
    trained = np.flatnonzero(counts > 0)
    hot = frozenset(after)
    whole = np.array([_dealt_by(keys[i], hot) for i in trained], np.int64) if hot else None
    bitmix.learn_prefix_counts(bitmix.Paths([keys[i] for i in trained], counts[trained], bits, whole), local)
    here = sorted({k[:d] for k in keys for d in range(bitmix.LOCAL_FROM, _dealt_by(k, hot) + 1)} & hot) if hot else []
    more = [x for p in here for x in after[p]]
    for u in _chunks([k for k, _ in more], np.array([n for _, n in more], np.int64), _BATCH, bits,
                     np.array([len(k) - 1 for k, _ in more], np.int64)):
        bitmix.learn_counts(u, add)  # each for its last byte only
    return [*low, *local]


def _mixer(units: DataFrame, low, after, dealing: tuple[frozenset[bytes], int]) -> tuple[np.ndarray, np.ndarray]:
    """Mixing weights (mean of the partitions', by training count) and refinement counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = _gathered(batches)
        bits = bitmix.local_bits(len(keys))
        tables = _tables(low.value, keys, counts, after.value, bits)
        trained = np.flatnonzero(counts > 0)
        weights = bitmix.new_weights()
        moved, refine = np.zeros_like(weights), np.zeros((256, bitmix.CELLS, 2))
        for u in _chunks([keys[i] for i in trained], counts[trained], _SMALL, bits):
            bitmix.learn_weights(u, tables, weights, moved, refine)
        mass = float(counts[trained].sum())
        if mass:
            yield _sent([*_rows("weights", weights * mass), *_rows("mass", np.array([mass])), *_rows("refine", refine)])

    return _mixed(_summed(_partitions(units, dealing).mapInArrow(run, "name string, place int, cells binary")))


def _mixed(got: dict[str, dict[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights (mean of the partitions', by training count) and refinement counts."""
    weights, refine = bitmix.new_weights(), np.zeros((256, bitmix.CELLS, 2))
    if "mass" in got:
        weights = _filled(got["weights"], weights) / got["mass"][0][0]
    return weights, _filled(got.get("refine"), refine)


def _firsts(docs: DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Count tables, mixing weights and refinement counts of the units' first bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, weights, mass = bitmix.Firsts.tables(), bitmix.new_weights(), 0.0
        moved, refine = np.zeros_like(weights), np.zeros((256, bitmix.CELLS, 2))
        waiting: list[np.ndarray] = []

        def learn() -> float:
            codes, n = np.unique(np.concatenate(waiting), return_counts=True)
            order = np.random.default_rng(len(codes)).permutation(len(codes))
            codes, n = codes[order], n[order]
            bitmix.learn_counts(bitmix.Firsts(codes, n), [tables[0], None, *tables[2:]])
            for i in range(0, len(codes), _SMALL):
                bitmix.learn_weights(bitmix.Firsts(codes[i:i + _SMALL], n[i:i + _SMALL]), tables, weights, moved, refine)
            return float(n.sum())

        for batch in batches:
            for part in slices(batch, 1):
                keys, of = bitmix.split([t for d, t in zip(part.column(0).to_pylist(), binary(part.column(1)), strict=True) if not held_out(d)])
                keys, at = _coded(keys)
                waiting.append(bitmix.first_codes(at, *bitmix.traits(keys), of)[0])
                if sum(map(len, waiting)) > FIRST_CODES:
                    mass += learn()
                    waiting.clear()
        if waiting:
            mass += learn()
        if mass:
            yield _sent([r for i, t in enumerate(tables) for r in _rows(str(i), t)])
            yield _sent([*_rows("weights", weights * mass), *_rows("mass", np.array([mass])), *_rows("refine", refine)])

    got = _summed(docs.mapInArrow(run, "name string, place int, cells binary"))
    return [_filled(got.get(str(i)), t).astype(np.float32) for i, t in enumerate(bitmix.Firsts.tables())], *_mixed(got)


def _scored(units: DataFrame, low, mixer, after, dealing: tuple[frozenset[bytes], int]) -> DataFrame:
    """``(key, score)``: log10 probability of every unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = _gathered(batches)
        if keys:
            bits = bitmix.local_bits(len(keys))
            model = bitmix.Scorer(_tables(low.value, keys, counts, after.value, bits), *mixer.value)
            scores = model.log_probability(bitmix.Paths(keys, counts, bits))
            for i in range(0, len(keys), _BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + _BATCH], pa.binary()), pa.array(scores[i:i + _BATCH])], names=["key", "score"])

    return _partitions(units, dealing).mapInArrow(run, "key binary, score double")


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, bits_per_byte)``; the last is the model's
    total bits over the text's bytes with the end mark."""
    spark = docs.sparkSession
    light = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    units = _units(light)
    words = units.where("word is not null").groupBy("word").agg(F.sum("train").alias("c"))
    # end tokens: one per training text
    ends = units.where(F.substring("key", -1, 1) == F.lit(b"\xff")).agg(F.sum("train")).first()[0] or 0
    known = words.where("c > 0").agg(F.count(F.lit(1)), F.sum("c")).first()
    n, v = int(known[1] or 0) + ends, known[0] + (1 if ends else 0)
    low = spark.sparkContext.broadcast(_low_orders(units))
    dealing = _hot(units)
    after = spark.sparkContext.broadcast(_after_hot(units, dealing[0]))
    mixer = spark.sparkContext.broadcast(_mixer(units, low, after, dealing))
    firsts = spark.sparkContext.broadcast(_firsts(light))
    # units and words are spread by hash: a partition's table is small, no sort is
    # needed. Words first: what follows is partitioned by unit, as the lookup below.
    counted = units.select("key", "word").join(words.hint("shuffle_hash"), "word", "left").select("key", "c")
    table = (counted.join(_scored(units, low, mixer, after, dealing).hint("shuffle_hash"), "key", "left")
             .select("key", F.col("score").cast("float").alias("score"), "c"))  # no c: no word
    total = light.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1
    dealt = light.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long"))

    def ask(key, rows):
        found = [_coded(bitmix.split(binary(part.column(0)))[0])[0]
                 for batch in rows.select(["text"]).to_batches() for part in slices(batch, 0)]
        keys = pa.concat_arrays(found).unique().cast(pa.binary())
        return pa.table({"block": pa.array(np.full(len(keys), key[0].as_py(), np.int64)), "key": keys})

    asked = dealt.groupBy("block").applyInArrow(ask, "block long, key binary")
    answers = asked.join(table.hint("shuffle_hash"), "key").select("block", "key", "score", "c")
    floor, below = math.log10(_PRIOR), math.log10(n + _PRIOR * (v + 1))

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]

    def add_up(rows, found):
        keys = pa.concat_arrays([pa.array([], pa.large_binary()), *[k.cast(pa.large_binary()) for k in found.column("key").chunks]])
        word, c = found.column("c").is_valid().to_numpy(), found.column("c").fill_null(0).to_numpy()
        unit = np.nan_to_num(found.column("score").to_numpy().astype(np.float64))
        base = np.where(word, np.log10(c + _PRIOR) - below, 0.0)
        known = word & (c > 0)
        end = (math.log10(ends + _PRIOR) if ends else floor) - below
        tables, *mix = firsts.value
        model, traits, places = bitmix.Scorer(tables, *mix), bitmix.traits(keys), _finder(keys)

        def first_bytes(at: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
            codes, of = bitmix.first_codes(at, *traits, of)
            codes, which = np.unique(codes, return_inverse=True)
            each = np.zeros(len(codes))
            for i in range(0, len(codes), _BATCH):
                each[i:i + _BATCH] = model.log_probability(bitmix.Firsts(codes[i:i + _BATCH], np.ones(len(codes[i:i + _BATCH]))))
            return np.bincount(of, each[which], texts)

        out = []
        for batch in rows.select(["doc_id", "text"]).to_batches():
            for part in slices(batch, 1):  # arrays over tokens stay small
                docs, texts = part.column(0), binary(part.column(1))
                size = np.array([len(t or b"") for t in texts])
                mine, of = bitmix.split(texts)
                mine, at = _coded(mine)
                at = places(mine)[at]
                n_tokens, n_known, bases, units = (np.bincount(of, x[at], len(size)) for x in (word, known, base, unit))
                total = units + first_bytes(at, of, len(size))
                out.append(pa.RecordBatch.from_arrays(
                    [docs, pa.array([held_out(d) for d in docs.to_pylist()], pa.bool_()), pa.array(n_tokens.astype(np.int64) + 1),
                     pa.array(n_known.astype(np.int64) + (1 if ends else 0)), pa.array(np.full(len(size), n, np.int64)), pa.array(bases + end),
                     pa.array(total), pa.array(-total * math.log2(10) / (size + 1))], names=names))
        return pa.Table.from_batches(out)

    kind = light.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        add_up, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double, bits_per_byte double")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
