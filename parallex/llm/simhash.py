"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a non-zero vector of ``radius + 1`` bits. Each non-zero
vector ``v`` gives one table, whose mask keeps the bit positions with an odd
inner product with ``v``. Any ``radius`` positions span too little to be
orthogonal to no ``v``, so two fingerprints within the radius agree under at
least one mask: no pair is missed (Pagh, 2016).

Equal fingerprints are one node. In a bucket (equal masked bits) the distances
are checked exactly and only a star of each linked set leaves the task, never
all pairs. A bucket with more than ``MAX_BUCKET`` fingerprints is split by the
same construction over its free bits, level by level; the bits run out after
four levels, so the largest bucket is bounded and nothing is dropped.

NULL, empty and blank texts have fingerprint zero and link like any other. A
text with fewer words than a shingle is one shingle. Repeated rows share a
fingerprint. A NULL doc_id never becomes a component id unless the component
has no other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from parallex.llm.common import add_columns, documents, named
from parallex.llm.components import components
from parallex.session import pin

SHINGLE = 3
RADIUS = 3
SEED = 42
MAX_BUCKET = 2048  # fingerprints compared with each other in one task
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: a bit is set if it is set in over half of the shingles' XXH64."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests, n = xxh64_digest(joined, SEED), 1
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[:len(words) - shingle].tolist()]
        stops = (ends[shingle - 1:] - 1).tolist()
        digests, n = b"".join([xxh64_digest(joined[i:j], SEED) for i, j in zip(starts, stops, strict=True)]), len(stops)
    rows = np.frombuffer(digests, np.uint8).reshape(n, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        ones += np.unpackbits(rows[i:i + _CHUNK], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, drop: tuple = ()) -> DataFrame:
    """``docs`` plus ``fp`` (a column of that name is replaced)."""
    return add_columns(docs, text, lambda texts: [[fingerprint(t, shingle) for t in texts]], "fp long", drop)


def covering(bits: int, radius: int) -> list[int]:
    """Masks over the set positions of ``bits``: any two words that differ in at
    most ``radius`` of these positions agree under one of the masks."""
    places = [i for i in range(64) if bits >> i & 1]
    n = (1 << radius + 1) - 1
    return [sum(1 << p for k, p in enumerate(places) if ((k * 7 % n + 1) & v).bit_count() & 1) for v in range(1, n + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def stars(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links ``(fingerprint, least of its linked set)`` within one bucket: each
    reached fingerprint is compared once with those not yet reached."""
    out, rest = [], np.unique(fps)
    while len(rest) > 1:
        root, front, rest = int(rest[0]), rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), bool)
            for x in front:
                near |= np.bitwise_count((rest ^ x).view(np.uint64)) <= radius
            front, rest = rest[near], rest[~near]
            out += [(int(x), root) for x in front]
    return out


def links(fps: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``(a, b)``: edges whose components are those of all pairs of distinct
    ``fp`` within ``radius`` bits."""
    spark = fps.sparkSession
    full = (1 << 64) - 1
    # free bits of every bucket mask in use -> masks of the next level: fixed by the radius, not by data
    cut = {full: covering(full, radius)}
    rows = fps.select("fp").distinct().select("fp", F.explode(F.array(*[F.lit(signed(c)) for c in cut[full]])).alias("mask"))
    found = None
    while True:
        rows = rows.distinct().withColumn("key", F.expr("fp & mask"))
        hot = pin(rows.groupBy("mask", "key").count().where(F.col("count") > max_bucket).select("mask", "key"))
        more = not hot.isEmpty()
        got = _linked(rows.join(hot, ["mask", "key"], "left_anti") if more else rows, radius)
        found = got if found is None else found.unionByName(got)
        if not more:
            return found.distinct()
        free = sorted({m & ~c for m, cs in cut.items() for c in cs})
        cut = {m: covering(m, radius) for m in free}
        table = spark.createDataFrame(
            [(signed(full & ~m), [signed((full & ~m) | c) for c in cs]) for m, cs in cut.items()],
            "mask long, masks array<long>")
        rows = (rows.join(hot, ["mask", "key"], "left_semi").select("fp", "mask")
                .join(F.broadcast(table), "mask").select("fp", F.explode("masks").alias("mask")))


def _linked(rows: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * 3
        for batch in _and_end(batches):
            if batch is not None:
                kept = [np.concatenate([k, c.to_numpy(zero_copy_only=False)]) for k, c in zip(kept, batch.columns, strict=True)]
            mask, key, fp = kept
            if not len(fp):
                continue
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            edges = np.concatenate([[0], new, [len(fp)]])
            if batch is not None:  # the last bucket may go on in the next batch
                kept = [k[edges[-2]:] for k in kept]
                edges = edges[:-1]
            size = np.diff(edges)
            two = edges[:-1][size == 2]
            x, y = fp[two], fp[two + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
            a, b = [np.maximum(x, y)[near]], [np.minimum(x, y)[near]]
            for i, n in zip(edges[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
                if got := stars(fp[i:i + n], radius):
                    p, q = zip(*got, strict=True)
                    a.append(np.array(p, np.int64))
                    b.append(np.array(q, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return (rows.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key")
            .mapInArrow(run, "a long, b long"))


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def cluster(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fp, root)`` for every distinct ``fp``: fingerprints with equal ``root``
    are connected by steps of at most ``radius`` bits."""
    nodes = fps.select("fp").distinct()
    roots = components(links(nodes, radius)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps = pin(fingerprints(documents(spark, sf_dir).select("doc_id", "text"), drop=("text",)))
    known = pin(cluster(fps))
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).join(known, "fp")
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = known.join(ids, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each component stays, the one with the
    least doc_id (NULL last; then the least digest of its text). Of rows that
    repeat the same doc_id and text one stays."""
    ident = F.md5(F.concat_ws("\x00", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))
    fps = pin(fingerprints(docs.select("doc_id", "text", ident.alias("row")), drop=("text",)))
    known = cluster(fps)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = fps.groupBy("fp").agg(F.min(order).alias("o")).join(known, "fp")
    keep = first.groupBy("root").agg(F.min("o").alias("o")).select(F.col("o.row").alias("_row"))
    marked = docs.select(*[F.col(c).alias(f"_in{i}") for i, c in enumerate(docs.columns)], ident.alias("_row"))
    return named(marked.join(keep, "_row", "left_semi").dropDuplicates(["_row"]), docs)
