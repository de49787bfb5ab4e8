"""Substring dedup and suffix-array dedup against brute force."""

import hashlib
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import tables  # noqa: E402

from parallex.llm import repeats, substring_dedup, suffix_dedup  # noqa: E402


def covered(units, window):
    seen = Counter(hash(tuple(u[i:i + window])) for u in units for i in range(len(u) - window + 1))
    for u in units:
        edge = np.zeros(len(u) + 1, int)
        for i in range(len(u) - window + 1):
            if seen[hash(tuple(u[i:i + window]))] > 1:
                edge[i] += 1
                edge[i + window] -= 1
        yield u, np.cumsum(edge[:-1]) > 0


def brute_words(data):
    for (u, gone), r in zip(covered([(r[1] or "").encode().split() for r in data], 35), data, strict=True):
        kept = b" ".join(w for w, g in zip(u, gone, strict=True) if not g)
        yield str(r[0]), str(len(u)), str(int(gone.sum())), hashlib.sha256(kept).hexdigest()


def brute_bytes(data):
    for (u, gone), r in zip(covered([(r[1] or "").encode() for r in data], 400), data, strict=True):
        kept = bytes(c for c, g in zip(u, gone, strict=True) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        yield str(r[0]), str(len(u)), str(int(gone.sum())), str(spans), hashlib.sha256(kept).hexdigest()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    tables.documents(spark, path)
    return path


@pytest.mark.parametrize("chunk", [600, 2 << 20])  # 600 bytes: nearly every anchor is hot
def test_both_equal_brute_force(spark, folder, monkeypatch, chunk):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    out = substring_dedup.op1_substring_dedup(spark, folder).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(tuple(map(str, r)) for r in out.collect()) == sorted(brute_words(tables.rows()))
    out = suffix_dedup.op8_suffix_array_dedup(spark, folder).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(map(str, r)) for r in out.collect()) == sorted(brute_bytes(tables.rows()))


def test_dedup_returns_the_texts(spark):
    docs = tables.documents(spark)
    out = substring_dedup.dedup(docs).collect()
    assert len(out) == len(tables.rows()) and {r.kept for r in out} == {"b"}  # an input column of that name stays
    for r in out:
        assert len(r.text.split()) == r.n_words - r.n_removed
    for r in suffix_dedup.dedup(docs).collect():
        assert len(r.kept) == r.n_bytes - r.n_removed


def test_empty_table(spark, tmp_dir):
    tables.documents(spark, tmp_dir, data=[])
    assert substring_dedup.op1_substring_dedup(spark, tmp_dir).count() == 0
    assert suffix_dedup.op8_suffix_array_dedup(spark, tmp_dir).count() == 0


def test_long_texts_are_hashed_in_chunks(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_SYMBOLS", 50)
    codec = substring_dedup.Words(5, 2)
    words = [random.Random(1).choice([b"a", b"b", b"c"]) for _ in range(400)]
    anchor, first, count, _ = codec.runs(words)
    assert sorted(i for f, c in zip(first, count, strict=True) for i in range(f, f + c)) == list(range(396))


def test_cover_and_solver():
    assert {(a - b) % 16 for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(16))
    rng = random.Random(4)
    for trial in range(60):
        window = rng.choice([48, 64, 400])
        base = bytes(rng.choice(b"ab") for _ in range(900))
        pieces = list({base[(a := rng.randrange(400)):a + window + rng.randrange(90)] for _ in range(5)} | {b"a" * (window + 30)})
        counts = [rng.choice([1, 1, 2]) for _ in pieces]
        seen = defaultdict(int)
        for p, c in zip(pieces, counts, strict=True):
            for i in range(len(p) - window + 1):
                seen[p[i:i + window]] += c
        for p, got in zip(pieces, suffix_dedup.Bytes(window).solve(pieces, counts), strict=True):
            assert got.tolist() == [seen[p[i:i + window]] > 1 for i in range(len(p) - window + 1)]


def common_prefix(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_suffix_tree_nodes():
    rng = random.Random(11)
    for trial in range(80):
        window = rng.choice([1, 3, 6])
        base = [rng.choice([b"a", b"b"]) for _ in range(60)]
        pieces = list({b" ".join(base[(a := rng.randrange(40)):a + window + rng.randrange(12)]) for _ in range(6)})
        counts = [rng.choice([1, 1, 2]) for _ in pieces]
        suffixes = [(i, j, p.split()[j:]) for i, p in enumerate(pieces) for j in range(len(p.split()) - window + 1)]
        got = substring_dedup.Words(window).solve(pieces, counts)
        for i, j, s in suffixes:
            best = max([common_prefix(s, o) for k, m, o in suffixes if (k, m) != (i, j)] + [len(s) if counts[i] > 1 else 0], default=0)
            assert got[i][j] == (best if best >= window else 0)
        symbols = np.append([rng.randrange(3) for _ in range(40)], 40)
        order, common = substring_dedup.suffix_leaves(symbols, np.arange(40))
        rows = sorted(symbols[i:].tolist() for i in range(40))
        assert [symbols[i:].tolist() for i in order] == rows
        assert common.tolist() == [0] + [common_prefix(a, b) for a, b in zip(rows, rows[1:], strict=False)]
        nodes = {(d, a, b) for a in range(40) for b in range(a + 1, 40) if (d := common_prefix(rows[a], rows[b])) >= window
                 and (a == 0 or common[a] < d) and (b == 39 or common[b + 1] < d)}
        assert set(zip(*(x.tolist() for x in substring_dedup.deep_nodes(common, window)), strict=True)) == nodes


def test_depth_and_clashing_names(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    data = [("x " + passage + " y",), ("z " + passage,), ("n m",), (None,), ("q r s " + passage.replace("w", "v"),)] + [("r " * 50,)] * 2
    docs = spark.createDataFrame(data, "text string").selectExpr("*", *[f"'s' AS {c}" for c in ("_key", "key", "_text", "_in0", "kept", "n")])
    out = {r.n_words: r for r in substring_dedup.dedup(docs).collect()}
    assert {n: r.n_removed for n, r in out.items()} == {42: 40, 41: 40, 2: 0, 0: 0, 43: 0, 50: 50}
    assert 35 <= out[42].deepest <= 40 and out[2].deepest == 0 and out[0].deepest == 0 and out[50].deepest == 50
    assert all(r[c] == "s" for r in out.values() for c in ("_key", "key", "_text", "_in0", "kept", "n"))
    assert all(r["_key"] == r["key"] == r["n"] == "s" for r in suffix_dedup.dedup(docs).collect())


@pytest.mark.parametrize("codec", [substring_dedup.Words(), suffix_dedup.Bytes()])
def test_a_core_in_many_differing_texts_makes_no_large_group(spark, monkeypatch, codec):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 1 << 14)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    passage = " ".join(word() for _ in range(35 if codec.symbol_bytes > 1 else 50))[:397]
    data = [(" ".join(word() for _ in range(40)) + " " + passage + " " + " ".join(word() for _ in range(40)),) for _ in range(300)]
    docs = spark.createDataFrame(data + data[:2], "text string")
    t = repeats.texts(docs, "text")
    runs = repeats._runs(t, codec)
    often = runs.groupBy("anchor").agg((F.count(F.lit(1)) + F.count_if("moves")).alias("n")).where("n > 1")
    marked = runs.join(often.select("anchor", (F.col("n") > codec.hot()).alias("hot")), "anchor").groupBy("key").agg(
        F.collect_list(F.struct("first", "windows", "anchor", "hot")).alias("todo"))
    pieces = repeats._cut(t, repeats._with_deep(t, marked, codec), codec, True)
    sizes = pieces.groupBy("prefix").agg(F.sum(F.length("content")).alias("size"), F.count_distinct("content").alias("n")).collect()
    assert sizes and all(r["size"] < 3 * repeats.CHUNK_BYTES or r["n"] == 1 for r in sizes)
    units = [r[0].encode().split() if codec.symbol_bytes > 1 else r[0].encode() for r in data + data[:2]]
    want = sorted(int(gone.sum()) for _, gone in covered(units, codec.window))
    module = substring_dedup if codec.symbol_bytes > 1 else suffix_dedup
    assert sorted(r.n_removed for r in module.dedup(docs).collect()) == want
