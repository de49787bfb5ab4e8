"""Quality rules, line dedup, sharding and mixing."""

import math
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import tables  # noqa: E402

from parallex.llm import line_dedup, mixing, quality_rules, sharding  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    tables.documents(spark, path)
    return path


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    tables.documents(spark, path, data=[])
    return path


# ---- quality rules -------------------------------------------------------------

def test_quality_equals_sql(spark, folder):
    assert tables.result(quality_rules.op4_quality_rules(spark, folder)) == tables.sql(folder, quality_rules.ORACLE)


def test_quality_order_is_by_rejection_per_cost_and_does_not_matter(spark, folder):
    rules = list(quality_rules.RULES)
    costs = {r.name: (0.01 * (i + 1), 0.1) for i, r in enumerate(rules)}
    costs[rules[3].name] = (0.01, 0.9)
    ordered = quality_rules.order_rules(rules, costs)
    assert ordered[0] is rules[3] and ordered[1] is rules[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    a = quality_rules.verdict(docs, rules).select("doc_id", "text", "kept")
    b = quality_rules.verdict(docs, rules[::-1]).select("doc_id", "text", "kept")
    assert tables.result(a) == tables.result(b)
    assert quality_rules.verdict(docs).columns[-2:] == ["kept", "failed_rule"]  # the clashing column is replaced


def test_quality_of_an_empty_table(spark, empty):
    assert quality_rules.op4_quality_rules(spark, empty).count() == 0


# ---- line dedup ----------------------------------------------------------------

def test_lines_equal_sql(spark, folder):
    got = tables.result(line_dedup.op2_line_dedup(spark, folder))
    assert got == tables.sql(folder, line_dedup.ORACLE)
    assert any(int(r[3]) for r in got[1])  # "footer line" is on nine sites


@pytest.mark.parametrize("min_sites", [2, 5, 9, 10])
def test_threshold_is_exact(spark, min_sites):
    data = [(i, f"l{k}\nown {i} {k}", f"s{i}") for k in range(1, 11) for i in range(k)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = line_dedup.remove_boilerplate(docs, min_sites=min_sites).collect()
    for r in out:
        k = int(r.text.split(" ")[-1])
        assert r.n_lines == 2 and (r.n_removed == 1) == (k >= min_sites)
        assert r.text.startswith("own") == (k >= min_sites)


def test_lines_leave_other_columns_alone(spark):
    names = ("_lines", "lines", "key", "gone", "_key", "_in0")
    docs = spark.createDataFrame([(1, "a\nb", "s"), (2, None, None)], "doc_id long, text string, source string").selectExpr(
        "*", *[f"'x' AS {c}" for c in names])
    out = line_dedup.remove_boilerplate(docs).collect()
    assert out[0].asDict().keys() == {*docs.columns, "n_lines", "n_removed"}
    assert all(r[c] == "x" for r in out for c in names) and {r.text for r in out} == {"a\nb", None}


def test_lines_of_an_empty_table(spark, empty):
    assert line_dedup.op2_line_dedup(spark, empty).count() == 0


# ---- sharding ------------------------------------------------------------------

def check_shards(out, n, shards=16):
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    sizes = [len(by[s]) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards_hold_every_row_in_exact_sizes(spark, folder):
    out = sharding.op3_sharding(spark, folder).collect()
    check_shards(out, len(tables.rows()))
    want = Counter((r[0], len((r[1] or "").encode()) + 1, __import__("zlib").crc32((r[1] or "").encode())) for r in tables.rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    assert {(r.law, r.grown_shard) for r in out} == {("rows", None)}


def test_buckets_keep_slots_gapless(spark):
    rows = spark.range(1000, numPartitions=7)
    out = sharding.shuffle(rows, 3, 9, bucket_rows=10).collect()
    check_shards(out, 1000, 3)
    first = [r.id for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    again = [r.id for r in sorted(sharding.shuffle(rows, 3, 9, bucket_rows=10).collect(), key=lambda r: (r.shard, r.slot))]
    assert first == again and first != sorted(first)


def test_hypergeometric_law():
    rng = np.random.default_rng(1)
    good, bad, n, draws = 7, 12, 9, 20_000
    seen = Counter(sharding.hypergeometric(rng, good, bad, n) for _ in range(draws))
    for k in range(8):
        p = math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n)
        assert abs(seen[k] / draws - p) < 0.015
    big = [sharding.hypergeometric(rng, 2 * 10**9, 30 * 10**9, 40_000) for _ in range(200)]
    assert abs(np.mean(big) - 2500) < 15 and sharding.hypergeometric(rng, 5, 0, 3) == 3 and sharding.hypergeometric(rng, 0, 5, 3) == 0
    m = sharding.matrix([5, 0, 11, 4], [7, 7, 6], 3)
    assert [sum(r) for r in m] == [5, 0, 11, 4] and [sum(c) for c in zip(*m, strict=True)] == [7, 7, 6]


def test_shards_of_an_empty_table(spark, empty):
    assert sharding.op3_sharding(spark, empty).count() == 0


# ---- mixing --------------------------------------------------------------------

def test_passes_and_budgets(spark, folder):
    out = mixing.op5_mixing(spark, folder).collect()
    tokens, docs = Counter(), Counter()
    for r in tables.rows():
        n = len((r[1] or "").encode().split()) + 1
        tokens[r[3]] += n
        docs[r[3]] += 1
    top = max(tokens.values())
    read = defaultdict(lambda: defaultdict(list))
    for r in out:
        read[r.source][r.epoch].append(r.n_tokens)
    assert set(read) == set(tokens)  # a NULL source too
    weights = {r.source: r.weight for r in out}
    assert abs(sum(weights.values()) - 1) < 1e-6
    for s, t in tokens.items():
        budget = round(top * weights[s] / max(weights.values()))
        assert abs(budget - top * weights[s] / max(weights.values())) <= 1 and budget <= mixing.MAX_REPEATS * t + 1
        full = [e for e in read[s] if len(read[s][e]) == docs[s]]
        assert full[:1] == [0]
        part = sum(sum(v) for e, v in read[s].items() if e not in full)
        longest = max(len((r[1] or "").encode().split()) + 1 for r in tables.rows() if r[3] == s)
        assert -2 <= sum(sum(v) for v in read[s].values()) - budget <= longest and part <= t


def test_blocks_are_cut_within(spark):
    data = [(i, "a b c", "big" if i < 400 else "small") for i in range(440)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = mixing.mix(docs, max_repeats=3.5, block_tokens=40).collect()
    n = Counter((r.source, r.epoch) for r in out)
    assert n[("big", 0)] == 400 and [n[("small", e)] for e in range(5)] == [40, 40, 40, 20, 0]
    order = [r.doc_id for r in sorted((r for r in out if r.source == "big"), key=lambda r: (r.block_rank, r.position))]
    assert order != sorted(order) and len({(r.block_rank, r.position) for r in out if r.source == "big"}) == 400


@pytest.mark.parametrize("target", [0.6, 0.9, 1.0])
def test_target_entropy(spark, target):
    docs = spark.createDataFrame([(i, "w " * 9, "big" if i < 90 else "small") for i in range(100)],
                                 "doc_id long, text string, source string")
    out = mixing.mix(docs, target_entropy=target, max_repeats=None).collect()
    w = {r.source: r.weight for r in out}
    assert abs(-sum(x * math.log2(x) for x in w.values()) - target) < 1e-6


def test_mix_of_an_empty_table(spark, empty):
    assert mixing.op5_mixing(spark, empty).count() == 0


def _hash(*values):
    """Spark's xxhash64 of longs, ints (tagged) and strings."""
    import struct

    import xxhash
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
        h = xxhash.xxh64(raw, seed=h & (2 ** 64 - 1)).intdigest()
    return h - 2 ** 64 if h >= 2 ** 63 else h


def brute_draw(rows, repeats, place, per_block, seed):
    """Exponent by a plain bisection, then every read of every row."""
    tokens = Counter()
    for _, s, t in rows:
        tokens[s] += t
    total, top = sum(tokens.values()), max(tokens.values())
    share = {s: n / total for s, n in tokens.items()}

    def weights(a):
        z = sum(x ** a for x in share.values())
        return {s: x ** a / z for s, x in share.items()}

    def bits(w):
        return -sum(x * math.log2(x) for x in w.values())
    target = bits(share) + place * (math.log2(len(share)) - bits(share))

    def meets(a):
        w = weights(a)
        return bits(w) <= target and max(w[s] / max(w.values()) * top / tokens[s] for s in w) <= repeats
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if meets(mid) else (mid, high)
    w, out = weights(high), []
    for s, n in tokens.items():
        budget = round(top * w[s] / max(w.values()))
        blocks = {}
        for rid, _, t in (r for r in rows if r[1] == s):
            blocks.setdefault(_hash(rid, (seed,)) % -(-n // per_block), []).append((rid, t))
        for epoch in range(budget // n + 1):
            at = 0
            order = sorted(blocks, key=lambda b: (_hash(s, b, epoch, (seed + 1,)), b))
            for rank, b in enumerate(order):
                if epoch == budget // n and at >= budget % n:
                    break
                here = at
                for place_, (rid, t) in enumerate(sorted(blocks[b], key=lambda x: (_hash(x[0], epoch, (seed + 2,)), x[0]))):
                    if epoch < budget // n or here < budget % n:
                        out.append((rid, s, epoch, rank, place_))
                    here += t
                at = here
    return high, w, out


@pytest.mark.parametrize("repeats,place", [(50.0, 0.5), (50.0, 0.9), (2.0, 0.5), (3.3, 0.1)])
def test_weights_and_drawn_rows_equal_brute_force(spark, repeats, place):
    rng = random.Random(int(repeats * 10 + place * 7))
    rows = [(i * 7, f"={'abcdef'[min(int(rng.expovariate(0.8)), 5)]}", rng.randint(1, 30)) for i in range(300)]
    df = spark.createDataFrame(rows, "_rid long, _s string, _t long")
    a, w, want = brute_draw(rows, repeats, place, 200, 50)
    assert mixing.exponent(mixing.source_tokens(df), repeats, entropy_place=place) == pytest.approx(a, abs=1e-8) and 0 < a < 1
    got = mixing.draw(df, repeats, block_tokens=200, entropy_place=place).collect()
    assert all(r.weight == pytest.approx(w[r._s], abs=1e-7) for r in got)
    assert sorted((r._rid, r._s, r.epoch, r.block_rank, r.position) for r in got) == sorted(want)


def test_the_registered_target_binds(spark, folder):
    rows = mixing.op5_mixing(spark, folder).select("source", "weight").distinct().collect()
    assert len({r.weight for r in rows}) > 1


def test_internal_names_of_the_input_stay(spark):
    docs = spark.createDataFrame([(i, "a b", "s", "r", "t", "k") for i in range(5)], "doc_id long, text string, source string, _rid string, _s string, _t string")
    for out in (mixing.mix(docs, max_repeats=None), sharding.shuffle(docs)):
        assert out.columns[:6] == docs.columns and {(r["_rid"], r["_s"], r["_t"]) for r in out.collect()} == {("r", "t", "k")}
