import itertools
import random

import pytest
import xxhash

from parallex.llm import simhash

SCHEMA = "doc_id long, text string, fp string, extra int"


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, radius=3):
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted((str(d), f"{fps[i]:016x}", str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def fixture():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "only one"), (5, "a"), (6, "A"), (7, "é b c d"), (7, "é b c d")]
    for d in range(10, 40):
        base = [rng.choice(vocab) for _ in range(rng.choice((5, 60, 400)))]
        rows.append((d, " ".join(base)))
        for k in range(3):
            near = list(base)
            near[rng.randrange(len(near))] = "changed"
            rows.append((1000 * d + k, "  ".join(near)))
    rows.append((None, rows[-1][1]))
    rows.append((9999, " ".join(rng.choice(vocab) for _ in range(40_000))))
    return rows


def op9(spark, rows, tmp_dir):
    spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    return simhash.op9_simhash(spark, tmp_dir)


def test_every_pair_within_the_radius_shares_a_table():
    masks = simhash.covering((1 << 64) - 1, 3)
    for flip in itertools.combinations(range(64), 3):
        bits = sum(1 << i for i in flip)
        assert any(not m & bits for m in masks)
    few = 0b1011_0001_0110  # holds over a subset of positions as well
    for flip in itertools.combinations([i for i in range(12) if few >> i & 1], 3):
        assert any(not m & sum(1 << i for i in flip) for m in simhash.covering(few, 3))


def test_equals_brute_force(spark, tmp_dir):
    rows = fixture()
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in op9(spark, rows, tmp_dir).collect())
    assert got == brute_components(rows)


@pytest.mark.parametrize("max_bucket", [12, 2048])
def test_large_buckets_are_split_without_loss(spark, max_bucket):
    rng = random.Random(5)
    centre = [rng.getrandbits(64) for _ in range(4)]
    fps = sorted({c ^ sum(1 << rng.randrange(64) for _ in range(2)) & (1 << 64) - 1 for c in centre for _ in range(12)})
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    found = {(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(df, 3, max_bucket).collect()}
    assert all((a ^ b) for a, b in found)

    def groups(pairs):
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in pairs:
            root[find(a)] = find(b)
        return {frozenset(g for g in fps if find(g) == find(f)) for f in fps}
    true = [(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 3]
    assert groups(found) == groups(true)


def test_empty_table(spark, tmp_dir):
    got = op9(spark, [], tmp_dir)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == 0


def test_stage_keeps_one_of_each_group(spark):
    rows = [(r[0], r[1], "x", 1) for r in fixture()]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = simhash.stage(spark, docs, "").collect()
    comps = {c for _, _, c in brute_components([r[:2] for r in rows])}
    assert sorted(str(r.doc_id) for r in kept) == sorted(comps)
    assert kept[0].fp == "x"
