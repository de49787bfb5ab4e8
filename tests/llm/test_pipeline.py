import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import tables  # noqa: E402
import test_simhash  # noqa: E402

import corpus_pipeline  # noqa: E402
from parallex.llm import decontaminate, mixing, quality_rules  # noqa: E402

ITEM = "one two three four five six seven eight nine ten eleven"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    data = tables.rows() + [(2000 + i, f"{t} {ITEM}", "en", "src1", 1, *tables.CLASH) for i, t in enumerate(tables.texts(9)[:5])]
    tables.documents(spark, path, data=data)
    tables.benchmark(spark, path, [(1, ITEM)])
    return path


def brute(data):
    """What quality rules, near-dedup and decontamination keep, as row multiset."""
    kept = []
    for r in data:
        m = quality_rules.Measures((r[1] or "").encode())
        if not any(rule.rejects(m) for rule in quality_rules.RULES):
            kept.append(r)
    fps = [test_simhash.brute_fp(r[1]) for r in kept]
    root = list(range(len(kept)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(kept)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(kept):
        key = (r[0] is None, r[0] or 0)
        if find(i) not in best or key < best[find(i)][0]:
            best[find(i)] = (key, r)
    machine = decontaminate.Automaton([("1", ITEM.encode())])
    return [r for _, r in best.values() if not machine.scan((r[1] or "").encode())[1]]


def test_stages_one_by_one(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "sharding"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    want = brute([tuple(r) for r in docs.collect()])
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert Counter(tuple(r) for r in docs.collect()) == Counter(want)
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, folder)
    assert mixed.columns == columns
    times = Counter(tuple(r) for r in mixed.collect())
    assert set(times) == set(want) and max(times.values()) <= 1 + mixing.MAX_REPEATS


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    sizes = Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(16)) <= 1
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(n)) for s, n in sizes.items())
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert {r.doc_id for r in out} == {r[0] for r in brute(docs)}


def test_run_on_an_empty_table(spark, tmp_dir):
    tables.documents(spark, tmp_dir, data=[])
    tables.benchmark(spark, tmp_dir, [(1, ITEM)])
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
