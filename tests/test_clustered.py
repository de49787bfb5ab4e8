"""Stored corpora in id order: positions, and lookups that read few files."""

import pytest

from parallex.sources.clustered import file_index, pairs_at, pairs_of, with_positions, write_clustered

SCHEMA = "pair_id long, src_text string, trg_text string"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('corpus')}/c"
    rows = [(i * 3, f"s{i}", None if i % 7 == 0 else f"t{i}") for i in range(400)]
    rows += [(None, "no id", "x")] * 3 + [(600, f"hot {k}", "h") for k in range(200)]
    write_clustered(spark.createDataFrame(rows[::-1], SCHEMA), path, files=8)
    return path, rows


def test_positions_are_gapless_and_in_id_order(spark, store):
    path, rows = store
    got = sorted(tuple(r) for r in with_positions(spark, path).collect())
    assert [r[0] for r in got] == list(range(len(rows)))
    assert [r[1] for r in got] == [None] * 3 + sorted(r[0] for r in rows if r[0] is not None)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((r[1:] for r in got), key=key) == sorted(rows, key=key)
    # the hot id is spread: no file holds much more than its share
    assert max(r["n_rows"] for r in file_index(spark, path).collect()) < len(rows) / 3


def test_lookup_reads_only_the_files_it_needs(spark, store):
    path, rows = store
    every = {r["position"]: tuple(r) for r in with_positions(spark, path).collect()}
    n_files = file_index(spark, path).count()
    one = pairs_at(spark, path, [17])
    assert [tuple(r) for r in one.collect()] == [every[17]]
    data_files = lambda df: {f for f in df.inputFiles() if "/data/" in f}
    assert len(data_files(one)) == 1 < n_files
    two = pairs_at(spark, path, [len(rows) - 1, 0, 0, len(rows), -1])
    assert sorted(map(tuple, two.collect()), key=lambda r: r[0]) == [every[0], every[len(rows) - 1]]
    assert len(data_files(two)) == 2
    got = pairs_of(spark, path, [300, 301])
    assert [r["src_text"] for r in got.collect()] == ["s100"] and len(data_files(got)) == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(pair_id" in plan
    hot = pairs_of(spark, path, [600])
    assert hot.count() == 201 and len(data_files(hot)) > 1
    assert pairs_of(spark, path, [-5]).count() == 0 and pairs_at(spark, path, []).count() == 0


def test_empty_corpus(spark, tmp_dir):
    write_clustered(spark.createDataFrame([], SCHEMA), f"{tmp_dir}/none")
    assert with_positions(spark, f"{tmp_dir}/none").count() == 0
    assert pairs_at(spark, f"{tmp_dir}/none", [0]).count() == 0 and pairs_of(spark, f"{tmp_dir}/none", [0]).count() == 0
