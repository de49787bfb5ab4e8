import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import tables  # noqa: E402

from parallex.llm import decontaminate  # noqa: E402

ITEMS = [(1, "What is the Answer, to: one two three four five six seven?"), (2, "short Item"), (3, None), (4, "... !!"),
         (5, "what is the answer to one two three four five six seven"), (5, "what is the answer to one two three four five six seven"),
         (None, "tainted without any id at all so it is long enough"), (7, "über äpfel 日本 x" + " y" * 20)]
HITS = [(1000, "Well: WHAT is the answer -- to one TWO three, four. Five six seven eight?"), (1001, "no short-item here, or: a short, ITEM!"),
        (1002, "what is the answer to one two three"), (1003, "tainted without any id at all so it is long enough"),
        (1004, "Ü äpfel über äpfel 日本 x y y y y y y y"), (1005, "shortitem"), (1006, "short item " * 500)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    tables.documents(spark, path, data=tables.rows() + [(i, t, "en", "s", 1, *tables.CLASH) for i, t in HITS])
    tables.benchmark(spark, path, ITEMS)
    return path


def test_equals_sql(spark, folder):
    got = tables.result(decontaminate.op10_decontaminate(spark, folder))
    # SQL lists a NULL item id nowhere either: list() of distinct ids skips it
    want = tables.sql(folder, decontaminate.ORACLE.replace("list(DISTINCT item_id)", "list(DISTINCT item_id) FILTER (item_id IS NOT NULL)"),
                      ("documents", "benchmark"))
    assert got == want
    assert sum(r[0] == "True" for r in got[1]) == 5


def test_blocks_find_the_same(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    cols = ["doc_id", "n_words", "n_hit", "items", "contaminated"]
    one = decontaminate.hits(docs, items).select(*cols)
    assert len(list(decontaminate.blocks(items, block_bytes=40))) > 3
    assert tables.result(one) == tables.result(decontaminate.hits(docs, items, block_bytes=40).select(*cols))


def test_offsets_are_those_of_the_original(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id between 1000 and 1004")
    got = {r.doc_id: [r.text[s.start:s.end] for s in r.spans] for r in
           decontaminate.hits(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    assert got == {1000: ["WHAT is the answer -- to one TWO three, four. Five six seven"], 1001: ["short-item", "short, ITEM"], 1002: [],
                   1003: ["tainted without any id at all so it is long enough"], 1004: ["über äpfel 日本 x y y y y y y y"]}


def test_stage_drops_only_contaminated_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = decontaminate.stage(spark, docs, folder)
    assert out.columns == docs.columns and out.count() == docs.count() - 5


def test_empty_tables(spark, tmp_dir):
    tables.documents(spark, tmp_dir, data=[])
    tables.benchmark(spark, tmp_dir, [])
    assert decontaminate.op10_decontaminate(spark, tmp_dir).count() == 0
    docs = tables.documents(spark)
    none = decontaminate.hits(docs, spark.read.parquet(f"{tmp_dir}/benchmark.parquet"))
    assert none.where("contaminated").count() == 0 and none.count() == len(tables.rows())


def _plain(items, text, window):
    words = decontaminate.normalised(text).split()
    hit, ids = set(), set()
    for i, item in items:
        for w in decontaminate.windows(item, window):
            at = [p for p in range(len(words) - len(w) + 1) if tuple(words[p:p + len(w)]) == w]
            hit |= {x for p in at for x in range(p, p + len(w))}
            ids |= {i} if at and i is not None else set()
    return len(words), hit, sorted(ids)


@pytest.mark.parametrize("window", [1, 2, 10])
def test_windows_of_the_same_symbols_are_told_apart(window):
    rng = random.Random(window)
    vocab = [b"w%d" % k for k in range(200)]
    draw = lambda n: b" ".join(rng.choices(vocab + vocab[:5] * 30, k=n))
    items = [(rng.choice([None, "a", "b", "c"]), draw(rng.randint(0, 14))) for _ in range(80)] + [("d", b""), ("e", None), (None, b"w1 w1")] * 2
    machine = decontaminate.Automaton(items, window)
    # a node of the automaton is searched edge by edge: few symbols, however many words
    assert len(machine.symbol) > 3 * len(set(machine.symbol.values()))
    for text in [None, b"", b"zz", vocab[0] + b" zz " + vocab[199], *[draw(40) + b" zz " + (items[k][1] or b"") + b", " + draw(30) for k in range(40)]]:
        n, runs, spans, ids = machine.scan(text)
        assert (n, {x for a, b in runs for x in range(a, b)}, ids) == _plain(items, text, window)
        assert [len(decontaminate.normalised(text[a:b]).split()) for a, b in spans] == [b - a for a, b in runs]
