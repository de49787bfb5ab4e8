"""The translation table, decoding without a step loop, and long-form scores."""

import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import parallex.operators.translation as translation
import parallex.session as session
from parallex.config import EOS_ID, SOS_ID
from parallex.operators.decoding import (BigramScorer, NgramScorer, bigram_scores, decode_loop, decode_rows, greedy_decode,
                                         ngram_scores, source_prompts)
from parallex.operators.scoring import log_softmax_long, masked_ce, masked_ce_long, to_long
from parallex.operators.translation import EMPTY_WORD, TranslationScorer, best_translations, links, log_likelihood, translation_table

SCHEMA = "src_ids array<int>, trg_ids array<int>"


def em(pairs, rounds):
    table = None
    for _ in range(rounds):
        shares = defaultdict(float)
        for src, trg in pairs:
            for t in trg:
                weight = {s: n * (1.0 if table is None else table[s, t]) for s, n in Counter([EMPTY_WORD, *src]).items()}
                for s, w in weight.items():
                    shares[s, t] += w / sum(weight.values())
        whole = defaultdict(float)
        for (s, _), c in shares.items():
            whole[s] += c
        table = {k: c / whole[k[0]] for k, c in shares.items()}
    return table


def test_two_pairs_by_hand(spark):
    # "das haus" / "the house", "das" / "the": one round by hand
    df = spark.createDataFrame([([10, 11], [20, 21]), ([10], [20])], SCHEMA)
    got = {(r.s, r.t): r.p for r in translation_table(links(df), 1).collect()}
    # shares: the = 1/3 each of (empty, das, haus) + 1/2 each of (empty, das); house = 1/3 each
    assert got[10, 20] == pytest.approx((1 / 3 + 1 / 2) / (1 / 3 + 1 / 2 + 1 / 3))
    assert got[11, 20] == pytest.approx(0.5) and got[11, 21] == pytest.approx(0.5)
    later = {(r.s, r.t): r.p for r in translation_table(links(df), 12).collect()}
    assert later[10, 20] > 0.9 and later[11, 21] > 0.9


def test_table_equals_plain_python_and_likelihood_never_falls(spark):
    rng = random.Random(2)
    pairs = [([rng.randint(4, 14) for _ in range(rng.randint(0, 9))], [rng.randint(4, 20) for _ in range(rng.randint(0, 9))]) for _ in range(80)]
    pairs += [pairs[0]] * 3
    df = spark.createDataFrame(pairs, SCHEMA)
    got = {(r.s, r.t): r.p for r in translation_table(links(df), 3).collect()}
    want = em(pairs, 3)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    seen = [log_likelihood(links(df), translation_table(links(df), k)) for k in range(1, 6)]
    assert all(b >= a - 1e-9 for a, b in zip(seen, seen[1:], strict=False))


def test_ties_and_empty_corpus(spark):
    table = spark.createDataFrame([(4, 9, 0.5), (4, 7, 0.5), (EMPTY_WORD, 5, 1.0)], "s int, t int, p double")
    assert [tuple(r) for r in best_translations(table).collect()] == [(4, 7)]
    assert translation_table(links(spark.createDataFrame([], SCHEMA))).collect() == []


def test_translation_follows_the_source_and_equals_the_step_loop(spark):
    pairs = [([10, 11], [20, 21]), ([10], [20]), ([12], [22, 22])]
    scorer = TranslationScorer(translation_table(links(spark.createDataFrame(pairs, SCHEMA)), 8))
    best = {r.s: r.t for r in scorer.best.collect()}
    sources = [[10, 11, 12], [], [99, 10], [12] * 9, None]
    enc = spark.createDataFrame([(None if i == 1 else i, s) for i, s in enumerate(sources)], "seq_id long, src_ids array<int>")
    got = {r.seq_id: (r.ids, r.steps) for r in greedy_decode(source_prompts(enc, 8, "seq_id"), scorer, 8).collect()}
    assert got[0] == ([SOS_ID, best[10], best[11], best[12], EOS_ID], 4)
    assert got[None] == ([SOS_ID, EOS_ID], 1) and got[2] == ([SOS_ID, 99, best[10], EOS_ID], 3)  # an unknown token is copied
    assert 3 not in got  # does not fit
    named = enc.where("seq_id IS NOT NULL AND src_ids IS NOT NULL")
    loop = decode_loop(scorer.prepare(source_prompts(named, 8, "seq_id")), scorer, 8)
    assert {r.seq_id: (r.ids, r.steps) for r in loop.collect()} == {k: v for k, v in got.items() if k is not None}


@pytest.mark.parametrize("max_len", [2, 7, 480])
def test_paths_equal_rows_above_the_broadcast_bound(spark, monkeypatch, max_len):
    rng = random.Random(max_len)
    seqs = [(rng.randint(0, 5), [rng.randint(4, 40) for _ in range(rng.randint(0, 12 if max_len < 100 else 90))]) for _ in range(150)]
    enc = spark.createDataFrame(seqs, "src_class int, trg_ids array<int>")
    scorer = BigramScorer(bigram_scores(enc, by=["src_class"]))
    prompts = spark.createDataFrame(
        [(i, [SOS_ID], i % 8) for i in range(60)] + [(90, [], 1), (91, [SOS_ID, EOS_ID], 1), (92, [SOS_ID, 5], None), (93, [SOS_ID, 777], 2),
                                                     (94, None, 1), (None, [SOS_ID], 3), (None, [SOS_ID], 4)],
        "seq_id long, ids array<int>, src_class int")
    rows = sorted(map(str, decode_rows(scorer.prepare(prompts), scorer.row_local(), max_len).where("ids IS NOT NULL").collect()))
    monkeypatch.setattr(session, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(session, "broadcast_limit", lambda row_bytes=1: 0)
    assert scorer.row_local() is None
    paths = greedy_decode(prompts, scorer, max_len)
    assert sorted(map(str, paths.where("ids IS NOT NULL").collect())) == rows
    if max_len == 480:
        assert max(len(r.ids or ()) for r in paths.collect()) > 60


def test_long_scores_equal_array_scores(spark):
    rng = random.Random(9)
    rows = [(i, i % 3, [rng.uniform(-30, 30) for _ in range(50)], rng.choice([0, 0, 7, 49])) for i in range(40)]
    arrays = spark.createDataFrame(rows, "k long, g int, logits array<double>, label int")
    long = to_long(arrays, ["k", "g"])
    for chunk in (1, 8, 1024):
        got = {(r.k, r.token_id): r.log_prob for r in log_softmax_long(long, ["k", "g"], chunk=chunk).collect()}
        for k, _, x, _ in rows:
            lse = max(x) + math.log(sum(math.exp(v - max(x)) for v in x))
            assert all(got[k, i] == pytest.approx(v - lse, abs=1e-9) for i, v in enumerate(x))
        for eps in (0.0, 0.1):
            a = {r.g: (r.loss, r.n_positions) for r in masked_ce(arrays, 0, eps, ["g"]).collect()}
            b = {r.g: (r.loss, r.n_positions) for r in masked_ce_long(long, arrays.select("k", "g", "label"), ["k", "g"], 0, eps, ["g"], chunk=chunk).collect()}
            assert a.keys() == b.keys() and all(a[g] == (pytest.approx(b[g][0], abs=1e-9), b[g][1]) for g in a)
    assert long.where(F.lit(False)).count() == 0 and log_softmax_long(long.where(F.lit(False)), ["k"]).collect() == []


def test_ngram_decoding_equals_plain_python_and_the_step_loop(spark):
    rng = random.Random(12)
    seqs = [[rng.randint(4, 9) for _ in range(rng.randint(0, 14))] for _ in range(60)]
    order = 3
    counts = defaultdict(Counter)
    for s in seqs:
        s = [SOS_ID, *s, EOS_ID]
        for i in range(1, len(s)):
            for k in range(min(order - 1, i) + 1):
                counts[tuple(s[i - k:i])][s[i]] += 1
    best = {c: min(n, key=lambda x: (-n[x], x)) for c, n in counts.items()}

    def decoded(ids):
        ids = list(ids)
        while ids and ids[-1] != EOS_ID and len(ids) < 20:
            ids.append(next(best[c] for k in range(min(order - 1, len(ids)), -1, -1) if (c := tuple(ids[len(ids) - k:])) in best))
        return ids
    scorer = NgramScorer(ngram_scores(spark.createDataFrame([(s,) for s in seqs], "trg_ids array<int>"), order=order), order)
    heads = [[SOS_ID], [SOS_ID, 5], [SOS_ID, 777], [SOS_ID, 777, 6], [], [SOS_ID, EOS_ID]]
    prompts = spark.createDataFrame(list(enumerate(heads)), "seq_id long, ids array<int>")
    want = {i: decoded(h) for i, h in enumerate(heads)}
    assert {r.seq_id: r.ids for r in greedy_decode(prompts, scorer, 20).collect()} == want
    assert {r.seq_id: r.ids for r in decode_loop(prompts, scorer, 20).collect()} == want


def test_table_by_target_token_equals_joins_in_small_runs(spark, monkeypatch):
    rng = random.Random(5)
    pairs = [([rng.randint(4, 30) for _ in range(rng.randint(0, 9))], [rng.randint(4, 9) for _ in range(rng.randint(0, 9))]) for _ in range(60)]
    df = spark.createDataFrame([*pairs, (None, [5]), ([5], None)], SCHEMA)
    linked = links(df)
    assert linked.columns == ["pair", "t", "n_t", "sources"]  # a pair's source tokens are not multiplied into rows
    monkeypatch.setattr(translation, "TASK_LINKS", 64)
    want, got = em(pairs, 3), {(r.s, r.t): r.p for r in translation_table(linked, 3).collect()}
    monkeypatch.setattr(session, "MAX_BROADCAST_BYTES", 0)
    joined = {(r.s, r.t): r.p for r in translation_table(linked, 3).collect()}
    for t in (got, joined):
        assert t.keys() == want.keys() and all(t[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_runs_never_part_a_target_token(monkeypatch):
    monkeypatch.setattr(translation, "RUN_LINKS", 5)
    rows = [(t, n, [EMPTY_WORD, *range(n)]) for n in range(1, 6) for t in (7, 3, 9)]
    batches = [pa.RecordBatch.from_pydict({"t": [r[0] for r in part], "n_t": [r[1] for r in part], "sources": [r[2] for r in part]},
                                          schema=pa.schema({"t": pa.int32(), "n_t": pa.int32(), "sources": pa.list_(pa.int32())}))
               for part in (rows[:4], [], rows[4:])]
    runs = list(translation._runs(iter(batches)))
    assert len(runs) > 1 and all(len(set(a[0]) & set(b[0])) == 0 for a, b in zip(runs, runs[1:], strict=False))
    back = [(t, n, run[2][a:b].tolist()) for run in runs for t, n, a, b in zip(run[0], run[1], run[3], [*run[3][1:], len(run[2])], strict=True)]
    assert sorted(back) == sorted(rows)


def test_few_start_states_walk_without_all_jumps(spark, monkeypatch):
    rng = random.Random(3)
    enc = spark.createDataFrame([(rng.randint(0, 5), [rng.randint(4, 60) for _ in range(rng.randint(0, 30))]) for _ in range(200)],
                                "src_class int, trg_ids array<int>")
    scorer = BigramScorer(bigram_scores(enc, by=["src_class"]))
    prompts = spark.createDataFrame([(i, [SOS_ID] if i % 3 else [SOS_ID, 5], i % 8 if i % 7 else None) for i in range(40)],
                                    "seq_id long, ids array<int>, src_class int")
    rows = sorted(map(str, decode_rows(scorer.prepare(prompts), scorer.row_local(), 50).collect()))
    monkeypatch.setattr(scorer, "jumps", lambda: pytest.fail("the jumps of all states are not needed"))
    assert sorted(map(str, scorer.walk(scorer.prepare(prompts), 50).collect())) == rows
    # in the step loop the states travel to a table that is too large to broadcast, once for all sequences
    monkeypatch.setattr(session, "MAX_BROADCAST_BYTES", 128 * 40)
    assert scorer.best().count() > 40
    step = scorer(scorer.prepare(prompts).select("seq_id", "ids", "src_class"))
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert sorted(map(str, decode_loop(scorer.prepare(prompts), scorer, 50).select("seq_id", "ids", "src_class", "steps").collect())) == rows


@pytest.mark.parametrize("max_len", [3, 20, 100])
def test_ngram_paths_equal_rows_above_the_broadcast_bound(spark, monkeypatch, max_len):
    rng = random.Random(max_len)
    seqs = [[rng.randint(4, 9 + max_len) for _ in range(rng.randint(0, 2 * max_len))] for _ in range(80)]
    counts = ngram_scores(spark.createDataFrame([(s,) for s in seqs], "trg_ids array<int>"), order=4)
    heads = [[SOS_ID, *s[:2]] for s in seqs] + [[SOS_ID], [SOS_ID, 777, 6], [777], [], [SOS_ID, EOS_ID], None]
    prompts = spark.createDataFrame([(None if i == 1 else i, h, "x") for i, h in enumerate(heads)], "seq_id long, ids array<int>, more string")
    for table in (counts, counts.where("size(context) != 3 OR context[0] % 3 != 0")):  # the second lacks contexts that jumps lead to
        scorer = NgramScorer(table, 4)
        monkeypatch.undo()
        want = sorted(map(str, greedy_decode(prompts.where("ids IS NOT NULL"), scorer, max_len).collect()))
        monkeypatch.setattr(scorer, "row_local", lambda: None)
        monkeypatch.setattr("parallex.operators.decoding.decode_loop", lambda *a, **k: pytest.fail("one job per step"))
        got = greedy_decode(prompts, scorer, max_len).where("ids IS NOT NULL")
        assert sorted(map(str, got.collect())) == want
