"""Nothing is dropped, merged or repeated: long pairs, high turns, NULL and
repeated keys, missing predictions, several runs, hot keys."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import parallex.session as session
from parallex.config import Options
from parallex.jobs import evaluate, log_losses, prepare, read_prepared, training_batches, validate
from parallex.operators import curves
from parallex.operators.decoding import BigramScorer, bigram_scores, greedy_decode, row_local
from parallex.operators.edits import bit_edits
from parallex.operators.encode import decode, encode, encode_sides
from parallex.operators.examples import build_examples
from parallex.operators.lookup import lookup_join
from parallex.operators.metrics import char_error_rate, with_char_edits, with_word_edits
from parallex.operators.sampling import epoch_schedule, first_shuffled, shuffle_rank
from parallex.operators.vocab import build_vocab
from parallex.plans import queries
from parallex.sources import runlog
from parallex.sources.corpus import conversation_pairs, read_pairs

SIDES = {"src_ids": "src_text", "trg_ids": "trg_text"}


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Conversations with a 481-word reply and turns beyond 1000."""
    path = str(tmp_path_factory.mktemp("conv"))
    rows = [(1, 0, "user", "a b"), (1, 1, "assistant", "w " * 481), (1, 1000, "user", "c"), (1, 1001, "assistant", "d e"),
            (2, 0, "user", "q " * 600), (2, 1, "assistant", "r"), (2, 2, "user", "a"), (2, 3, "assistant", "d")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1).write.parquet(f"{path}/conversations.parquet")
    return path


def test_long_pairs_and_high_turns_are_visible(spark, awkward):
    pairs = conversation_pairs(spark.read.parquet(f"{awkward}/conversations.parquet")).collect()
    assert len({r.pair_id for r in pairs}) == 4
    ex = queries.q_examples(spark, awkward).collect()
    assert sorted(str(r.reason) for r in ex) == ["None", "None", "src_too_long", "trg_too_long"]
    assert all((r.encoder_input is None) == (r.reason is not None) for r in ex)
    out = queries.q_greedy_decode(spark, awkward).collect()
    assert sorted((str(r.reason), r.ids is None) for r in out) == [("None", False), ("None", False), ("src_too_long", True), ("trg_too_long", True)]
    assert queries.q_validation_metrics(spark, awkward).count() == 1


def test_null_and_repeated_keys_keep_their_text(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c"), (None, "b c"), (2, None), (3, "")], "pair_id long, text string")
    v = build_vocab(df, "text")
    e = encode(df, {"ids": "text"}, v)
    back = decode(e, {"back": "ids"}, v)
    assert back.columns == ["pair_id", "text", "ids", "back"]
    assert sorted((str(r.pair_id), str(r.text), r.back) for r in back.collect()) == [
        ("1", "a b", "a b"), ("1", "c", "c"), ("2", "None", ""), ("3", "", ""), ("None", "b c", "b c")]


def test_prepare_keeps_rows_without_id(spark, tmp_dir):
    p = spark.createDataFrame([(i if i % 4 else None, f"s{i}", "t " * (i + 1)) for i in range(20)], "pair_id long, src_text string, trg_text string")
    prepare(spark, p, tmp_dir, Options(seq_len=12), shared_vocab=False)
    kept, rejected = read_prepared(spark, tmp_dir), read_prepared(spark, tmp_dir, status="rejected")
    assert kept.count() + rejected.count() == 20 and kept.where("pair_id is null").count() + rejected.where("pair_id is null").count() == 5
    assert {r.reason for r in rejected.collect()} == {"trg_too_long"}
    assert spark.read.parquet(f"{tmp_dir}/vocab_src").count() == 24 and spark.read.parquet(f"{tmp_dir}/vocab_trg").count() == 5


def test_grouped_vocabulary(spark):
    df = spark.createDataFrame([("en", "a b a"), ("fr", "b c"), ("fr", "b")], "lang string, text string")
    v = build_vocab(df, "text", by=["lang"])
    with pytest.raises(ValueError):
        encode(df, {"ids": "text"}, v)
    got = sorted((r.lang, tuple(r.ids)) for r in encode(df, {"ids": "text"}, v, by=["lang"]).collect())
    assert got == [("en", (4, 5, 4)), ("fr", (4,)), ("fr", (4, 5))]
    with pytest.raises(ValueError):
        encode(df, {"ids": "text"}, v.drop("lang"))  # a token with two rows


def test_input_is_evaluated_and_shuffled_once(spark, tmp_dir):
    spark.range(50).select(F.col("id").alias("pair_id"), F.lit("a b").alias("src_text"), F.lit("c").alias("trg_text")).write.parquet(f"{tmp_dir}/p")
    p = spark.read.parquet(f"{tmp_dir}/p")
    v = spark.read.parquet(_written(build_vocab(p, "src_text"), f"{tmp_dir}/v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = encode_sides(p, SIDES, {"src_ids": v, "trg_ids": v})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("src_text#") and plan.count("FileScan parquet [pair_id") == 1
    assert plan.count("Exchange hashpartitioning(_rid") == 1


def _written(df, path):
    df.write.parquet(path)
    return path


def test_salts_spread_the_start_token(spark, monkeypatch):
    """Rows per salt of a token that opens every sequence."""
    df = spark.createDataFrame([(i, [2, 5 + i % 3]) for i in range(4000)], "pair_id long, ids array<int>")
    v = build_vocab(spark.createDataFrame([("x y z",)], "text string"))
    seen = {}
    monkeypatch.setattr(session, "MAX_BROADCAST_BYTES", 1)

    def spy(big, key, small, small_key, how="left", small_rows=None, row_bytes=128, salt_source=None, partitions=None):
        for r in big.where(key == 2).groupBy(F.pmod(salt_source, F.lit(6)).alias("s")).count().collect():
            seen[r.s] = r["count"]
        return lookup_join(big, key, small, small_key, how, small_rows, row_bytes, salt_source, partitions)
    monkeypatch.setattr("parallex.operators.encode.lookup_join", spy)
    out = decode(df, {"t": "ids"}, v)
    assert out.where("t like '[SOS]%'").count() == 4000
    assert len(seen) == 6 and max(seen.values()) < 1.3 * 4000 / 6


def test_missing_predictions_count(spark, tmp_dir):
    ev = spark.createDataFrame([(1, "abcd", "abcd"), (2, None, "wxyz")], "pair_id long, predicted string, expected string")
    assert char_error_rate(ev).first()["cer"] == 0.5
    got = evaluate(ev, metric_log=f"{tmp_dir}/log").first()
    assert got["cer"] == 0.5 and got["wer"] == 0.5
    evaluate(ev.limit(0), metric_log=f"{tmp_dir}/none")  # no rate, but an entry
    assert [r.value for r in runlog.read_metrics(spark, f"{tmp_dir}/none").where("tag like '%cer'").collect()] == [None]


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_long_pairs_go_by_blocks(spark):
    rng = random.Random(6)
    pairs = [(" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))), " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))))
             for _ in range(25)]
    pairs += [(None, "a " * 30), ("a " * 30, ""), ("", None), pairs[0], pairs[0], ("日本 語 " * 9, "語 日本 " * 8)]
    ev = spark.createDataFrame([(*p, "x") for p in pairs], "p string, e string, _most string").repartition(3)
    got = with_word_edits(ev, "p", "e", "d", "n", block=7).collect()
    want = [(p, e, _distance((p or "").split(), (e or "").split()), len((e or "").split())) for p, e in pairs]
    assert sorted(map(str, ((r.p, r.e, r.d, r.n) for r in got))) == sorted(map(str, want))
    got = with_char_edits(ev, "p", "e", "d", block=9).collect()
    assert sorted(str((r.p, r.e, r.d)) for r in got) == sorted(str((p, e, _distance(p or "", e or ""))) for p, e in pairs)


def test_a_pair_of_20000_words(spark):
    rng = np.random.default_rng(8)
    a = rng.integers(0, 30_000, 20_000)
    b = np.concatenate([a[:5000], rng.integers(0, 30_000, 400), a[5600:]])  # 600 words replaced by 400
    b[::50] = 30_001
    df = spark.createDataFrame([(" ".join(map(str, a)), " ".join(map(str, b))), ("x y", "x z")], "p string, e string")
    row, step = np.arange(len(b) + 1), np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (b != x))])
        row = np.minimum.accumulate(new - step) + step
    assert sorted(r.d for r in with_word_edits(df, "p", "e", "d").collect()) == [1, int(row[-1])]


def test_document_edits_query(spark, tmp_path):
    texts = ["a b c", "a c", None, "", "b " * 5000, "b " * 4990 + "c"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.word_edits, r.n_words) for r in queries.q_document_edits(spark, str(tmp_path)).collect()}
    assert got == {0: (1, 3), 1: (2, 2), 2: (0, 0), 3: (5000, 0), 4: (10, 5000)}


def test_runs_are_kept_apart_and_last_is_by_time(spark):
    rows = [(r, "train loss", s, 10.0 * (r == "b") + s, f"2024-01-01 00:00:0{s}") for r in "ab" for s in range(3)]
    rows += [("a", "train loss", 1, -5.0, "2024-01-01 00:00:09")]
    log = spark.createDataFrame(rows, "run string, tag string, step long, value double, ts string").withColumn("ts", F.to_timestamp("ts"))
    got = [(r.run, r.step, r.value) for r in curves.train_curve(log).collect()]
    assert got == [("a", 0, 0.0), ("a", 1, -5.0), ("a", 2, 2.0), ("b", 0, 10.0), ("b", 1, 11.0), ("b", 2, 12.0)]
    assert runlog.metric_summary(log).count() == 2
    with pytest.raises(ValueError):
        curves.train_curve(log.drop("ts"))


def test_artifact_faults(spark, tmp_dir):
    recs = runlog.artifact_records(spark.createDataFrame([("r", 7, 70), ("r", 7, 75)], "run string, epoch int, global_step long"))
    named = runlog.latest_artifact(recs, "7")
    assert [(r.initial_epoch, r.global_step) for r in runlog.resume_point(recs, named).collect()] == [(8, 75)]
    for name in ("tmodel_best.pt", "tmodel_03.pt"):
        with open(f"{tmp_dir}/{name}", "wb") as fh:
            fh.write(b"x")
    files = runlog.artifacts_from_files(spark, tmp_dir)
    assert [r.epoch for r in files.collect()] == [3]
    with pytest.raises(Exception, match="global_step"):
        runlog.resume_point(files, runlog.latest_artifact(files)).collect()
    stepped = runlog.with_steps(files, 100)
    assert [(r.initial_epoch, r.global_step) for r in runlog.resume_point(stepped, runlog.latest_artifact(stepped)).collect()] == [(4, 400)]


def test_empty_prompts_and_row_local_scorers(spark):
    prompts = spark.createDataFrame([(1, []), (2, [2]), (3, [2, 3])], "seq_id long, ids array<int>")
    sc = BigramScorer(spark.createDataFrame([(2, 5, 1.0), (5, 3, 1.0)], "prev_id int, next_id int, score double"))
    want = {1: [], 2: [2, 5, 3], 3: [2, 3]}
    assert {r.seq_id: r.ids for r in greedy_decode(prompts, sc, 9).collect()} == want
    assert {r.seq_id: r.ids for r in greedy_decode(prompts, lambda f: sc(sc.prepare(f)), 9).collect()} == want
    counting = row_local(lambda ids: len(ids) + 10)
    assert {r.seq_id: r.ids for r in greedy_decode(prompts, counting, 4).collect()}[2] == [2, 11, 12, 13]


def test_translations_depend_on_the_source(spark):
    from tests.conftest import SF001
    out = queries.q_translate_batch(spark, SF001).where("predicted is not null")
    assert out.select("predicted").distinct().count() > 10


def test_training_batches(spark):
    enc = spark.createDataFrame([(i, "s", "t", [4, 5], [6] * (i % 3)) for i in range(7)],
                                "pair_id long, src_text string, trg_text string, src_ids array<int>, trg_ids array<int>")
    sched = epoch_schedule(enc.select("pair_id"), ["pair_id"], 1, 3, 0, 2)
    got = training_batches(enc, sched, 6, key="pair_id").collect()
    assert len(got) == 6 and sorted(r.global_step for r in got) == list(range(6))
    ex = {r.pair_id: r for r in build_examples(enc, 6).collect()}
    for r in got:
        assert r.label == [ex[p].label for p in r.pair_id] and r.encoder_input == [ex[p].encoder_input for p in r.pair_id]


def test_batches_and_validation_keep_null_and_repeated_ids(spark, tmp_dir):
    rows = [(None, "a b", "c")] * 2 + [(None, "x", "y")] + [(7, "a b", "c d")] * 4 + [(i, f"w{i} b", "c") for i in range(10, 23)]
    p = spark.createDataFrame(rows, "pair_id long, src_text string, trg_text string")
    opts = Options(seq_len=8, num_epochs=2)
    prepare(spark, p, tmp_dir, opts)
    train = read_prepared(spark, tmp_dir, "train").collect()
    assert len(train) == 18
    got = training_batches(read_prepared(spark, tmp_dir, "train"), spark.read.parquet(f"{tmp_dir}/schedule"), 8).collect()
    assert len(got) == 2 * 3 and all(len(r.pair_id) == len(r.label) == 6 for r in got)
    for epoch in range(2):
        ids = sorted(str(i) for r in got if r.epoch == epoch for i in r.pair_id)
        assert ids == sorted(str(r.pair_id) for r in train)
    v = spark.read.parquet(f"{tmp_dir}/vocab")
    enc = encode(p, {"src_ids": "src_text", "trg_ids": "trg_text"}, v)
    ev = validate(enc, v, BigramScorer(bigram_scores(enc)), opts)["eval"].collect()
    assert len(ev) == len(rows) and all(r.predicted is not None for r in ev)
    some = validate(enc, v, BigramScorer(bigram_scores(enc)), opts, num_examples=20)["eval"].collect()
    assert len(some) == len(rows)


def test_loss_log(spark, tmp_dir):
    scores = spark.createDataFrame([(e, p, [0.0, float(e), 1.0], 1 + p % 2) for e in range(6) for p in range(2)],
                                   "example_id long, pos int, logits array<double>, label int")
    log_losses(scores, f"{tmp_dir}/log", "r1", 3, pad=0, smoothing=0.0)
    log_losses(scores.where("example_id < 3"), f"{tmp_dir}/log", "r2", 3, pad=0, smoothing=0.0)
    got = [(r.run, r.epoch, r.train_steps, r.val_loss) for r in curves.loss_curves(runlog.read_metrics(spark, f"{tmp_dir}/log"), 3).collect()]
    assert [g[:3] for g in got] == [("r1", 0, 3), ("r1", 1, 3), ("r2", 0, 3)]
    loss = [math.log(1 + math.exp(e) + math.e) - (e + 1) / 2 for e in range(6)]
    assert abs(got[1][3] - sum(loss[3:]) / 3) < 1e-9 and got[0][3] == got[2][3]


def test_first_shuffled_is_the_head_of_the_rank(spark):
    df = spark.range(200).withColumnRenamed("id", "pair_id")
    want = [r.pair_id for r in shuffle_rank(df, ["pair_id"], 5, [2]).orderBy("rank").limit(4).collect()]
    assert [r.pair_id for r in first_shuffled(df, ["pair_id"], 5, 2, 4).orderBy("rank").collect()] == want


def test_bigram_classes_back_off(spark):
    enc = spark.createDataFrame([([7], 0), ([7], 0), ([8], 1)], "trg_ids array<int>, src_class int")
    best = {(r.src_class, r.prev_id): r.next_id for r in BigramScorer(bigram_scores(enc, by=["src_class"])).best().collect()}
    assert best[(-1, 2)] == 7 and best[(0, 2)] == 7 and best[(1, 2)] == 8 and (1, 7) not in best


def test_json_needs_no_schema_pass(spark, tmp_dir):
    with open(f"{tmp_dir}/c.json", "w") as fh:
        fh.write('{"pair_id": 1, "translation": {"en": "a", "ja": "b", "fr": "c"}, "split": "test"}\n')
    got = read_pairs(spark, f"{tmp_dir}/c.json", "en", "ja", "test", fmt="json")
    assert [tuple(r) for r in got.collect()] == [(1, "a", "b", "test")]


def test_pairs_up_to_the_production_length_are_batched(spark, tmp_path):
    rows = [(c, t, ("user", "assistant")[t], " ".join(["w"] * (n if t == 0 else 3)))
            for c, n in enumerate([5, 127, 200, 300, 478, 479, 600] * 3) for t in (0, 1)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    train = {r.pair_id for r in queries.split_df(spark, str(tmp_path)).where("split = 'train'").collect()}
    fits = {r.pair_id for r in queries.q_length_quarantine(spark, str(tmp_path)).where("reason is null").collect()}
    got = queries.q_train_batches(spark, str(tmp_path)).select("epoch", "pair_ids").collect()
    seen = sorted((r.epoch, int(i)) for r in got for i in r.pair_ids.split(","))
    assert seen == sorted((e, i) for e in range(queries.OPTS.num_epochs) for i in train & fits)
    assert {i for _, i in seen} >= {i for i in train if rows[2 * (i >> 31)][3].count("w") in (200, 300, 478)}


@pytest.mark.parametrize("query", [queries.q_train_batches, queries.q_train_batches_prepared])
def test_no_cell_of_a_batch_becomes_a_string_of_its_own(spark, tmp_path, query):
    rows = [(c, t, ("user", "assistant")[t], f"a{c} b") for c in range(30) for t in (0, 1)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    plan = query(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as array<string>") == 1  # the few pair ids


def test_word_edits_by_bit_vectors(spark):
    rng = random.Random(12)
    for n in (0, 1, 3, 40, 64, 65, 200):
        for _ in range(8):
            a, b = [[rng.choice("abcdefgh") for _ in range(rng.randint(0, n))] for _ in range(2)]
            assert bit_edits(a, b) == _distance(a, b)
    # a pair of 9,000 words a side is one row of one task: no rounds of blocks, and few seconds for many
    a = [str(rng.randint(0, 3000)) for _ in range(9000)]
    b = a[:1000] + [str(rng.randint(0, 3000)) for _ in range(7000)] + a[8000:]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))] * 3, "p string, e string")
    out = with_word_edits(df, "p", "e", "d")
    assert "levenshtein" not in out._jdf.queryExecution().toString()
    right = np.arange(len(b) + 1)
    step = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(right[1:] + 1, right[:-1] + (np.array(b) != x))])
        right = np.minimum.accumulate(new - step) + step
    assert {r.d for r in out.collect()} == {int(right[-1])}
