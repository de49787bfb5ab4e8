import math

from pyspark.sql import functions as F

from parallex.config import Options
from parallex.jobs import BLEU_TAG, CER_TAG, WER_TAG, evaluate, prepare, read_prepared
from parallex.operators.examples import build_examples
from parallex.operators.metrics import bleu, char_error_rate, word_error_rate
from parallex.plans.standins import eval_set, pairs
from parallex.sources.runlog import read_metrics
from tests.conftest import SF001


def test_prepare_writes_consistent_tables(spark, tmp_dir):
    opts = Options(seq_len=128)
    p = pairs(spark, SF001)
    n = p.count()
    summary = {r["split"]: r for r in prepare(spark, p, tmp_dir, opts).collect()}
    rejected = read_prepared(spark, tmp_dir, status="rejected")
    kept = read_prepared(spark, tmp_dir)
    assert kept.count() + rejected.count() == n
    assert set(r["reason"] for r in rejected.collect()) <= {"src_too_long", "trg_too_long"}
    assert sum(r["pairs"] for r in summary.values()) == kept.count()
    train = read_prepared(spark, tmp_dir, "train")
    sched = spark.read.parquet(f"{tmp_dir}/schedule")
    per_epoch = sched.groupBy("epoch").agg(F.count(F.lit(1)).alias("c")).collect()
    assert len(per_epoch) == opts.num_epochs and all(r["c"] == train.count() for r in per_epoch)
    steps = sorted({(r["epoch"], r["batch_id"], r["global_step"]) for r in sched.collect()})
    assert [s[2] for s in steps] == list(range(opts.num_epochs * math.ceil(train.count() / opts.batch_size)))
    ex = build_examples(train, opts.seq_len)
    assert ex.where(F.size("encoder_input") != opts.seq_len).count() == 0
    # vocabulary is reused on a second run
    v1 = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/vocab").collect())
    prepare(spark, p.limit(3), f"{tmp_dir}/again", opts, vocab_path=f"{tmp_dir}/vocab")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/vocab").collect()) == v1


def test_evaluate_matches_metrics_and_logs(spark, tmp_dir):
    ev = eval_set(spark, SF001)
    got = evaluate(ev, metric_log=f"{tmp_dir}/log", step=7).first()
    assert abs(got["cer"] - char_error_rate(ev).first()["cer"]) < 1e-12
    assert abs(got["wer"] - word_error_rate(ev).first()["wer"]) < 1e-12
    assert abs(got["bleu"] - bleu(ev).first()["bleu"]) < 1e-12
    log = {r["tag"]: (r["step"], r["value"]) for r in read_metrics(spark, f"{tmp_dir}/log").collect()}
    assert set(log) == {CER_TAG, WER_TAG, BLEU_TAG} and log[CER_TAG][0] == 7


def test_validate_end_to_end(spark, tmp_dir):
    from parallex.jobs import validate
    from parallex.operators.decoding import BigramScorer, bigram_scores
    from parallex.operators.encode import encode
    from parallex.operators.vocab import build_vocab
    from parallex.plans.standins import scores
    p = pairs(spark, SF001)
    v = build_vocab(p.select(F.col("src_text").alias("text")).unionByName(p.select(F.col("trg_text").alias("text"))))
    enc = encode(p, {"src_ids": "src_text", "trg_ids": "trg_text"}, v)
    scorer = BigramScorer(bigram_scores(enc))
    out = validate(enc, v, scorer, Options(), num_examples=2, scores=scores(spark, SF001),
                   metric_log=f"{tmp_dir}/log", step=3, report_path=f"{tmp_dir}/rep")
    ev = out["eval"].collect()
    assert len(ev) == 2 and all(r["predicted"].startswith("[SOS]") for r in ev)
    m = out["metrics"].first()
    assert m["cer"] is not None and m["wer"] is not None and m["mean_loss"] > 0
    assert out["report"].count() == 8  # 4 lines per example (texts may hold newlines themselves)
    written = "\n".join(r["value"] for r in spark.read.text(f"{tmp_dir}/rep").collect())
    assert all(r["line"] in written for r in out["report"].collect())
    assert read_metrics(spark, f"{tmp_dir}/log").count() == 3
