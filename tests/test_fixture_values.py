"""Check values listed for sf0.01 in FIXTURES.md."""

from pyspark.sql import functions as F

from parallex.functions.scores import top1
from parallex.functions.text import words
from parallex.operators.encode import encode
from parallex.operators.lengths import check_lengths
from parallex.operators.metrics import bleu_ngrams, char_error_rate, with_word_edits
from parallex.operators.scoring import masked_ce
from parallex.operators.vocab import build_vocab
from parallex.plans import standins as T
from tests.conftest import SF01


def test_corpus_and_lengths(spark):
    p = T.pairs(spark, SF01)
    assert p.count() == 233
    w = p.select(F.size(words(F.col("src_text"))).alias("s"), F.size(words(F.col("trg_text"))).alias("t"))
    agg = w.agg(F.max("s"), F.max("t"), F.sum("s"), F.sum("t")).first()
    assert tuple(agg) == (59, 298, 7497, 37192)
    enc = p.select("pair_id", words(F.col("src_text")).alias("src_ids"), words(F.col("trg_text")).alias("trg_ids"))
    for seq_len, rejected in ((480, 0), (128, 141)):
        assert check_lengths(enc, seq_len, "quarantine")[1].count() == rejected


def test_vocabulary_and_encoding(spark):
    p = T.pairs(spark, SF01)
    v = build_vocab(p, "src_text", "word", min_count=2)
    real = v.where(~F.col("is_special"))
    assert real.count() == 681
    assert real.agg(F.sum(F.col("id") * F.length("token"))).first()[0] == 1055019
    e = encode(p, {"src_ids": "src_text"}, v, "word")
    pos_sum = e.select(F.aggregate(F.transform("src_ids", lambda x, i: x.cast("long") * (i + 1)),
                                   F.lit(0).cast("long"), lambda a, b: a + b).alias("s")).agg(F.sum("s")).first()[0]
    assert pos_sum == 12433174


def test_text_metrics(spark):
    ev = T.eval_set(spark, SF01).withColumn("predicted", F.col("source"))  # every prediction present
    cer = char_error_rate(ev).first()
    assert (cer["edits"], cer["total"]) == (194446, 225587)
    we = with_word_edits(ev, "predicted", "expected", "edits", "ref_len").withColumn(
        "d", F.size(F.array_distinct(F.concat(words(F.col("predicted")), words(F.col("expected"))))))
    small = we.where("d <= 127").agg(F.count(F.lit(1)), F.sum("edits"), F.sum("ref_len")).first()
    big = we.where("d > 127").agg(F.count(F.lit(1)), F.sum("edits"), F.sum("ref_len")).first()
    assert tuple(small) == (86, 5888, 5861)
    assert tuple(big) == (147, 30611, 31331)
    stats = {r["n"]: (r["matches"], r["candidates"]) for r in bleu_ngrams(ev).collect()}
    assert stats == {1: (1497, 7497), 2: (38, 7264), 3: (8, 7031), 4: (6, 6798)}


def test_scores(spark):
    s = T.scores(spark, SF01)
    plain = masked_ce(s, 0, 0.0).first()
    smooth = masked_ce(s, 0, 0.1).first()
    assert plain["n_positions"] == 450
    assert round(plain["loss"], 6) == 4.166437 and round(smooth["loss"], 6) == 4.166453
    kept = s.where("label != 0").select(top1(F.col("logits")).alias("t"))
    assert kept.agg(F.sum("t")).first()[0] == 13327
