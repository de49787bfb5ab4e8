"""The plans used when a lookup side is too large to broadcast give the same
answers as the broadcast plans (forced here by shrinking the byte bound)."""

from pyspark.sql import functions as F

import parallex.session as session
from parallex.operators.decoding import BigramScorer, bigram_scores, greedy_decode
from parallex.operators.encode import decode, encode
from parallex.operators.vocab import build_vocab
from parallex.plans.standins import pairs
from tests.conftest import SF001


def run_both(monkeypatch, fn):
    a = fn()
    monkeypatch.setattr(session, "MAX_BROADCAST_BYTES", 1)
    b = fn()
    monkeypatch.undo()
    return a, b


def test_encode_decode_salted(spark, monkeypatch):
    p = pairs(spark, SF001)
    v = build_vocab(p, "src_text", "word", min_count=2)

    def go():
        e = encode(p, {"src_ids": "src_text", "trg_ids": "trg_text"}, v, "word")
        d = decode(e.select("pair_id", "src_ids"), {"t": "src_ids"}, v, "word")
        return (sorted((r["pair_id"], tuple(r["src_ids"]), tuple(r["trg_ids"])) for r in e.collect()),
                sorted(tuple(r) for r in d.collect()))

    a, b = run_both(monkeypatch, go)
    assert a == b


def test_markov_decode_salted(spark, monkeypatch):
    p = pairs(spark, SF001)
    v = build_vocab(p, "src_text", "word", min_count=1)
    e = encode(p, {"src_ids": "src_text", "trg_ids": "trg_text"}, v, "word")

    def go():
        sc = BigramScorer(bigram_scores(e, "trg_ids"))
        prompts = e.select(F.col("pair_id").alias("seq_id"), F.array(F.lit(2)).alias("ids"))
        return sorted((r["seq_id"], tuple(r["ids"])) for r in greedy_decode(prompts, sc, 6).collect())

    a, b = run_both(monkeypatch, go)
    assert a == b


def test_vocab_by_group(spark):
    df = spark.createDataFrame([("en", "a b a"), ("fr", "c c d"), ("en", "b")], "lang string, text string")
    v = build_vocab(df, "text", "word", by=["lang"])
    got = sorted((r["lang"], r["token"], r["id"], r["n"]) for r in v.collect())
    specials = [(lang, t, i, 0) for lang in ("en", "fr") for i, t in enumerate(("[UNK]", "[PAD]", "[SOS]", "[EOS]"))]
    assert got == sorted(specials + [("en", "a", 4, 2), ("en", "b", 5, 2), ("fr", "c", 4, 2), ("fr", "d", 5, 1)])


def test_hot_key_is_split(spark, monkeypatch):
    from parallex.operators.lookup import hot_keys, lookup_join
    # key 0 holds a third of all rows
    rows = [(i, 0 if i % 3 == 0 else i) for i in range(3000)]
    big = spark.createDataFrame(rows, "rid long, k long")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(3000)], "key long, val string")
    hot = {r["_k"]: r["_salts"] for r in hot_keys(big.withColumnRenamed("k", "_k"), "_k", 16).collect()}
    assert list(hot) == [0] and hot[0] >= 5
    monkeypatch.setattr(session, "MAX_BROADCAST_BYTES", 1)
    out = lookup_join(big, F.col("k"), small, "key", "left", salt_source=F.col("rid"), partitions=16)
    got = sorted((r["rid"], r["val"]) for r in out.collect())
    assert got == sorted((i, f"v{k}") for i, k in rows)
