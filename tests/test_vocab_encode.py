from collections import Counter

import pytest
from pyspark.sql import functions as F

from parallex.config import SPECIAL_TOKENS
from parallex.operators.encode import decode, encode
from parallex.operators.vocab import build_vocab, special_ids, vocab_size
from parallex.sources.vocab_store import get_or_build_vocab

TEXTS = ["the cat sat on the mat", "the dog sat", "a cat", "", "日本 の 猫 猫"]


def texts_df(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "pair_id long, text string")


def test_build_vocab_order_and_specials(spark):
    v = build_vocab(texts_df(spark), "text", "word", min_count=1)
    rows = sorted(v.collect(), key=lambda r: r["id"])
    assert [r["token"] for r in rows[:4]] == list(SPECIAL_TOKENS)
    counts = Counter(w for t in TEXTS for w in t.split())
    expected = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0].encode("utf-8")))
    assert [(r["token"], r["n"]) for r in rows[4:]] == expected
    assert [r["id"] for r in rows] == list(range(len(rows)))
    assert special_ids(v) == {"[UNK]": 0, "[PAD]": 1, "[SOS]": 2, "[EOS]": 3}
    assert vocab_size(v).first()["vocab_size"] == 4 + len(counts)


def test_min_count_and_max_size(spark):
    v = build_vocab(texts_df(spark), "text", "word", min_count=2)
    assert {r["token"] for r in v.where(~F.col("is_special")).collect()} == {"the", "cat", "sat", "猫"}
    top = build_vocab(texts_df(spark), "text", "word", min_count=1, max_size=6)
    assert [r["token"] for r in top.orderBy("id").collect()][4:] == ["the", "cat"]


def test_encode_decode_roundtrip(spark):
    df = texts_df(spark)
    v = build_vocab(df, "text", "word", min_count=1)
    enc = encode(df, {"ids": "text"}, v, "word")
    rows = {r["pair_id"]: r for r in enc.collect()}
    assert rows[3]["ids"] == []
    assert all(0 not in r["ids"] for r in rows.values())
    dec = decode(enc.select("pair_id", "ids"), {"back": "ids"}, v, "word")
    for r in dec.collect():
        assert r["back"] == " ".join(TEXTS[r["pair_id"]].split())


def test_encode_unknown_and_char_mode(spark):
    df = texts_df(spark)
    v = build_vocab(df.where("pair_id = 0"), "text", "word", min_count=1)
    enc = encode(df, {"ids": "text"}, v, "word")
    ids = {r["pair_id"]: r["ids"] for r in enc.collect()}
    assert ids[1][1] == 0 and ids[1][0] != 0  # "dog" unknown, "the" known
    cv = build_vocab(df, "text", "char", min_count=1)
    cenc = encode(df, {"ids": "text"}, cv, "char")
    back = decode(cenc.select("pair_id", "ids"), {"t": "ids"}, cv, "char")
    assert {r["pair_id"]: r["t"] for r in back.collect()} == dict(enumerate(TEXTS))


def test_decode_keeps_or_strips_specials(spark):
    df = texts_df(spark)
    v = build_vocab(df, "text", "word", min_count=1)
    ids = spark.createDataFrame([(1, [2, 5, 3, 1])], "pair_id long, ids array<int>")
    kept = decode(ids, {"t": "ids"}, v, "word").first()["t"]
    stripped = decode(ids, {"t": "ids"}, v, "word", strip_special=True).first()["t"]
    tok5 = v.where("id = 5").first()["token"]
    assert kept == f"[SOS] {tok5} [EOS] [PAD]"
    assert stripped == tok5


def test_get_or_build_vocab_reuses_stored(spark, tmp_dir):
    path = f"{tmp_dir}/vocab"
    first = get_or_build_vocab(spark, path, texts_df(spark), min_count=1)
    a = sorted(tuple(r) for r in first.collect())
    other = spark.createDataFrame([(0, "completely different words")], "pair_id long, text string")
    second = get_or_build_vocab(spark, path, other, min_count=1)
    assert sorted(tuple(r) for r in second.collect()) == a


def test_literal_special_strings_are_unknown(spark):
    df = spark.createDataFrame([(1, "a [PAD] [SOS] a")], "pair_id long, text string")
    v = build_vocab(df, "text", "word", min_count=1)
    ids = encode(df, {"ids": "text"}, v, "word").first()["ids"]
    a = v.where("token = 'a'").first()["id"]
    assert ids == [a, 0, 0, a]


def test_two_builders_leave_one_vocabulary(spark, tmp_dir):
    import os
    from concurrent.futures import ThreadPoolExecutor
    path = f"{tmp_dir}/vocab"
    corpora = [spark.createDataFrame([(f"only{i} word " * 3,)], "text string") for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda t: sorted(map(tuple, get_or_build_vocab(spark, path, t).collect())), corpora))
    assert all(g == got[0] for g in got) and len(got[0]) == 6
    assert os.listdir(tmp_dir) == ["vocab"]  # the others dropped theirs
    os.makedirs(f"{tmp_dir}/other/folder")
    with pytest.raises(FileExistsError):
        get_or_build_vocab(spark, f"{tmp_dir}/other", corpora[0])
