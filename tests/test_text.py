from pyspark.sql import functions as F

from parallex.functions.text import chars, is_row_id, symbol, words


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("x")).first()["x"]


def test_words_split_on_unicode_whitespace(spark):
    assert one(spark, words, "a　b") == ["a", "b"]
    assert one(spark, words, "  a \t b\n\nc d e  ") == ["a", "b", "c", "d", "e"]
    assert one(spark, words, "") == []
    assert one(spark, words, "x\x1cy") == "x\x1cy".split()


def test_words_match_python_split_on_corpus(spark):
    from tests.conftest import SF001
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("text", words(F.col("text")).alias("w")).collect()
    for r in rows:
        assert r["w"] == r["text"].split()


def test_chars_are_code_points(spark):
    assert one(spark, chars, "a😀é\nb") == ["a", "😀", "é", "\n", "b"]
    assert one(spark, chars, "日本") == ["日", "本"]
    assert one(spark, chars, "") == []


def test_row_id_routing(spark):
    assert one(spark, is_row_id, "12") is True
    assert one(spark, is_row_id, "12a") is False
    assert one(spark, is_row_id, "12\n") is False
    assert one(spark, is_row_id, "") is False


def test_symbols_are_distinct_single_characters(spark):
    idx = [1, 2, 0xD800 - 0x100 - 1, 0xD800 - 0x100, 0xD800 - 0x100 + 1, 60000, 100000]
    df = spark.createDataFrame([(i,) for i in idx], "i int").select(symbol(F.col("i")).alias("s"))
    syms = [r["s"] for r in df.collect()]
    assert all(len(s) == 1 for s in syms)
    assert len(set(syms)) == len(syms)
    assert not any(0xD800 <= ord(s) <= 0xDFFF for s in syms)


def test_whitespace_set_equals_python(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    near = ["​", "᠎", "﻿", "·", "_", "-"]  # not whitespace for str.split
    rows = [(i, f"a{c}b") for i, c in enumerate(spaces + near)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", "t", words(F.col("t")).alias("w"))
    for r in df.collect():
        assert r["w"] == r["t"].split(), repr(r["t"])
