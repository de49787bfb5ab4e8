"""Subword training and segmentation against plain Python."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parallex.config import UNK_ID
from parallex.functions.text import arrow_words, stretches, words
from parallex.operators import encode as encode_module
from parallex.operators import subword
from parallex.operators.encode import decode, encode_with
from parallex.operators.subword import PER_ROUND, SHARE, Lattice, subword_tokenizer, subword_vocab, train

JAPANESE = ["私は学生です。学生は本を読みます", "本を読む学生は私です。", "学生の本、私の本", "彼は学生です。私は学生です", "読みます読みます"]
ODD = [None, "", " \t\n", "a a aa aaa aaaa", "x" * 3000, "tab\there", r"a\Eb \Q $1 (x) [y] ^", "[PAD] [UNK]", "é é 🙂🙂🙂 👍🏽", "　全角　空白"]


def texts():
    rng = random.Random(11)
    syl = ["th", "e", "an", "in", "g", "er", "on", "sch", "ö"]
    prose = [" ".join("".join(rng.choice(syl) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    return prose + JAPANESE * 2 + ODD


def brute(rows, n_merges, min_count):
    table = Counter(w for t in rows if t for w in t.split())
    table = {tuple([" " + w[0], *w[1:]]): n for w, n in table.items()}
    merges = []
    while len(merges) < n_merges:
        pairs = Counter()
        for s, n in table.items():
            for p in zip(s, s[1:], strict=False):
                pairs[p] += n
        order = sorted(((a, b, n) for (a, b), n in pairs.items()), key=lambda x: (-x[2], x[0].encode(), x[1].encode()))
        chosen, used = [], set()
        for a, b, n in order:
            if n < min_count or n < SHARE * order[0][2] or len(chosen) == min(PER_ROUND, n_merges - len(merges)):
                break
            if a not in used and b not in used:
                chosen.append((a, b, n))
                used |= {a, b}
        if not chosen:
            break
        ready, nxt = {(a, b) for a, b, _ in chosen}, Counter()
        for s, n in table.items():
            out, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) in ready:
                    out.append(s[i] + s[i + 1])
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            nxt[tuple(out)] += n
        table, merges = nxt, merges + chosen
    return merges, table


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "id long, text string").repartition(4).cache()


def test_merges_equal_plain_python(spark, corpus):
    for n, least in ((40, 2), (15, 5)):
        merges, table = train(corpus, n, min_count=least)
        want, cut = brute(texts(), n, least)
        assert merges == want
        got = Counter()
        for r in table.collect():
            got[tuple(r["symbols"].split("\x1f"))] += r["n"]
        assert got == cut


def test_merges_are_those_of_one_pair_at_a_time(spark):
    # one clear order: each merge of a frequent word enters before the rarer word's
    df = spark.createDataFrame([("abc",)] * 40 + [("xyz",)] * 9, "text string")
    merges, _ = train(df, 10)
    assert [m[:2] for m in merges] == [(" a", "b"), (" ab", "c"), (" x", "y"), (" xy", "z")]


def test_round_trip_of_any_text(spark, corpus):
    v = subword_vocab(corpus, 40).cache()
    assert v.select("token").distinct().count() == v.count() == v.select("id").distinct().count()
    enc = encode_with(corpus, {"ids": "text"}, subword_tokenizer(v)).cache()
    assert not any(UNK_ID in r.ids for r in enc.where("text IS NOT NULL").collect())
    back = {r.id: r.back for r in decode(enc, {"back": "ids"}, v, "subword").collect()}
    assert back == {i: " ".join((t or "").split()) for i, t in enumerate(texts())}
    # an unsegmented sentence is several tokens, together fewer than its characters
    unsegmented = enc.where(F.col("id").between(60, 64)).collect()
    assert all(1 < len(r.ids) <= len(r.text) for r in unsegmented)
    assert sum(len(r.ids) for r in unsegmented) < sum(len(r.text) for r in unsegmented)


def _best(word, scores, unknown):
    """The best sum over all ways to cut the word."""
    if not word:
        return 0.0
    ways = [scores[word[:k]] + _best(word[k:], scores, unknown) for k in range(1, len(word) + 1) if word[:k] in scores]
    return max([unknown + _best(word[1:], scores, unknown), *ways])


def test_lattice_finds_the_best_path():
    rng = random.Random(3)
    for _ in range(60):
        entries = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): rng.randint(0, 50) for _ in range(12)}
        rows = [(t, 4 + i, n) for i, (t, n) in enumerate(entries.items())]
        lattice, whole = Lattice(rows), sum(n + 1 for n in entries.values())
        scores = {t: math.log((n + 1) / whole) for t, n in entries.items()}
        names = {i: t for t, i, _ in rows}
        word = "".join(rng.choice("abcd") for _ in range(9))
        ids = lattice.cut(word)
        got = sum(scores[names[i]] if i != UNK_ID else lattice.unknown for i in ids)
        assert got == pytest.approx(_best(word, scores, lattice.unknown))
        spelt, at = [], 0
        for i in ids:
            spelt.append(names[i] if i != UNK_ID else word[at])
            at += len(spelt[-1])
        assert "".join(spelt) == word


def test_empty_corpus(spark):
    none = spark.createDataFrame([(None,), ("",)], "text string")
    assert train(none, 5)[0] == []
    assert subword_vocab(none, 5).count() == 4


def test_bytes_that_are_no_utf8(spark):
    rng = random.Random(5)
    pieces = ["61", "62", "20", "80", "c3", "a9", "e282ac", "eda080", "f09f9982", "f490", "ff"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, hex string").select("id", F.unhex("hex").cast("string").alias("text")).cache()
    v = subword_vocab(df, 20)
    back = decode(encode_with(df, {"ids": "text"}, subword_tokenizer(v)), {"back": "ids"}, v, "subword").select("id", "back")
    want = df.select("id", F.array_join(words(F.col("text")), " "))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))


def test_ids_leave_the_task_as_one_list(spark):
    df = spark.createDataFrame([("ab ab b",), (None,), ("",)], "text string")
    e = df.select(subword_tokenizer(subword_vocab(df, 4))(F.col("text")).alias("ids"))
    assert "flatten" not in e._jdf.queryExecution().toString()  # not a list for every word
    assert sorted(len(r.ids) > 0 for r in e.collect()) == [False, False, True]


def test_words_side_by_side_are_cut_as_one_by_one(monkeypatch):
    rng = random.Random(4)
    for trial in range(120):
        monkeypatch.setattr(subword, "CELLS", rng.choice([64, 1 << 18]))
        monkeypatch.setattr(subword, "FEW", rng.choice([1, 16]))
        entries = {"".join(rng.choice(" abc🙂é") for _ in range(rng.randint(1, 5))): rng.choice([0, 0, 1, 3, 50]) for _ in range(trial % 25)}
        lattice = Lattice([(t, 4 + i, n) for i, (t, n) in enumerate(entries.items())])
        words = ["".join(rng.choice("abcd 🙂é") for _ in range(rng.randint(1, 20))) for _ in range(rng.randint(0, 60))]
        ids, at, many = lattice.cut_all(pa.array(words, pa.string()))
        assert [ids[a:a + n].tolist() for a, n in zip(at, many, strict=True)] == [lattice.cut(w) for w in words]


def test_arrow_words_are_those_of_spark(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    rows = [None, "", " \t ", "a", "　a ", None, *[f"a{s}{s}b{s}" for s in spaces], "a​b﻿᠎c"]
    found, n = arrow_words(pa.array([""] + rows).slice(1))  # a slice has an offset
    want = spark.createDataFrame(list(enumerate(rows)), "i int, t string").orderBy("i").select(words(F.col("t")).alias("w")).collect()
    assert n.tolist() == [len(r.w) for r in want] and found.to_pylist() == [w for r in want for w in r.w]


def test_merges_that_spell_the_same_are_one_symbol(spark):
    rows = ["xabc"] * 9 + ["yabc"] * 8 + ["xab"] * 30 + ["ybc"] * 30 + ["zabcabcabc"] * 5
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    for n in (3, 6, 12):
        merges, table = train(df, n)
        want, cut = brute(rows, n, 2)
        assert merges == want
        assert {tuple(r["symbols"].split("\x1f")): r["n"] for r in table.collect()} == dict(cut)


def test_words_over_several_blocks(spark, corpus, monkeypatch):
    real = subword._first_blocks
    monkeypatch.setattr(subword, "_first_blocks", lambda counted: real(counted.repartition(100)))
    merges, table = train(corpus, 20)
    want, cut = brute(texts(), 20, 2)
    assert merges == want
    assert sum((Counter({tuple(r["symbols"].split("\x1f")): r["n"]}) for r in table.collect()), Counter()) == cut


def test_stretches():
    sizes = [5_000_000, 0, 4_000_000, 9_000_000, 1]
    assert [len(x) for x in stretches(pa.array(["a" * n for n in sizes]))] == [2, 1, 1, 1]
    assert [x.to_pylist() for x in stretches(pa.array([None, "a"]))] == [[None, "a"]]


def test_decoding_deals_no_tokens(spark, corpus, monkeypatch):
    """By a vocabulary of checked size texts are joined where they lie, with the rows of the join."""
    v = spark.createDataFrame([("[PAD]", 0, 0, True), (" a", 1, 5, False), ("b", 2, 5, False), (None, 3, 1, False), (" é🙂", 5, 1, False)],
                              "token string, id int, n long, is_special boolean")
    rows = [(1, [1, 2, 0, 5]), (2, None), (3, []), (None, [None, 1, 4, 9, -1, 3]), (1, [2, 1, 2, 2147483647]), (1, [1, 2, 0, 5])]
    monkeypatch.setattr(encode_module, "TOGETHER", 2)
    for kind in ("array<int>", "array<bigint>"):
        df = spark.createDataFrame(rows, f"id int, ids {kind}").repartition(2)
        for mode in ("subword", "word", "char"):
            for strip in (False, True):
                got = decode(df, {"t": "ids"}, v, mode, strip_special=strip)
                assert "ObjectHashAggregate" not in got._jdf.queryExecution().toString()
                with monkeypatch.context() as m:
                    m.setattr(encode_module, "_row_local", lambda *a: None)
                    want = decode(df, {"t": "ids"}, v, mode, strip_special=strip)
                assert got.schema.names == want.schema.names
                assert Counter(map(str, got.collect())) == Counter(map(str, want.collect()))
    # an id with two tokens keeps both
    twice = v.unionByName(spark.createDataFrame([("c", 2, 1, False)], v.schema))
    one = spark.createDataFrame([(1, [1, 2])], "id int, ids array<int>")
    assert decode(one, {"t": "ids"}, twice, "subword").first()["t"] == "abc"
    assert decode(corpus.limit(0).select("id", F.array(F.lit(1)).alias("ids")), {"t": "ids"}, v).count() == 0
