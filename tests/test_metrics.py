import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parallex.operators.metrics import bleu, bleu_ngrams, char_error_rate, with_word_edits, word_error_rate
from tests.conftest import SF01


def ev(spark, pairs):
    return spark.createDataFrame([(i, p, e) for i, (p, e) in enumerate(pairs)],
                                 "pair_id long, predicted string, expected string")


def edit(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def py_bleu(pairs, max_n=4):
    num, den = [0] * max_n, [0] * max_n
    c = r = 0
    for p, e in pairs:
        h, t = p.split(), e.split()
        c, r = c + len(h), r + len(t)
        for n in range(1, max_n + 1):
            hc = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
            rc = Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
            num[n - 1] += sum(min(v, rc[g]) for g, v in hc.items())
            den[n - 1] += sum(hc.values())
    if min(num) == 0:
        return 0.0, num, den
    bp = 1.0 if c > r else math.exp(1 - r / c)
    return bp * math.exp(sum(math.log(a / b) for a, b in zip(num, den)) / max_n), num, den


def test_hand_vectors(spark):
    df = ev(spark, [("the cat sat on mat", "the cat on the mat")])
    assert word_error_rate(df).first()["edits"] == 2
    assert char_error_rate(ev(spark, [("日本", "日木")])).first()["edits"] == 1
    assert char_error_rate(ev(spark, [("é", "e")])).first()["edits"] == 1
    assert word_error_rate(ev(spark, [("a　b", "a b")])).first()["edits"] == 0


def test_perfect_prediction(spark):
    df = ev(spark, [("one two three four five", "one two three four five"), ("a b c d", "a b c d")])
    assert char_error_rate(df).first()["cer"] == 0
    assert word_error_rate(df).first()["wer"] == 0
    assert bleu(df).first()["bleu"] == pytest.approx(1.0)


def test_bleu_zero_and_brevity(spark):
    assert bleu(ev(spark, [("a b c", "x y z w")])).first()["bleu"] == 0.0
    pairs = [("the cat is on the mat", "the cat is on the red mat today"), ("a b c d e", "a b c d e f")]
    ref, num, den = py_bleu(pairs)
    assert bleu(ev(spark, pairs)).first()["bleu"] == pytest.approx(ref, abs=1e-12)
    stats = {r["n"]: (r["matches"], r["candidates"]) for r in bleu_ngrams(ev(spark, pairs)).collect()}
    assert [stats[n] for n in range(1, 5)] == list(zip(num, den))


def test_wer_and_bleu_match_brute_force_on_corpus(spark):
    """All stand-in pairs, including those with hundreds of distinct words."""
    from parallex.plans.standins import eval_set
    e = eval_set(spark, SF01)
    got = {r["pair_id"]: r["word_edits"] for r in with_word_edits(e, "predicted", "expected").collect()}
    rows = e.fillna("", ["predicted"]).collect()  # a missing prediction counts as empty
    assert any(r["predicted"] == "" for r in rows)
    assert max(len(set(r["predicted"].split()) | set(r["expected"].split())) for r in rows) > 127
    for r in rows:
        assert got[r["pair_id"]] == edit(r["predicted"].split(), r["expected"].split())
    ref, _, _ = py_bleu([(r["predicted"], r["expected"]) for r in rows])
    assert bleu(e).first()["bleu"] == pytest.approx(ref, abs=1e-12)
    cer = char_error_rate(e).first()
    assert cer["edits"] == sum(edit(r["predicted"], r["expected"]) for r in rows)


def test_grouped_rates(spark):
    df = ev(spark, [("a b", "a c"), ("x", "x")]).withColumn("grp", F.col("pair_id") % 2)
    out = {r["grp"]: r["wer"] for r in word_error_rate(df, by=["grp"]).collect()}
    assert out == {0: 0.5, 1: 0.0}
