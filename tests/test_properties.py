"""Property tests: random inputs, each example checked in one Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parallex.operators.metrics import bleu, char_error_rate, with_word_edits
from parallex.operators.ranking import exact_rank, hash_rank
from parallex.operators.sampling import order_hash
from tests.test_metrics import edit, py_bleu

WORD = st.text(alphabet=st.sampled_from(list("abcé日本xyz")), min_size=1, max_size=3)
SEP = st.sampled_from([" ", "  ", "\t", "\n", "　", " ", " "])


@st.composite
def sentence(draw):
    ws = draw(st.lists(WORD, max_size=25))
    out = draw(st.sampled_from(["", " "]))
    for w in ws:
        out += w + draw(SEP)
    return out


PAIRS = st.lists(st.tuples(sentence(), sentence()), min_size=1, max_size=30)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(PAIRS)
def test_edit_distances_and_bleu(spark, pairs):
    df = spark.createDataFrame([(i, p, e) for i, (p, e) in enumerate(pairs)],
                               "pair_id long, predicted string, expected string")
    got = {r["pair_id"]: r["w"] for r in with_word_edits(df, "predicted", "expected", "w").collect()}
    for i, (p, e) in enumerate(pairs):
        assert got[i] == edit(p.split(), e.split())
    assert char_error_rate(df).first()["edits"] == sum(edit(p, e) for p, e in pairs)
    want, _, _ = py_bleu(pairs)
    assert abs(bleu(df).first()["bleu"] - want) < 1e-12


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 2)), min_size=1, max_size=300)
       .map(lambda xs: [(i, v, g) for i, (v, g) in enumerate(xs)]))
def test_ranks_match_sort(spark, rows):
    df = spark.createDataFrame(rows, "k long, v int, g int").repartition(3)
    er = {r["k"]: r["rank"] for r in exact_rank(df, [F.col("v").desc(), F.col("k")], group=["g"]).collect()}
    h = df.withColumn("h", order_hash(["k"], 7))
    hr = {r["k"]: (r["rank"], r["h"]) for r in hash_rank(h, "h", ["k"], group=["g"], prefix_hex=1).collect()}
    for g in {r[2] for r in rows}:
        grp = [r for r in rows if r[2] == g]
        by_v = sorted(grp, key=lambda r: (-r[1], r[0]))
        assert [er[r[0]] for r in by_v] == list(range(1, len(grp) + 1))
        by_h = sorted(grp, key=lambda r: (hr[r[0]][1], r[0]))
        assert [hr[r[0]][0] for r in by_h] == list(range(1, len(grp) + 1))
