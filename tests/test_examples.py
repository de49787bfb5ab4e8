import pytest
from pyspark.sql import functions as F

from parallex.functions.arrays import render, render_rows
from parallex.operators.examples import assert_example_sizes, build_examples, causal_mask, decoder_mask
from parallex.operators.lengths import check_lengths, max_lengths, token_lengths

L = 480


def encoded(spark, rows):
    return spark.createDataFrame(
        [(i, str(s), str(t), [7] * s, [8] * t) for i, (s, t) in enumerate(rows)],
        "pair_id long, src_text string, trg_text string, src_ids array<int>, trg_ids array<int>",
    )


def test_length_boundary(spark):
    ok = encoded(spark, [(478, 479)])
    assert build_examples(ok, L).count() == 1
    for rows in ([(479, 10)], [(10, 480)]):
        with pytest.raises(Exception, match="too long"):
            build_examples(encoded(spark, rows), L).collect()
    kept, rejected = check_lengths(encoded(spark, [(478, 479), (479, 1), (1, 480)]), L, "quarantine")
    assert kept.count() == 1
    assert sorted(r["reason"] for r in rejected.collect()) == ["src_too_long", "trg_too_long"]


def test_layout_and_shift(spark):
    ex = build_examples(encoded(spark, [(3, 2), (0, 0)]), 8).orderBy("pair_id").collect()
    a = ex[0]
    assert a["encoder_input"] == [2, 7, 7, 7, 3, 1, 1, 1]
    assert a["decoder_input"] == [2, 8, 8, 1, 1, 1, 1, 1]
    assert a["label"] == [8, 8, 3, 1, 1, 1, 1, 1]
    assert a["encoder_mask"] == [1, 1, 1, 1, 1, 0, 0, 0]
    assert a["dec_valid"] == [1, 1, 1, 0, 0, 0, 0, 0]
    for i in range(2):
        assert a["label"][i] == a["decoder_input"][i + 1]
    b = ex[1]
    assert b["encoder_input"] == [2, 3, 1, 1, 1, 1, 1, 1]
    assert b["label"] == [3, 1, 1, 1, 1, 1, 1, 1]
    sizes = assert_example_sizes(build_examples(encoded(spark, [(3, 2), (0, 0)]), 8), 8).first()
    assert sizes["all_sized"] and sizes["n_examples"] == 2


def test_decoder_mask_cells(spark):
    # L = 16 with 5 non-PAD positions: 1+2+3+4+5 + 11*5 = 70 cells set
    df = spark.createDataFrame([(1, [1] * 5 + [0] * 11)], "pair_id long, dec_valid array<int>")
    m = decoder_mask(df).first()["decoder_mask"]
    assert sum(map(sum, m)) == 70
    assert m[0] == [1] + [0] * 15 and m[15] == [1] * 5 + [0] * 11


def test_causal_mask(spark):
    rows = causal_mask(spark, 5).collect()
    assert len(rows) == 25
    assert all(r["allowed"] == (r["j"] <= r["i"]) for r in rows)


def test_lengths(spark):
    e = encoded(spark, [(3, 5), (7, 1)])
    assert {r["pair_id"]: (r["n_src"], r["n_trg"]) for r in token_lengths(e).collect()} == {0: (3, 5), 1: (7, 1)}
    assert tuple(max_lengths(e).first()) == (7, 5)


def test_null_text_is_quarantined(spark):
    from parallex.operators.encode import encode
    from parallex.operators.vocab import build_vocab
    df = spark.createDataFrame([(1, "a b", "c"), (2, None, "c"), (3, "a", None)],
                               "pair_id long, src_text string, trg_text string")
    v = build_vocab(df.where("pair_id = 1"), "src_text")
    enc = encode(df, {"src_ids": "src_text", "trg_ids": "trg_text"}, v)
    kept, rejected = check_lengths(enc, 480, "quarantine")
    assert [r["pair_id"] for r in kept.collect()] == [1]
    assert sorted((r["pair_id"], r["reason"]) for r in rejected.collect()) == [(2, "null_text"), (3, "null_text")]
    with pytest.raises(Exception, match="null_text"):
        build_examples(enc, 480).collect()


def test_size_check_flags_a_wrong_row(spark):
    df = spark.createDataFrame([(1, [1, 2], [1, 2], [1, 2]), (2, [1], [1, 2], [1, 2])],
                               "pair_id long, encoder_input array<int>, decoder_input array<int>, label array<int>")
    r = assert_example_sizes(df, 2).first()
    assert r["all_sized"] is False and r["n_examples"] == 2


def test_collate_stacks_example_tensors(spark):
    from parallex.operators.sampling import assign_batches, collate, shuffle_rank
    ex = build_examples(encoded(spark, [(1, 1), (2, 2), (3, 3)]), 8)
    ranked = assign_batches(shuffle_rank(ex.select("pair_id"), ["pair_id"], 42, 1).join(ex, "pair_id"), 2)
    got = collate(ranked, ["pair_id", "encoder_input", "label"]).orderBy("batch_id").collect()
    assert [len(b["pair_id"]) for b in got] == [2, 1]
    by_id = {r["pair_id"]: r for r in ex.collect()}
    for b in got:
        assert [list(x) for x in b["encoder_input"]] == [by_id[i]["encoder_input"] for i in b["pair_id"]]


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_rows_are_rendered_as_row_by_row(spark, kind):
    rows = [[], [[]], [[], []], [[0]], [[], [1], []], [[-5, 10], [2147483647, -2147483648, 0], [7]], [list(range(L))] * 6, [[1], None, [2]], None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, a array<array<{kind}>>")
    got = df.select("i", render_rows(F.col("a")).alias("text"),
                    F.array_join(F.transform("a", lambda x: render(x)), ";").alias("want")).orderBy("i").collect()
    assert [r.text for r in got] == [r.want for r in got]
    assert got[1].text == "" and got[4].text == ";1;" and got[-1].text is None
