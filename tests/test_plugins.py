import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType

from parallex.operators.decoding import BigramScorer, bigram_scores, greedy_decode, pandas_scorer
from parallex.operators.encode import encode, encode_with
from parallex.operators.examples import build_examples
from parallex.operators.scoring import to_long, top1_long
from parallex.functions.scores import top1
from parallex.operators.vocab import build_vocab
from parallex.plans.standins import pairs, scores
from parallex.sources.runlog import comparison_report, write_report
from parallex.streaming.examples import examples_stream, read_examples
from tests.conftest import SF001


@pandas_udf(ArrayType(IntegerType()))
def code_points(s: pd.Series) -> pd.Series:
    return s.map(lambda t: [ord(c) for c in t])


def test_user_tokenizer_batch_and_stream(spark, tmp_dir):
    p = pairs(spark, SF001)
    got = encode_with(p, {"src_ids": "src_text"}, code_points)
    rows = got.collect()
    assert all(r["src_ids"] == [ord(c) for c in r["src_text"]] for r in rows)
    p.write.parquet(f"{tmp_dir}/p")
    stream = spark.readStream.schema(p.schema).parquet(f"{tmp_dir}/p")
    q = (encode_with(stream, {"src_ids": "src_text"}, code_points).select("pair_id", "src_ids")
         .writeStream.format("memory").queryName("tok_stream").trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted((r[0], tuple(r[1])) for r in spark.sql("select * from tok_stream").collect()) == \
        sorted((r["pair_id"], tuple(r["src_ids"])) for r in rows)


def test_examples_stream_equals_batch(spark, tmp_dir):
    p = pairs(spark, SF001)
    v = build_vocab(p, "src_text", "word", min_count=2)
    src = f"{tmp_dir}/pairs"
    p.write.parquet(src)
    stream = spark.readStream.schema(p.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = examples_stream(stream, v, 480, f"{tmp_dir}/ex", f"{tmp_dir}/ck", f"{tmp_dir}/rej")
    q.awaitTermination(180)
    got = read_examples(spark, f"{tmp_dir}/ex")
    want = build_examples(encode(p, {"src_ids": "src_text", "trg_ids": "trg_text"}, v), 480)
    cols = ["pair_id", "encoder_input", "decoder_input", "label"]
    norm = lambda df: sorted((r[0], tuple(r[1]), tuple(r[2]), tuple(r[3])) for r in df.select(*cols).collect())
    assert norm(got) == norm(want)
    # restart on the same checkpoint: nothing replayed twice
    q2 = examples_stream(spark.readStream.schema(p.schema).parquet(src), v, 480, f"{tmp_dir}/ex",
                         f"{tmp_dir}/ck", f"{tmp_dir}/rej")
    q2.awaitTermination(180)
    assert read_examples(spark, f"{tmp_dir}/ex").count() == p.count()


def test_pandas_scorer_matches_bigram(spark):
    p = pairs(spark, SF001)
    v = build_vocab(p, "trg_text", "word", min_count=1)
    e = encode(p, {"trg_ids": "trg_text"}, v)
    table = bigram_scores(e).collect()
    best = {}
    for r in table:
        k = r["prev_id"]
        if k not in best or (r["score"], -r["next_id"]) > (best[k][1], -best[k][0]):
            best[k] = (r["next_id"], r["score"])

    def py_scorer(pdf):
        last = pdf["ids"].map(lambda ids: ids[-1])
        keep = last.isin(best.keys())
        return pd.DataFrame({"seq_id": pdf["seq_id"][keep],
                             "next_id": last[keep].map(lambda t: best[t][0]).astype("int32"),
                             "score": 1.0})

    prompts = e.select(F.col("pair_id").alias("seq_id"), F.array(F.lit(2), F.col("trg_ids")[0]).alias("ids"))
    a = {r["seq_id"]: r["ids"] for r in greedy_decode(prompts, pandas_scorer(py_scorer), 10).collect()}
    b = {r["seq_id"]: r["ids"] for r in greedy_decode(prompts, BigramScorer(bigram_scores(e)), 10).collect()}
    assert a == b


def test_top1_long_matches_array_form(spark):
    s = scores(spark, SF001)
    long = to_long(s, ["vec_id"])
    a = {r["vec_id"]: r["top1"] for r in top1_long(long, ["vec_id"]).collect()}
    b = {r["vec_id"]: r["t"] for r in s.select("vec_id", top1(F.col("logits")).alias("t")).collect()}
    assert a == b


def test_write_report(spark, tmp_dir):
    ev = spark.createDataFrame([(2, "s2", "t2", "p2"), (1, "s1", "t1", "p1")],
                               "pair_id long, source string, expected string, predicted string")
    write_report(comparison_report(ev), f"{tmp_dir}/rep")
    lines = [r["value"] for r in spark.read.text(f"{tmp_dir}/rep").collect()]
    assert sorted(lines) == sorted(["-" * 80, "SOURCE:s1", "TARGET:t1", "PREDICTED:p1",
                                    "-" * 80, "SOURCE:s2", "TARGET:t2", "PREDICTED:p2"])


def test_stateless_steps_accept_a_stream(spark, tmp_dir):
    """Tokenizer plug-in, length check and example layout run on a streaming
    DataFrame unchanged."""
    from parallex.operators.lengths import check_lengths
    p = pairs(spark, SF001)
    p.write.parquet(f"{tmp_dir}/p2")
    stream = spark.readStream.schema(p.schema).parquet(f"{tmp_dir}/p2")
    enc = encode_with(stream, {"src_ids": "src_text", "trg_ids": "trg_text"}, code_points)
    kept, _ = check_lengths(enc, 20000, "quarantine")
    q = (build_examples(kept, 20000).select("pair_id", F.size("encoder_input").alias("n"))
         .writeStream.format("memory").queryName("ex_stream").trigger(availableNow=True).start())
    q.awaitTermination(180)
    rows = spark.sql("select * from ex_stream").collect()
    assert len(rows) == p.count() and all(r["n"] == 20000 for r in rows)
