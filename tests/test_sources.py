import json


from parallex.sources.corpus import (conversation_pairs, pair_by_id, pair_count, preview, read_pairs,
                                     route_inputs, sentences, to_pairs)
from tests.conftest import SF01


def test_read_pairs_json_map_and_split(spark, tmp_dir):
    rows = [{"pair_id": i, "split": "train" if i < 3 else "test",
             "translation": {"en": f"hello {i}", "ja": f"こんにちは {i}", "fr": "x"}} for i in range(5)]
    path = f"{tmp_dir}/corpus.json"
    with open(path, "w") as fh:
        fh.write("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    schema = "pair_id long, split string, translation map<string,string>"
    allp = read_pairs(spark, path, "en", "ja", "all", fmt="json", schema=schema)
    assert pair_count(allp).first()["n_pairs"] == 5
    test = read_pairs(spark, path, "en", "ja", "test", fmt="json", schema=schema)
    assert sorted(r["pair_id"] for r in test.collect()) == [3, 4]
    assert pair_by_id(allp, 4).first()["trg_text"] == "こんにちは 4"
    assert [r["pair_id"] for r in preview(allp, 2).collect()] == [0, 1]


def test_partitioned_parquet_split_is_pruned(spark, tmp_dir):
    df = spark.createDataFrame([(i, "train" if i % 2 else "test", (f"s{i}", f"t{i}")) for i in range(6)],
                               "pair_id long, split string, translation struct<en:string,ja:string>")
    path = f"{tmp_dir}/pq"
    df.write.partitionBy("split").parquet(path)
    got = read_pairs(spark, path, "en", "ja", "train")
    assert sorted(r["src_text"] for r in got.collect()) == ["s1", "s3", "s5"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_to_pairs_struct(spark):
    df = spark.createDataFrame([(1, ("a", "b"))], "id long, translation struct<en:string,ja:string>")
    assert tuple(to_pairs(df, "en", "ja", id_col="id").first()) == (1, "a", "b")


def test_conversation_pairs_and_sentences(spark):
    conv = spark.read.parquet(f"{SF01}/conversations.parquet")
    p = conversation_pairs(conv)
    assert p.count() == 233
    assert p.select("pair_id").distinct().count() == 233
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    assert sentences(docs, "en").count() == docs.where("lang = 'en'").count()


def test_route_inputs(spark):
    pairs = spark.createDataFrame([(12, "src12", "trg12")], "pair_id long, src_text string, trg_text string")
    inputs = spark.createDataFrame([(1, "12"), (2, "12a"), (3, "13"), (4, "99999999999999999999999"), (5, None)],
                                   "input_id long, input string")
    out = {r["input_id"]: r for r in route_inputs(inputs, pairs).collect()}
    assert (out[1]["source"], out[1]["expected"], out[1]["found"]) == ("src12", "trg12", True)
    assert (out[2]["is_row_id"], out[2]["source"], out[2]["found"]) == (False, "12a", True)
    assert (out[3]["found"], out[3]["source"]) == (False, None)
    assert out[4]["found"] is False
    assert out[5]["is_row_id"] is False and out[5]["source"] is None


def test_read_pairs_flat_csv(spark, tmp_dir):
    import csv
    path = f"{tmp_dir}/corpus.csv"
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(["pair_id", "split", "en", "ja"])
        w.writerow([1, "test", "hello, world", "こんにちは"])
        w.writerow([2, "train", "two\nlines", "二行"])
    got = read_pairs(spark, path, "en", "ja", "all", fmt="csv",
                     schema="pair_id long, split string, en string, ja string", multi_line=True)
    rows = {r["pair_id"]: (r["src_text"], r["trg_text"], r["split"]) for r in got.collect()}
    assert rows == {1: ("hello, world", "こんにちは", "test"), 2: ("two\nlines", "二行", "train")}
