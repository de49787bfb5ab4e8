import os
from datetime import datetime


from parallex.config import Options
from parallex.operators.curves import loss_curves, train_curve, val_curve
from parallex.sources.runlog import (append_artifacts, append_metrics, artifact_records, artifacts_from_files,
                                     comparison_report, latest_artifact, metric_summary, read_artifacts,
                                     read_metrics, resume_point, translation_report)
from parallex.streaming.metrics import metrics_stream


def test_latest_is_numeric_not_by_name(spark, tmp_dir):
    recs = artifact_records(spark.createDataFrame(
        [("r", e, e * 10) for e in (9, 10, 99, 100)], "run string, epoch int, global_step long"))
    append_artifacts(recs, f"{tmp_dir}/art")
    log = read_artifacts(spark, f"{tmp_dir}/art")
    best = latest_artifact(log).first()
    assert best["epoch"] == 100 and best["path"] == "opus100_weights/tmodel_100.pt"
    assert sorted(r["path"] for r in log.collect())[-1].endswith("tmodel_99.pt")  # name order is wrong
    named = latest_artifact(log, "10").first()
    assert named["global_step"] == 100
    runs = spark.createDataFrame([("r",), ("fresh",)], "run string")
    rp = {r["run"]: (r["initial_epoch"], r["global_step"]) for r in resume_point(runs, latest_artifact(log)).collect()}
    assert rp == {"r": (101, 1000), "fresh": (0, 0)}
    assert latest_artifact(log, None).count() == 0


def test_artifacts_from_file_listing(spark, tmp_dir):
    folder = f"{tmp_dir}/{Options().artifact_folder}"
    os.makedirs(folder)
    for e in ("09", "10", "99", "100"):
        with open(f"{folder}/tmodel_{e}.pt", "wb") as fh:
            fh.write(b"x" * 10)
    with open(f"{folder}/other.txt", "w") as fh:
        fh.write("no")
    files = artifacts_from_files(spark, folder)
    assert sorted(r["epoch"] for r in files.collect()) == [9, 10, 99, 100]
    assert latest_artifact(files).first()["epoch"] == 100


def metric_rows(spark):
    rows = [("run", "train loss", s, float(10 - s % 7), datetime(2024, 1, 1)) for s in range(30)]
    rows += [("run", "validation loss", 10 * (e + 1), float(e), datetime(2024, 1, 1)) for e in range(3)]
    return spark.createDataFrame(rows, "run string, tag string, step long, value double, ts timestamp")


def test_metrics_roundtrip_and_curves(spark, tmp_dir):
    path = f"{tmp_dir}/metrics"
    m = metric_rows(spark)
    append_metrics(m, path)
    back = read_metrics(spark, path)
    assert back.count() == m.count()
    summary = {r["tag"]: (r["n"], r["last_step"]) for r in metric_summary(back).collect()}
    assert summary == {"train loss": (30, 29), "validation loss": (3, 30)}
    tc = [r["step"] for r in train_curve(back).collect()]
    assert tc == list(range(30))
    vc = [(r["epoch"], r["val_loss"]) for r in val_curve(back, 10).collect()]
    assert vc == [(0, 0.0), (1, 1.0), (2, 2.0)]  # validation of epoch e is logged at step (e+1)*10
    lc = {r["epoch"]: (r["train_steps"], r["val_loss"]) for r in loss_curves(back, 10).collect()}
    assert lc == {0: (10, 0.0), 1: (10, 1.0), 2: (10, 2.0)}


def test_stream_equals_batch(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    metric_rows(spark).write.parquet(src)
    stream = spark.readStream.schema(read_metrics(spark, src).schema).parquet(src)
    q = metrics_stream(stream, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    got = read_metrics(spark, f"{tmp_dir}/out")
    key = ["tag", "step", "value"]
    assert sorted(tuple(r) for r in got.select(*key).collect()) == \
        sorted(tuple(r) for r in metric_rows(spark).select(*key).collect())
    # restart: nothing new, nothing repeated
    q2 = metrics_stream(spark.readStream.schema(got.schema).parquet(src), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q2.awaitTermination(120)
    assert read_metrics(spark, f"{tmp_dir}/out").count() == got.count()


def test_reports(spark):
    ev = spark.createDataFrame([(1, "src", "tgt", "pred")], "pair_id long, source string, expected string, predicted string")
    lines = [r["line"] for r in comparison_report(ev).orderBy("line_no").collect()]
    assert lines == ["-" * 80, "SOURCE:src", "TARGET:tgt", "PREDICTED:pred"]
    tr = spark.createDataFrame([(7, "12", True, "a b", "c d", "[SOS] x y", "x y"),
                                (8, "hello", False, "hello", "", "[SOS] z", "z")],
                               "input_id long, input string, is_row_id boolean, source string, expected string, "
                               "predicted string, generated string")
    out = {}
    for r in translation_report(tr).orderBy("input_id", "line_no").collect():
        out.setdefault(r["input_id"], []).append(r["line"])
    assert out[7] == ["        ID: 12", "    SOURCE: a b", "    TARGET: c d", " PREDICTED: x y "]
    assert out[8] == ["    SOURCE: hello", " PREDICTED: z "]


def test_append_one_artifact(spark, tmp_dir):
    from parallex.sources.runlog import append_artifact
    for e in (0, 1):
        append_artifact("r", e, 10 * (e + 1), f"{tmp_dir}/a", spark)
    best = latest_artifact(read_artifacts(spark, f"{tmp_dir}/a")).first()
    assert (best["epoch"], best["global_step"], best["path"]) == (1, 20, "opus100_weights/tmodel_01.pt")


def test_file_listing_reads_no_content(spark, tmp_dir):
    folder = f"{tmp_dir}/{Options().artifact_folder}"
    os.makedirs(folder)
    with open(f"{folder}/tmodel_03.pt", "wb") as fh:
        fh.write(b"x" * 1000)
    files = artifacts_from_files(spark, folder)
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan
    assert files.first()["epoch"] == 3


def test_last_values_over_replays_and_restarts(spark, tmp_dir):
    import datetime

    from parallex.streaming.metrics import last_values_stream, read_last_values
    at = [datetime.datetime(2024, 1, 1, 0, m) for m in range(60)]
    schema = "run string, tag string, step long, value double, ts timestamp"
    first = [("r", "loss", 1, 5.0, at[3]), ("r", "loss", 1, 4.0, at[9]), ("r", "loss", 2, 3.0, at[1]), ("r", "cer", 1, None, at[2])]
    later = [("r", "loss", 1, 9.0, at[5]), ("r", "loss", 2, 2.0, at[8]), ("q", "loss", 1, 1.0, at[0]), ("r", "cer", 1, 0.5, at[2])]

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/log")
        last_values_stream(stream, f"{tmp_dir}/out", f"{tmp_dir}/state").awaitTermination()
        return {(r.run, r.tag, r.step): r.value for r in read_last_values(spark, f"{tmp_dir}/out").collect()}
    spark.createDataFrame(first, schema).repartition(3).write.parquet(f"{tmp_dir}/log")
    assert run() == {("r", "loss", 1): 4.0, ("r", "loss", 2): 3.0, ("r", "cer", 1): None}
    spark.createDataFrame(later, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/log")
    want = {("r", "loss", 1): 4.0, ("r", "loss", 2): 2.0, ("r", "cer", 1): 0.5, ("q", "loss", 1): 1.0}
    assert run() == want
    # the last batch again, as after a failure between its output and its commit
    last = max(int(f) for f in os.listdir(f"{tmp_dir}/state/commits") if f.isdigit())
    for f in (str(last), f".{last}.crc"):
        if os.path.exists(f"{tmp_dir}/state/commits/{f}"):
            os.remove(f"{tmp_dir}/state/commits/{f}")
    before = spark.read.parquet(f"{tmp_dir}/out").count()
    assert run() == want and spark.read.parquet(f"{tmp_dir}/out").count() == before
