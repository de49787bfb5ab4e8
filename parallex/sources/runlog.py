"""Run bookkeeping: artifact records (A5, A6), metric log (A7), side-by-side
report (A8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallex.config import Options

ARTIFACT_SCHEMA = T.StructType([
    T.StructField("run", T.StringType(), False),
    T.StructField("epoch", T.IntegerType(), False),
    T.StructField("global_step", T.LongType(), False),
    T.StructField("path", T.StringType(), False),
])

METRIC_SCHEMA = T.StructType([
    T.StructField("run", T.StringType(), True),
    T.StructField("tag", T.StringType(), False),
    T.StructField("step", T.LongType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("ts", T.TimestampType(), True),
])


def artifact_path(epoch: Column, opts: Options = Options()) -> Column:
    """``{datasource}_{model_folder}/{model_basename}{epoch:02d}.pt``."""
    return F.format_string(f"{opts.artifact_folder}/{opts.model_basename}%02d.pt", epoch)


def artifact_records(df: DataFrame, opts: Options = Options()) -> DataFrame:
    """``(run, epoch, global_step)`` rows to full artifact records."""
    return df.select(F.col("run").cast("string"), F.col("epoch").cast("int"),
                     F.col("global_step").cast("long"), artifact_path(F.col("epoch"), opts).alias("path"))


def append_artifacts(records: DataFrame, path: str) -> None:
    """Append artifact records (one per epoch) to the artifact log."""
    records.select(*[f.name for f in ARTIFACT_SCHEMA]).write.mode("append").parquet(path)


def append_artifact(run: str, epoch: int, global_step: int, path: str, spark: SparkSession,
                    opts: Options = Options()) -> None:
    """Append the record of one saved epoch (what a training loop calls after
    writing its weights)."""
    row = spark.createDataFrame([(run, epoch, global_step)], "run string, epoch int, global_step long")
    append_artifacts(artifact_records(row, opts), path)


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARTIFACT_SCHEMA).parquet(path)


def artifacts_from_files(spark: SparkSession, folder: str, opts: Options = Options(),
                         run: str = "default") -> DataFrame:
    """Artifact records from a folder listing. Only file paths are read: the
    ``content`` column of the binary-file source is pruned."""
    pat = f"{opts.model_basename}([0-9]+)\\.pt$"
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"{opts.model_basename}*")
             .load(folder).select("path").where(F.col("path").rlike(pat)))
    return files.select(F.lit(run).alias("run"),
                        F.regexp_extract("path", pat, 1).try_cast("int").alias("epoch"),
                        F.lit(None).cast("long").alias("global_step"), "path")


def with_steps(files: DataFrame, steps_per_epoch: int) -> DataFrame:
    """A listing has no step counter; a file of epoch ``e`` was written after
    ``(e + 1) * steps_per_epoch`` steps."""
    derived = ((F.col("epoch") + 1) * F.lit(steps_per_epoch)).cast("long")
    return files.withColumn("global_step", F.coalesce("global_step", derived))


def latest_artifact(log: DataFrame, preload: str | None = "latest",
                    by: tuple[str, ...] = ("run",)) -> DataFrame:
    """The artifact to resume from, per run: the highest epoch (numeric order,
    so epoch 100 beats 99), or the one named by ``preload``, or none."""
    if preload is None:
        return log.limit(0)
    if preload != "latest":
        log = log.where(F.col("epoch") == int(preload))  # the last record of that epoch
    rec = F.struct("epoch", "global_step", "path")
    best = log.groupBy(*by).agg(F.max_by(rec, F.struct("epoch", "global_step")).alias("_a"))
    return best.select(*by, "_a.epoch", "_a.global_step", "_a.path")


def resume_point(runs: DataFrame, latest: DataFrame, by: tuple[str, ...] = ("run",)) -> DataFrame:
    """``initial_epoch = epoch + 1`` and the saved ``global_step``; 0 and 0 for a
    run with nothing to resume. A record without a step counter (a bare file
    listing, see ``with_steps``) cannot be resumed from and is an error."""
    missing = F.when(F.col("epoch").isNotNull() & F.col("global_step").isNull(), F.raise_error(
        F.lit("the artifact to resume from has no global_step; derive it with with_steps")).cast("long"))
    j = runs.select(*by).distinct().join(latest, list(by), "left")
    return j.select(*by, F.coalesce(F.col("epoch") + 1, F.lit(0)).alias("initial_epoch"),
                    F.coalesce(F.col("global_step"), missing, F.lit(0).cast("long")).alias("global_step"))


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append scalar log rows ``(run, tag, step, value, ts)``, partitioned by tag."""
    metrics.select(*[f.name for f in METRIC_SCHEMA]).write.mode("append").partitionBy("tag").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).parquet(path)


def metric_summary(log: DataFrame) -> DataFrame:
    """Per run and tag: entries, last step and the value written last at that step."""
    order = F.struct("step", "ts", "value")
    return log.groupBy("run", "tag").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                  F.max("step").alias("last_step"),
                                  F.max_by("value", order).alias("last_value"))


# The report layout. Validation: a rule of 80 dashes, then
# "SOURCE:", "TARGET:" and "PREDICTED:" lines. Inference: "ID: ", "SOURCE: ",
# "TARGET: " and "PREDICTED: " right-aligned to 12 characters.
RULE_WIDTH = 80
VAL_LABELS = ("SOURCE:", "TARGET:", "PREDICTED:")
LABEL_WIDTH = 12
INFER_LABELS = ("ID: ", "SOURCE: ", "TARGET: ", "PREDICTED: ")


def comparison_report(ev: DataFrame, key: str = "pair_id", source: str = "source",
                      expected: str = "expected", predicted: str = "predicted") -> DataFrame:
    """Validation report: per example a dash rule and SOURCE / TARGET / PREDICTED
    lines, as ``(key, line_no, line)``."""
    src_l, trg_l, pred_l = VAL_LABELS
    lines = F.array(F.lit("-" * RULE_WIDTH),
                    *[F.concat(F.lit(label), F.coalesce(F.col(c), F.lit("")))
                      for label, c in ((src_l, source), (trg_l, expected), (pred_l, predicted))])
    return ev.select(key, F.posexplode(lines).alias("line_no", "line"))


def translation_report(tr: DataFrame, key: str = "input_id") -> DataFrame:
    """Inference report: labels right-aligned to 12 characters; ID and TARGET
    only for row-id inputs; PREDICTED lists the generated tokens, each
    followed by a space."""
    def lab(text: str) -> Column:
        return F.lpad(F.lit(text), LABEL_WIDTH, " ")

    id_l, src_l, trg_l, pred_l = INFER_LABELS
    lines = F.filter(F.array(
        F.when(F.col("is_row_id"), F.concat(lab(id_l), F.col("input"))),
        F.concat(lab(src_l), F.coalesce(F.col("source"), F.lit(""))),
        F.when(F.col("is_row_id"), F.concat(lab(trg_l), F.coalesce(F.col("expected"), F.lit("")))),
        F.concat(lab(pred_l), F.coalesce(
            F.when(F.col("generated") != "", F.concat(F.col("generated"), F.lit(" "))), F.lit(""))),
    ), lambda x: x.isNotNull())
    return tr.select(key, F.posexplode(lines).alias("line_no", "line"))


def write_report(report: DataFrame, path: str, key: str = "pair_id") -> None:
    """Write the report as text, lines in key and line order within each file."""
    (report.repartitionByRange(key).sortWithinPartitions(key, "line_no")
     .select("line").write.mode("overwrite").text(path))
