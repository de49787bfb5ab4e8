"""A corpus stored in id order, with a file index: rows by position or id (A1, A3)
without a scan.

``write_clustered`` range-partitions the pairs by id, sorts each file and gives it
a Bloom filter on the id. Beside the data it writes one index row per file: its id
range, how many rows it has and the position of its first row. From then on a row
is known by its position (files in order, then rows within the file), as a list of
sentences is, and a lookup reads only the files that can hold what it asks for.

Rows with a NULL id come first and have positions like any other; no id finds them.
A repeated id may span files and every row of it is found. Equal ids are ordered by
their texts. An empty corpus has an index without rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parallex.session import work_partitions

ROW_GROUP_BYTES = 16 << 20  # a lookup reads one group of a file, so groups are smaller than files


def write_clustered(pairs: DataFrame, path: str, files: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Store ``pairs`` in about ``files`` files (default: a task slot each or more).
    Texts and the input partition break ties of the range cuts, so that one id with
    a large share of the rows is spread over files."""
    spark = pairs.sparkSession
    keyed = pairs.withColumn("_tie", F.xxhash64("src_text", "trg_text")).withColumn("_part", F.spark_partition_id())
    order = ["pair_id", "_tie", "_part"]
    (keyed.repartitionByRange(files or work_partitions(spark), *order).sortWithinPartitions(*order).drop("_tie", "_part")
     .write.option("parquet.bloom.filter.enabled#pair_id", "true").option("parquet.block.size", str(row_group_bytes))
     .parquet(f"{path}/data"))
    stored = spark.read.parquet(f"{path}/data")
    per_file = (stored.select("pair_id", F.col("_metadata.file_path").alias("file")).groupBy("file")
                .agg(F.count(F.lit(1)).alias("n_rows"), F.min("pair_id").alias("min_id"), F.max("pair_id").alias("max_id")))
    # one row per file: a window in one task is small however many rows the files have;
    # files are named by their partition, whose number has five digits or more
    number = F.regexp_extract("file", r"part-(\d+)-[^/]*$", 1).cast("long")
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    (per_file.withColumn("first_row", F.coalesce(F.sum("n_rows").over(before), F.lit(0).cast("long")))
     .coalesce(1).write.parquet(f"{path}/index"))


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """``(file, n_rows, min_id, max_id, first_row)``, one row per data file."""
    return spark.read.parquet(f"{path}/index")


def _positioned(spark: SparkSession, path: str, files: Sequence[str] | None = None) -> DataFrame:
    """``(position, ...pair columns)`` of the named files, or of all."""
    stored = spark.read.schema(spark.read.parquet(f"{path}/data").schema).parquet(*files if files is not None else [f"{path}/data"])
    rows = stored.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_row"))
    starts = file_index(spark, path).select("file", "first_row")
    return rows.join(F.broadcast(starts), "file").select(
        (F.col("first_row") + F.col("_row")).alias("position"), *stored.columns)


def with_positions(spark: SparkSession, path: str) -> DataFrame:
    """Every pair of the stored corpus with its position, counted from 0; one scan,
    and a join with the index (one row per file)."""
    return _positioned(spark, path)


def pairs_at(spark: SparkSession, path: str, positions: Sequence[int]) -> DataFrame:
    """The pairs at the given positions, with ``position``; a position beyond the
    corpus finds nothing. Reads the files that hold them (at most one a position)."""
    asked = sorted({int(p) for p in positions})
    holds = F.exists(F.lit(asked).cast("array<long>"), lambda p: (p >= F.col("first_row")) & (p < F.col("first_row") + F.col("n_rows")))
    files = [r["file"] for r in file_index(spark, path).where(holds).select("file").collect()]
    found = _positioned(spark, path, files) if files else _positioned(spark, path).limit(0)
    return found.where(F.col("position").isin(asked))


def pairs_of(spark: SparkSession, path: str, ids: Sequence[int]) -> DataFrame:
    """The pairs with the given ids, with ``position``. Reads the files whose id range
    holds one of them; in a file, row groups are skipped by statistics and Bloom filter."""
    asked = sorted({int(i) for i in ids})
    holds = F.exists(F.lit(asked).cast("array<long>"), lambda i: (i >= F.col("min_id")) & (i <= F.col("max_id")))
    files = [r["file"] for r in file_index(spark, path).where(holds).select("file").collect()]
    found = _positioned(spark, path, files) if files else _positioned(spark, path).limit(0)
    return found.where(F.col("pair_id").isin(asked))
