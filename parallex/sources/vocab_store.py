"""Get-or-build vocabulary on disk (A4).

A vocabulary is built in a folder of its own and moved to its path in one rename
that fails where something is. So a reader sees a whole vocabulary or none, and of
several builders at once the first to finish sets it; the others drop theirs and
read the stored one.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from parallex.operators.vocab import VOCAB_SCHEMA, build_vocab


def _place(spark: SparkSession, path: str):
    """The file system of ``path``, and ``path`` with its scheme."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hpath)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, _ = _place(spark, path)
    return fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))


def _moved(spark: SparkSession, source: str, path: str) -> bool:
    """Rename ``source`` to ``path``; False if ``path`` is there already."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    _, a = _place(spark, source)
    _, b = _place(spark, path)
    context = hadoop.FileContext.getFileContext(b.toUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(a, b, sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def get_or_build_vocab(spark: SparkSession, path: str, texts: DataFrame, text_col: str = "text",
                       mode: str = "word", min_count: int = 1, max_size: int | None = None) -> DataFrame:
    """Read the vocabulary at ``path`` if a complete one is there; otherwise build
    it from ``texts``, write it, and read it back (so callers always get the
    stored rows, and later runs reuse them). Something else at ``path`` is an error."""
    if not _exists(spark, path):
        own = f"{path.rstrip('/')}.building-{uuid.uuid4().hex}"
        build_vocab(texts, text_col, mode, min_count, max_size).write.parquet(own)
        if not _moved(spark, own, path):
            fs, mine = _place(spark, own)
            fs.delete(mine, True)
            if not _exists(spark, path):
                raise FileExistsError(f"{path} is there, but it is no complete vocabulary")
    return spark.read.schema(VOCAB_SCHEMA).parquet(path)
