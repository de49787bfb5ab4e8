"""Helpers shared by the training-data operators.

Words are runs of bytes outside ``\\x20 \\x09-\\x0D``; for bytes that is exactly
what ``bytes.split()`` returns, so the operators work on the UTF-8 encoding and
never depend on Unicode white space.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallex.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20  # texts handled together inside a task


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_key(text: Column) -> Column:
    """128-bit identity of a text (NULL counts as the empty text)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of ``df`` whose names (in any case) are not among ``names``."""
    low = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in low]


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named ``_in0``, ``_in1``, ...: whatever an operator
    adds or replaces then cannot clash with them."""
    return docs.select(*[F.col(c).alias(f"_in{i}") for i, c in enumerate(docs.columns)])


def at(docs: DataFrame, name: str) -> str:
    """The name that ``numbered`` gives to a column."""
    return f"_in{docs.columns.index(name)}"


def named(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names again."""
    return out.select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(docs.columns)])


def binary(column: pa.Array) -> list:
    """The UTF-8 bytes (or None) of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts in ``column`` of one slice hold about SLICE_BYTES."""
    start, size = 0, 0
    for i, v in enumerate(batch.column(column)):
        n = len(v.as_buffer() or b"") if v.is_valid else 0
        if size and size + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def add_columns(df: DataFrame, text: str, fn: Callable[[list], Sequence[Sequence]], ddl: str,
                drop: Sequence[str] = ()) -> DataFrame:
    """Append the columns of ``ddl`` computed by ``fn(texts)`` in Arrow batches.

    ``fn`` gets the UTF-8 bytes (None for NULL) of column ``text`` and returns
    one sequence per new column. An input column with the name of a new one is
    replaced; columns in ``drop`` are not sent back.
    """
    new = T.StructType.fromDDL(ddl)
    keep = without(df, [*new.names, *drop])
    schema = T.StructType([df.schema[c] for c in keep] + list(new))
    cols = keep if text in keep else [*keep, text]
    at = cols.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        out = to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, at):
                got = fn(binary(part.column(at)))
                arrays = [part.column(i) for i in range(len(keep))]
                arrays += [pa.array(g, out.field(len(keep) + i).type) for i, g in enumerate(got)]
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, out, strict=True)],
                    names=schema.names)

    return df.select(*cols).mapInArrow(run, schema)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder of the session and read
    back: lineage ends here, columns can still be pruned."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
