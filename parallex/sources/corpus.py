"""Parallel corpus sources (A1-A3, B1, B2, B4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallex.functions.text import is_row_id
from parallex.operators.lookup import lookup_join
from parallex.session import broadcast_checked

NEVER_SMALL = 1 << 62  # a row count that no broadcast bound admits

# turns of a conversation that an id leaves room for (31 bits: every int turn)
TURN_ROOM = 1 << 31


def turn_id(conv_id: Column, turn: Column) -> Column:
    """One id for a conversation turn; distinct for every 32-bit pair."""
    return (conv_id.cast("long") * F.lit(TURN_ROOM) + turn).cast("long")


def to_pairs(corpus: DataFrame, src: str, trg: str, id_col: str = "pair_id",
             translation_col: str = "translation") -> DataFrame:
    """Corpus rows to ``(pair_id, src_text, trg_text)``; other columns (e.g.
    ``split``) are kept. Either a nested ``translation`` record (map or struct
    keyed by language; only the two languages are read, so Parquet prunes the
    rest of the record) or a flat layout with one column per language (CSV)."""
    if translation_col in corpus.columns:
        tr = F.col(translation_col)
        texts, drop = [tr[src].alias("src_text"), tr[trg].alias("trg_text")], {translation_col}
    else:
        texts, drop = [F.col(src).alias("src_text"), F.col(trg).alias("trg_text")], {src, trg}
    keep = [c for c in corpus.columns if c not in drop | {id_col}]
    return corpus.select(F.col(id_col).cast("long").alias("pair_id"), *texts, *keep)


def corpus_schema(src: str, trg: str, fmt: str, id_col: str = "pair_id") -> T.StructType:
    """The schema a corpus file has when none is given: an id, the two texts
    (nested in ``translation``, or flat for CSV) and the split. Nothing is
    inferred, so no format is read twice."""
    texts = [T.StructField(x, T.StringType()) for x in (src, trg)]
    body = texts if fmt == "csv" else [T.StructField("translation", T.StructType(texts))]
    return T.StructType([T.StructField(id_col, T.LongType()), *body, T.StructField("split", T.StringType())])


def read_pairs(spark: SparkSession, path: str, src: str, trg: str, split: str | None = None,
               fmt: str = "parquet", schema: T.StructType | str | None = None,
               id_col: str = "pair_id", multi_line: bool = False) -> DataFrame:
    """Load a parallel corpus by language pair and split (A1).

    ``split=None`` or ``"all"`` reads every split; any other value becomes a
    filter on the ``split`` column, which is a partition filter when the corpus
    is laid out as ``.../split=<name>/``. Rows need a stable ``id_col``:
    DataFrames have no order, so a position is not an identity. ``multi_line``
    allows line breaks inside quoted CSV fields, at the price of one task per file.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("escape", '"')
        if multi_line:
            reader = reader.option("multiLine", "true")
    if schema is None and fmt != "parquet":  # Parquet files carry their own
        schema = corpus_schema(src, trg, fmt, id_col)
    if schema is not None:
        reader = reader.schema(schema)
    corpus = reader.load(path)
    if split not in (None, "all"):
        corpus = corpus.where(F.col("split") == split)
    return to_pairs(corpus, src, trg, id_col=id_col)


def conversation_pairs(conversations: DataFrame) -> DataFrame:
    """Stand-in corpus: a ``user`` turn with the ``assistant`` turn right after it.

    The equi-join is on the full ``(conv_id, turn)`` key, which is unique, so
    the shuffle is spread evenly even when one conversation is enormous.
    """
    u = conversations.where(F.col("role") == "user").select(
        "conv_id", F.col("turn").alias("u_turn"), (F.col("turn") + 1).alias("turn"),
        F.col("text").alias("src_text"))
    a = conversations.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.col("text").alias("trg_text"))
    return u.join(a, ["conv_id", "turn"], "inner").select(
        turn_id(F.col("conv_id"), F.col("u_turn")).alias("pair_id"),
        "src_text", "trg_text")


def pair_count(pairs: DataFrame) -> DataFrame:
    """Row count of the corpus (A2)."""
    return pairs.agg(F.count(F.lit(1)).cast("long").alias("n_pairs"))


def pair_by_id(pairs: DataFrame, pair_id: int) -> DataFrame:
    """One pair by id (A3); the predicate reaches the Parquet scan."""
    return pairs.where(F.col("pair_id") == F.lit(pair_id))


def pairs_by_ids(pairs: DataFrame, ids: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """Many lookups by id at once (A3, batched): every row of ``ids`` with its
    pair's texts (NULL when there is none). The corpus is first cut down to the
    requested ids by a semi-join against their distinct values (broadcast when
    the count is within the bound, so the corpus is filtered where it is
    scanned), then joined back to the id rows."""
    wanted = broadcast_checked(ids.select(F.col(id_col).alias("pair_id"))
                               .where(F.col("pair_id").isNotNull()).distinct())
    hits = pairs.select("pair_id", "src_text", "trg_text").join(wanted, "pair_id", "left_semi")
    # a popular id is spread over salts; the request rows get a number to tell
    # them apart. Texts are never broadcast: their size is not bounded.
    asked = ids.where(F.col(id_col).isNotNull()).withColumn("_ask", F.monotonically_increasing_id())
    found = lookup_join(asked, F.col(id_col), hits.withColumnRenamed("pair_id", "_hit"), "_hit", "left",
                        small_rows=NEVER_SMALL, salt_source=F.col("_ask")).drop("_ask", "_hit")
    return found.unionByName(ids.where(F.col(id_col).isNull()), allowMissingColumns=True)


def preview(pairs: DataFrame, n: int = 1) -> DataFrame:
    """First ``n`` pairs by id (top-k: one sorted pass, ``n`` rows per task)."""
    return pairs.orderBy("pair_id").limit(n)


def sentences(texts: DataFrame, lang: str, lang_col: str = "lang",
              text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """All sentences of one language (B1) from a long ``(id, lang, text)`` table."""
    return texts.where(F.col(lang_col) == lang).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("sentence"))


def route_inputs(inputs: DataFrame, pairs: DataFrame, input_col: str = "input",
                 key: str = "input_id") -> DataFrame:
    """Translate-style inputs: a numeric string is a pair id, anything else is the
    sentence itself (B4 + A3, batched). An id with no pair gives NULL source
    and ``found = false``; a NULL input routes as text.

    Only id rows take part in the lookup, so text rows never pile up under a
    NULL join key. The corpus is first cut down to the requested ids by a
    semi-join against the distinct ids (broadcast when their count is within
    the bound, so the corpus is filtered where it is scanned instead of being
    shuffled); the small result is then joined back to the id rows.
    """
    tagged = inputs.select(key, F.col(input_col).alias("input"),
                           F.coalesce(is_row_id(F.col(input_col)), F.lit(False)).alias("is_row_id"))
    texts = tagged.where(~F.col("is_row_id")).select(
        key, "input", "is_row_id", F.col("input").alias("source"),
        F.lit("").alias("expected"), F.lit(True).alias("found"))
    id_rows = tagged.where(F.col("is_row_id")).withColumn("pair_id", F.col("input").try_cast("long"))
    ids = (pairs_by_ids(pairs, id_rows)
           .select(key, "input", "is_row_id", F.col("src_text").alias("source"),
                   F.col("trg_text").alias("expected"),
                   F.col("src_text").isNotNull().alias("found")))
    return texts.unionByName(ids)
