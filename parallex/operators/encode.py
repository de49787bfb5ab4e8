"""Encode text to ids (C1) and decode ids to text (C3) with a vocabulary table.

Plan: every row gets a generated row id and the input is hash-partitioned by it
once. Its tokens and, once, the row itself are then laid out as one stream, the
tokens are looked up with a broadcast join (vocabulary size measured first) and
everything is regrouped per row id. Explode and broadcast join keep the
partitioning, so the input is evaluated once and shuffled once, rows need no key
of their own (a NULL or repeated one is fine), and nothing is joined back. A
vocabulary above the broadcast bound falls back to a shuffle join in which each
hot token is split over several salts (see ``operators.lookup``).

Decoding by a vocabulary within that bound, whose ids count up from 0, takes none
of this: a task looks up the ids of its rows in an array and joins their tokens,
whole Arrow arrays at a time, and the rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallex.config import UNK_ID
from parallex.functions.text import cuts, joiner, tokenize
from parallex.operators.lookup import lookup_join
from parallex.operators.subword import joined
from parallex.operators.vocab import VOCAB_SCHEMA
from parallex.operators.vocab import vocab_stats as measure
from parallex.session import by_key, is_broadcastable

_ROW = -1  # the side of a stream row that carries its input row
_IDS = [T.ArrayType(t(), nulls) for t in (T.IntegerType, T.LongType) for nulls in (True, False)]
UNKNOWN = "[UNK]"
GAPS = 8  # ids may reach so many times the entries' number
TOGETHER = 1 << 20  # ids that are looked up together


def _stream(df: DataFrame, arrays: list[Column], by: Sequence[str]) -> DataFrame:
    """``(_rid, side, pos, item, _row, *by)``: one row per token of each side, and
    one with the input row itself."""
    parted = by_key(df.withColumn("_rid", F.monotonically_increasing_id()), "_rid")
    kind = arrays and df.select(arrays[0].alias("a")).schema["a"].dataType
    none = F.array(F.lit(None)).cast(kind)
    sides = [F.struct(F.lit(_ROW).alias("side"), none.alias("items"))]
    sides += [F.struct(F.lit(i).alias("side"), a.alias("items")) for i, a in enumerate(arrays)]
    row = F.struct(*df.columns)
    return (parted.select("_rid", *[F.col(b).alias(f"_by_{b}") for b in by], row.alias("_in"), F.inline(F.array(*sides)))
            .select("_rid", *[f"_by_{b}" for b in by], "side", F.when(F.col("side") == _ROW, F.col("_in")).alias("_row"),
                    F.posexplode("items").alias("pos", "item")))


def _looked_up(stream: DataFrame, small: DataFrame, small_key: str, by: Sequence[str],
               stats: tuple[int, int]) -> DataFrame:
    """The stream with the columns of ``small``; a hot item's rows differ in their
    row id and place, which spreads them over its salts."""
    rows, row_bytes = stats
    if by:
        pair = F.struct(*[F.col(f"_by_{b}") for b in by], F.col("item").alias(small_key))
        small = small.select(F.struct(*by, small_key).alias("_pair"), *[c for c in small.columns if c not in by])
        key, small_key = pair, "_pair"
    else:
        key = F.col("item")
    salt = F.xxhash64("_rid", "side", "pos")
    if is_broadcastable(rows, row_bytes):
        return lookup_join(stream, key, small, small_key, "left", small_rows=rows, row_bytes=row_bytes)
    # the carried rows have no item: keep them out of the shuffle join
    looked = lookup_join(stream.where(F.col("side") != _ROW), key, small, small_key, "left",
                         small_rows=rows, row_bytes=row_bytes, salt_source=salt)
    return looked.unionByName(stream.where(F.col("side") == _ROW), allowMissingColumns=True)


def _regroup(looked: DataFrame, value: Column, columns: list[str], outs: list[str]) -> DataFrame:
    """Input columns (without ``outs``) and one array per side, in token order."""
    aggs = [F.array_sort(F.collect_list(F.when(F.col("side") == i, F.struct("pos", value.alias("v"))))).alias(f"_o{i}")
            for i in range(len(outs))]
    grouped = looked.groupBy("_rid").agg(F.first("_row", ignorenulls=True).alias("_row"), *aggs)
    return grouped.select(*[F.col("_row")[c].alias(c) for c in columns if c not in outs],
                          *[F.transform(f"_o{i}", lambda s: s["v"]).alias(o) for i, o in enumerate(outs)])


def _check_groups(vocab: DataFrame, by: Sequence[str]) -> None:
    extra = [c for c in vocab.columns if c not in VOCAB_SCHEMA.names and c not in by]
    if extra:
        raise ValueError(f"the vocabulary is grouped by {extra}; name these columns in `by`")


def encode(df: DataFrame, columns: Mapping[str, str], vocab: DataFrame, mode: str = "word",
           unk: int = UNK_ID, by: Sequence[str] = (),
           vocab_stats: tuple[int, int] | None = None) -> DataFrame:
    """Add one ``array<int>`` column per ``{out_col: text_col}``; unknown tokens map
    to ``unk``; an empty or NULL text gives ``[]``. Only real tokens are looked
    up, so a literal "[PAD]" in a text is unknown, and the ids never contain
    PAD, SOS or EOS (masks compare ids with PAD). ``by`` names the group columns
    of a vocabulary built with ``by``; ``df`` has them too."""
    _check_groups(vocab, by)
    stats = vocab_stats or measure(vocab, by)
    stream = _stream(df, [tokenize(F.col(t), mode) for t in columns.values()], by)
    small = vocab.where(~F.col("is_special")).select(*by, F.col("token").alias("_tok"), F.col("id").alias("_id"))
    looked = _looked_up(stream, small, "_tok", by, stats)
    return _regroup(looked, F.coalesce("_id", F.lit(unk)).cast("int"), df.columns, list(columns))


def encode_sides(df: DataFrame, columns: Mapping[str, str], vocabs: Mapping[str, DataFrame], mode: str = "word",
                 unk: int = UNK_ID) -> DataFrame:
    """``encode`` with a vocabulary of its own for each output column. The
    vocabularies are stacked with their column's name, so the rows still take
    one exchange."""
    stacked, rows, size = None, 0, 0
    for i, out in enumerate(columns):
        _check_groups(vocabs[out], ())
        n, row_bytes = measure(vocabs[out])
        rows, size = rows + n, max(size, row_bytes)
        part = vocabs[out].where(~F.col("is_special")).select(
            F.lit(i).alias("_side"), F.col("token").alias("_tok"), F.col("id").alias("_id"))
        stacked = part if stacked is None else stacked.unionByName(part)
    stream = _stream(df, [tokenize(F.col(t), mode) for t in columns.values()], ()).withColumn("_by__side", F.col("side"))
    looked = _looked_up(stream, stacked, "_tok", ["_side"], (rows, size + 4))
    return _regroup(looked, F.coalesce("_id", F.lit(unk)).cast("int"), df.columns, list(columns))


def _row_local(vocab: DataFrame, mode: str, strip_special: bool) -> Callable[[Column], Column] | None:
    """Id arrays to texts inside each task. None where an id is negative, repeated (the
    join keeps each of its tokens) or far above the entries' number."""
    rows = sorted((r["id"], UNKNOWN if r["token"] is None else r["token"], bool(r["is_special"]))
                  for r in vocab.where("id IS NOT NULL").select("id", "token", "is_special").collect())
    ids = [i for i, _, _ in rows]
    if len(set(ids)) < len(ids) or (ids and (ids[0] < 0 or ids[-1] > GAPS * len(ids))):
        return None
    shared = vocab.sparkSession.sparkContext.broadcast(rows)
    separator = "" if mode == "subword" else joiner(mode)

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows = shared.value
        top = rows[-1][0] + 1 if rows else 0  # any other id goes there
        places = np.full(top + 1, len(rows))
        places[[i for i, _, _ in rows]] = np.arange(len(rows))
        tokens = pa.array([t for _, t, _ in rows] + [UNKNOWN], pa.string())
        octets = pc.binary_length(tokens).to_numpy().astype(np.int64) + len(separator)
        kept = ~np.array([strip_special and special for _, _, special in rows] + [False])
        for batch in batches:
            for lo, hi in cuts(np.cumsum(pc.fill_null(pc.list_value_length(batch), 0).to_numpy(), dtype=np.int64), TOGETHER):
                rows_ids = batch.slice(lo, hi - lo)
                ends = np.cumsum(pc.fill_null(pc.list_value_length(rows_ids), 0).to_numpy(), dtype=np.int64)
                found = places[np.clip(pc.fill_null(rows_ids.flatten(), -1).to_numpy(), -1, top)]
                if not kept.all():
                    stay = kept[found]
                    found, ends = found[stay], np.concatenate([[0], np.cumsum(stay)])[ends]
                ends = np.concatenate([[0], ends])
                for at, to in cuts(np.concatenate([[0], np.cumsum(octets[found])])[ends[1:]]):
                    lists = pa.ListArray.from_arrays(pa.array(ends[at:to + 1] - ends[at], pa.int32()),
                                                     tokens.take(pa.array(found[ends[at]:ends[to]])))
                    out = pc.binary_join(lists, separator)
                    # as ``joined`` does
                    yield pc.if_else(pc.starts_with(out, " "), pc.utf8_slice_codeunits(out, 1), out) if mode == "subword" else out

    return text


def decode(df: DataFrame, columns: Mapping[str, str], vocab: DataFrame, mode: str = "word",
           strip_special: bool = False, by: Sequence[str] = (),
           vocab_stats: tuple[int, int] | None = None) -> DataFrame:
    """Add one text column per ``{out_col: ids_col}``. Special tokens are kept
    unless ``strip_special``; an id missing from the vocabulary decodes to [UNK];
    a NULL array decodes to an empty text. ``mode`` is that of the encoding, or
    ``subword``."""
    _check_groups(vocab, by)
    outs = list(columns)
    stats = vocab_stats or measure(vocab, by)
    whole = all(df.select(F.col(c).alias("a")).schema["a"].dataType in _IDS for c in columns.values())
    # as Python objects an entry takes several times its bytes
    local = _row_local(vocab, mode, strip_special) if whole and not by and is_broadcastable(stats[0], 16 * stats[1]) else None
    if local:
        return df.select(*[c for c in df.columns if c not in outs], *[local(F.col(c)).alias(o) for o, c in columns.items()])
    stream = _stream(df, [F.coalesce(F.col(c), F.array().cast("array<int>")) for c in columns.values()], by)
    small = vocab.select(*by, F.col("id").alias("_id"), F.col("token").alias("_tok"), F.col("is_special").alias("_special"))
    looked = _looked_up(stream, small, "_id", by, stats)
    if strip_special:
        looked = looked.where((F.col("side") == _ROW) | ~F.coalesce(F.col("_special"), F.lit(False)))
    toks = _regroup(looked, F.coalesce("_tok", F.lit(UNKNOWN)), df.columns, outs)
    back = joined if mode == "subword" else lambda o: F.array_join(o, joiner(mode))
    return toks.select(*[c for c in toks.columns if c not in outs], *[back(F.col(o)).alias(o) for o in outs])


def encode_with(df: DataFrame, columns: Mapping[str, str], tokenizer) -> DataFrame:
    """Encode with a user tokenizer: ``tokenizer(Column) -> Column`` of
    ``array<int>``, typically a ``pandas_udf``. Row-local (no shuffle), so it
    also runs on a streaming DataFrame."""
    out = df
    for o, t in columns.items():
        out = out.withColumn(o, tokenizer(F.col(t)))
    return out
