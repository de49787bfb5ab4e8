"""Word translation table by expectation-maximisation (I2's scorer).

``p(t | s)`` is the probability that source token ``s`` is translated by target
token ``t`` in a pair; each target token comes from one token of the source or
from the empty word (Brown et al. 1993, model 1). A round shares every target
token out over the source tokens of its pair in proportion to the present table
(E) and divides the shares by their sum for each source token (M). The likelihood
of the corpus never falls from one round to the next.

The pairs are turned into links once: a row per pair and distinct target token,
with the source tokens of the pair. Links are dealt by target token once; a round
is then local but for one sum per source token, because the shares of a target
token (E) read and write the entries ``(s, t)`` of that token alone. Those sums, one number
per source token, are what a task needs of the other tasks; no entry of the
table is shuffled. Above the broadcast bound the rounds are joins.

The best translation of every source token makes a scorer whose output follows
the source word by word; a source token the table does not know is copied.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parallex.config import EOS_ID
from parallex.operators.lookup import lookup_join
from parallex.session import by_key, is_broadcastable, pin, stored, work_partitions

EMPTY_WORD = -1
ROUNDS = 3
TASK_LINKS = 1 << 23  # source tokens, with repeats, that a task holds (4 bytes each)
RUN_LINKS = 1 << 20   # and how many it works on at once, or one target token's if those are more


def links(encoded: DataFrame, src: str = "src_ids", trg: str = "trg_ids") -> DataFrame:
    """``(pair, t, n_t, sources)``: every distinct target token of a pair, how often it
    stands there, and the empty word with the source tokens of the pair, repeats
    included. Rows are named by a generated id."""
    # partitioned by the generated id once: the counts and the join below are local
    rows = pin(by_key(encoded.select(F.monotonically_increasing_id().alias("pair"),
                                     F.concat(F.array(F.lit(EMPTY_WORD)), src).cast("array<int>").alias("sources"), trg), "pair"))
    t = rows.select("pair", F.explode(trg).alias("t")).groupBy("pair", "t").agg(F.count(F.lit(1)).alias("n_t"))
    return t.join(rows.select("pair", "sources").where("sources IS NOT NULL"), "pair").select(
        "pair", F.col("t").cast("int"), F.col("n_t").cast("int"), "sources")


def _single(linked: DataFrame) -> DataFrame:
    """``(pair, s, t, n_s, n_t)``: a row for every distinct source token of a link."""
    return linked.select("pair", "t", "n_t", F.explode("sources").alias("s")).groupBy("pair", "t", "s").agg(
        F.first("n_t").alias("n_t"), F.count(F.lit(1)).cast("int").alias("n_s"))


def _shares(single: DataFrame, table: DataFrame | None) -> DataFrame:
    """Links with ``w``, the weight of the source token, and ``d``, that of all source
    tokens of the pair for the same target token."""
    weighted = single.withColumn("w", F.col("n_s").cast("double")) if table is None else single.join(table.hint("shuffle_hash"), ["s", "t"]).withColumn(
        "w", F.col("n_s") * F.col("p"))
    return weighted.withColumn("d", F.sum("w").over(Window.partitionBy("pair", "t")))


def log_likelihood(linked: DataFrame, table: DataFrame | None) -> float:
    """Of the target tokens under the table (``None``: all equal), up to a constant
    of the corpus."""
    per = _shares(_single(linked), table).groupBy("pair", "t").agg(F.first("d").alias("d"), F.first("n_t").alias("n"))
    return per.agg(F.sum(F.col("n") * F.log("d"))).first()[0] or 0.0


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The rows of a task by target token, about ``RUN_LINKS`` links at a time and no
    token in two runs: ``(t, n_t, sources, first place of each row's sources)``."""
    held = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
    if held is None:
        return
    held = held.combine_chunks()
    t, n = held.column("t").to_numpy(), held.column("n_t").to_numpy()
    lists = held.column("sources").combine_chunks()
    flat, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)])
    order = np.argsort(t, kind="stable")
    size = np.diff(at)[order]
    first = np.flatnonzero(np.r_[True, np.diff(t[order]) != 0])  # of each token
    done = np.concatenate([[0], np.cumsum(size)])[first]  # links before it
    cuts = np.r_[first[np.flatnonzero(np.r_[True, np.diff(done // RUN_LINKS) != 0])], len(order)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        rows, lengths = order[a:b], size[a:b]
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        places = np.repeat(at[rows] - starts, lengths) + np.arange(lengths.sum())
        yield t[rows], n[rows], flat[places], starts


def _rounds(run: tuple[np.ndarray, ...], tokens: np.ndarray, wholes: list[np.ndarray], rounds: int) -> tuple[np.ndarray, ...]:
    """``(place of s in tokens, t, c)``: the shares of the entries of a run in the last
    of ``rounds`` rounds, given the sums of the source tokens in those before."""
    t, n, sources, starts = run
    of_t, row_t = np.unique(t, return_inverse=True)
    lengths = np.diff(np.r_[starts, len(sources)])
    entry, link = np.unique(np.repeat(row_t, lengths) * len(tokens) + np.searchsorted(tokens, sources), return_inverse=True)
    s, p = entry % len(tokens), np.ones(len(entry))
    for k in range(rounds):
        w = p[link]
        c = np.bincount(link, weights=np.repeat(n / np.add.reduceat(w, starts), lengths) * w, minlength=len(entry))
        if k < rounds - 1:
            p = c / wholes[k][s]
    return s, of_t[entry // len(tokens)], c


def translation_table(linked: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(s, t, p)`` after ``rounds`` rounds over ``links``. The links are written once,
    dealt by target token; a task works the earlier rounds out again from the sums
    of the source tokens (9 passes over its links for 3 rounds), so that no
    table is kept between rounds."""
    spark = linked.sparkSession
    total = linked.agg(F.sum(F.size("sources"))).first()[0] or 0
    dealt = pin(linked.select("t", "n_t", "sources").repartition(max(work_partitions(spark), -(-total // TASK_LINKS)), "t"))
    seen = dealt.select(F.explode("sources").alias("s")).distinct()
    if not is_broadcastable(n := seen.count(), 8 * (rounds + 1)):
        return _table_by_joins(linked, rounds)
    tokens = spark.sparkContext.broadcast(np.sort(seen.toArrow().column("s").to_numpy()).astype(np.int32))
    wholes: list[np.ndarray] = []
    for k in range(1, rounds + 1):
        known = spark.sparkContext.broadcast(wholes)

        def sums(batches: Iterator[pa.RecordBatch], k=k, known=known) -> Iterator[pa.RecordBatch]:
            out = np.zeros(len(tokens.value))
            for run in _runs(batches):
                s, _, c = _rounds(run, tokens.value, known.value, k)
                out += np.bincount(s, weights=c, minlength=len(out))
            held = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(out[held])], names=["s", "c"])

        got = dealt.mapInArrow(sums, "s int, c double").groupBy("s").agg(F.sum("c").alias("c")).toArrow()
        wholes.append(np.bincount(got.column("s").to_numpy(), weights=got.column("c").to_numpy(), minlength=n))
    known = spark.sparkContext.broadcast(wholes)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            s, t, c = _rounds(run, tokens.value, known.value, rounds)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.value[s]), pa.array(t), pa.array(c / known.value[-1][s])], names=["s", "t", "p"])

    return dealt.mapInArrow(table, "s int, t int, p double")


def _table_by_joins(linked: DataFrame, rounds: int) -> DataFrame:
    """The same with the sums joined to the shares, for any number of source tokens."""
    single, table = stored(_single(linked)), None
    for _ in range(rounds):
        shares = stored(_shares(single, table).groupBy("s", "t").agg(F.sum(F.col("n_t") * F.col("w") / F.col("d")).alias("c")))
        # a source token's shares are summed map-side first: the empty word has one for every target token
        whole = pin(shares.groupBy(F.col("s").alias("_s")).agg(F.sum("c").alias("whole")))
        table = lookup_join(shares, F.col("s"), whole, "_s", "inner", salt_source=F.col("t")).select(
            "s", "t", (F.col("c") / F.col("whole")).alias("p"))
    return table


def best_translations(table: DataFrame, with_p: bool = False) -> DataFrame:
    """``(s, t[, p])``: the most probable translation of each source token, with its
    probability; probabilities whose logarithms agree to nine places tie, and the lowest id wins."""
    best = table.where(F.col("s") != EMPTY_WORD).groupBy("s").agg(
        F.max_by(F.struct("t", "p"), F.struct(F.round(F.log("p"), 9), -F.col("t"))).alias("_best"))
    return best.select("s", "_best.t", *(["_best.p"] if with_p else []))


class TranslationScorer:
    """Scorer that translates the source word by word, in order: the place of the
    next id names the source token, whose best translation it is; [EOS] follows
    the last one. ``copy`` keeps a token without a translation, else it becomes
    ``unknown``."""

    def __init__(self, table: DataFrame, copy: bool = True, unknown: int = 0):
        self.best = pin(best_translations(table))
        self.copy, self.unknown = copy, unknown

    def prepare(self, prompts: DataFrame) -> DataFrame:
        """The unmasked source ids, up to and with [EOS], instead of the padded input."""
        if "encoder_input" not in prompts.columns:
            return prompts
        n = F.aggregate("encoder_mask", F.lit(0), lambda a, x: a + x)
        return prompts.withColumn("source_ids", F.slice("encoder_input", 2, F.greatest(n - 1, F.lit(0)))).drop("encoder_input", "encoder_mask")

    def _translated(self, rows: DataFrame, key: str, token: str, salt) -> DataFrame:
        small = self.best.select(F.col("s").alias("_s"), F.col("t").alias("_t"))
        out = lookup_join(rows, F.col(token), small, "_s", "left", salt_source=salt)
        else_ = F.col(token) if self.copy else F.lit(self.unknown)
        return out.withColumn("next_id", F.when(F.col(token) == EOS_ID, F.lit(EOS_ID)).otherwise(F.coalesce("_t", else_)).cast("int"))

    def __call__(self, frontier: DataFrame) -> DataFrame:
        key, ids = frontier.columns[0], frontier.columns[1]
        rows = frontier.select(key, F.try_element_at("source_ids", F.size(ids)).alias("_token")).where("_token IS NOT NULL")
        return self._translated(rows, key, "_token", F.col(key)).select(key, "next_id", F.lit(0.0).alias("score"))

    def walk(self, prompts: DataFrame, max_len: int, eos: int = EOS_ID, key: str = "seq_id", ids: str = "ids") -> DataFrame:
        """All places at once: no step of this scorer depends on the one before."""
        extra = [c for c in prompts.columns if c not in (key, ids)]
        last = F.try_element_at(ids, F.lit(-1))
        wanted = F.when((F.size(ids) > 0) & (last != eos),
                        F.slice("source_ids", F.greatest(F.size(ids), F.lit(1)), F.greatest(F.lit(max_len) - F.size(ids), F.lit(0))))
        rows = pin(prompts.withColumn("_rid", F.monotonically_increasing_id()).withColumn("_wanted", wanted))
        tokens = rows.select("_rid", F.posexplode("_wanted").alias("place", "_token"))
        moved = self._translated(tokens, "_rid", "_token", F.xxhash64("_rid", "place"))
        added = moved.groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct("place", "next_id"))).alias("a")).select(
            "_rid", F.transform("a", lambda r: r["next_id"]).alias("_added"))
        out = rows.join(added, "_rid", "left").withColumn("_added", F.coalesce("_added", F.array().cast("array<int>")))
        return out.select(key, F.concat(ids, "_added").alias(ids), *extra, F.size("_added").alias("steps"))
