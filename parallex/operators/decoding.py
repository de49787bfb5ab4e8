"""Batch greedy decoding (I1) and batch translation (I2).

A *scorer* is any ``DataFrame -> DataFrame`` function: it receives the active
frontier ``(key, ids, ...)`` (the sequence key first, under the caller's name)
and returns candidates ``(key, next_id, score)`` under the same key name.
Greedy decoding keeps the best candidate per sequence (ties: lowest id),
appends it, and stops a sequence on [EOS] (kept) or when it reaches
``max_len`` tokens, [SOS] included.

Three plans:

* a scorer with ``walk`` decodes whole sequences by joins of its own: a scorer
  whose next id follows from a bounded state goes by path doubling, one that
  reads the source word by word translates all places at once;
* a *row-local* scorer (``row_local``: a step function of one sequence, with a
  model small enough to broadcast) decodes every sequence to its end inside its
  Arrow batch: one pass over the prompts, no shuffle;
* the general loop, a frontier join per step, for any other scorer. Several
  steps are chained into one job; lineage is cut and finished rows are set aside
  at a checkpoint in the shared folder every few steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallex.config import EOS_ID, SOS_ID
from parallex.functions import arrays as A
from parallex.operators.lookup import lookup_join
from parallex.session import is_broadcastable, pin, stored, work_partitions

Scorer = Callable[[DataFrame], DataFrame]
SOURCE_CLASSES = 32
BACK_OFF = -1  # the class of the rows that hold for every source


def source_class(encoder_input: Column, mask: Column, classes: int = SOURCE_CLASSES) -> Column:
    """What the stand-in model knows of a source: a class made of the unmasked
    ids of its encoder input."""
    ids = F.zip_with(encoder_input, mask, lambda x, m: (x * m).cast("long"))
    return F.pmod(F.aggregate(ids, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(classes)).cast("int")


def bigram_scores(encoded: DataFrame, ids: str = "trg_ids", sos: int = SOS_ID,
                  eos: int = EOS_ID, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, prev_id, next_id, score)``: counts of consecutive ids in
    ``[SOS] + ids + [EOS]`` (partial + final aggregate)."""
    seqs = encoded.select(*by, F.concat(F.array(F.lit(sos)), F.col(ids), F.array(F.lit(eos))).alias("_seq"))
    seq = F.col("_seq")  # a column reference: the lambda below captures it
    steps = F.transform(F.sequence(F.lit(1), F.size(seq) - 1),
                        lambda i: F.struct(F.element_at(seq, i).alias("prev_id"),
                                           F.element_at(seq, i + 1).alias("next_id")))
    return (seqs.select(*by, F.inline(steps)).groupBy(*by, "prev_id", "next_id")
            .agg(F.count(F.lit(1)).cast("double").alias("score")))


def best_next(next_scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Best next id per previous id (highest score, then lowest id)."""
    return next_scores.groupBy(*by, "prev_id").agg(
        F.max_by("next_id", F.struct("score", -F.col("next_id"))).alias("next_id"))


class BigramStep:
    """The next id of one sequence: the best after its last id for its source
    class, else for any source."""

    columns = ("src_class",)

    def __init__(self, table: dict[tuple[int, int], int]):
        self.table = table

    def __call__(self, ids: list[int], src_class: int | None) -> int | None:
        if not ids:
            return None
        found = self.table.get((src_class, ids[-1]))
        return self.table.get((BACK_OFF, ids[-1])) if found is None else found


class BigramScorer:
    """Scorer over a ``([src_class,] prev_id, next_id, score)`` table: the state is
    the source class and the last id, with back-off to the last id alone.
    Returns only the arg-max candidate per sequence (exact for greedy decoding)."""

    def __init__(self, next_scores: DataFrame):
        self.classed = "src_class" in next_scores.columns
        self.next_scores = next_scores
        self._best: DataFrame | None = None

    def best(self) -> DataFrame:
        """``(src_class, prev_id, next_id)``, written once; class ``BACK_OFF`` holds
        for every source."""
        if self._best is None:
            every = best_next(self.next_scores.groupBy("prev_id", "next_id").agg(F.sum("score").alias("score")))
            best = every.select(F.lit(BACK_OFF).alias("src_class"), "prev_id", "next_id")
            if self.classed:
                best = best.unionByName(best_next(self.next_scores, ["src_class"]))
            self._best = pin(best)
        return self._best

    def prepare(self, prompts: DataFrame) -> DataFrame:
        """Reduce the encoder input and mask of a prompt to the state they give."""
        arrays = ("encoder_input", "encoder_mask")
        if all(c in prompts.columns for c in arrays):
            cls = source_class(F.col("encoder_input"), F.col("encoder_mask"))
            return prompts.withColumn("src_class", cls).drop(*arrays)
        return prompts if "src_class" in prompts.columns else prompts.withColumn("src_class", F.lit(BACK_OFF))

    def row_local(self) -> BigramStep | None:
        """The table as a broadcastable step function, if its measured size allows."""
        best = self.best()
        if not is_broadcastable(best.count(), row_bytes=200):  # as Python objects
            return None
        return BigramStep({(r[0], r[1]): r[2] for r in best.collect()})

    def jumps(self) -> DataFrame:
        """``(src_class, prev_id, next_id)`` for every class and id: the class's own
        next id, else the one that holds for every source."""
        best = self.best()
        own = best.where(F.col("src_class") != BACK_OFF).withColumnRenamed("next_id", "_own")
        classes = F.array(*[F.lit(c) for c in (BACK_OFF, *range(SOURCE_CLASSES))])
        every = best.where(F.col("src_class") == BACK_OFF).select(F.explode(classes).alias("src_class"), "prev_id", "next_id")
        return every.join(own, ["src_class", "prev_id"], "left").select(
            "src_class", "prev_id", F.coalesce("_own", "next_id").alias("next_id"))

    def _moves(self, states: DataFrame) -> DataFrame:
        """``(src_class, prev_id, next_id)`` for few distinct states ``(src_class,
        prev_id)``: the states travel to the table, which stays where it is."""
        to = F.broadcast(states.select(F.col("src_class").alias("_c"), F.col("prev_id").alias("_p")))
        best = self.best()
        hit = best.join(to, (best["prev_id"] == F.col("_p")) & (best["src_class"].isin(BACK_OFF) | (best["src_class"] == F.col("_c"))))
        return hit.groupBy(F.col("_c").alias("src_class"), F.col("_p").alias("prev_id")).agg(
            F.max_by("next_id", best["src_class"]).alias("next_id"))  # the class's own comes after BACK_OFF

    def _reached(self, starts: DataFrame, max_len: int, eos: int) -> DataFrame | None:
        """The jumps of the states that lie on a path from ``starts``, found step by
        step until no state is new; ``None`` if their bound is above the broadcast bound."""
        if not is_broadcastable(starts.count() * max_len, row_bytes=200):  # as Python objects
            return None
        spark, schema = starts.sparkSession, "src_class int, prev_id int"
        new, found = {tuple(r) for r in starts.collect()}, {}
        for _ in range(max_len):
            if not new:
                break
            got = self._moves(spark.createDataFrame(sorted(new), schema)).collect()
            found |= {(r["src_class"], r["prev_id"]): r["next_id"] for r in got}
            new = {(r["src_class"], r["next_id"]) for r in got if r["next_id"] != eos} - found.keys()
        return spark.createDataFrame([(*k, n) for k, n in sorted(found.items())], schema + ", next_id int")

    def walk(self, prompts: DataFrame, max_len: int, eos: int = EOS_ID, key: str = "seq_id", ids: str = "ids") -> DataFrame:
        """Decode by path doubling on the graph of states (class, last id).

        Only distinct states are decoded, and where their paths are few in all, only
        the jumps on them are doubled. When the first ``2**k`` places of their
        paths are known, one join with the jumps of ``2**k`` steps gives as many
        more, and one join of the jumps with themselves doubles them: about
        ``log2(max_len)`` rounds, whatever the size of the score table.
        """
        state = F.coalesce("src_class", F.lit(BACK_OFF))
        last = F.try_element_at(ids, F.lit(-1))
        goes = (F.size(ids) > 0) & (F.size(ids) < max_len) & (last != eos)
        open_ = prompts.withColumn("_state", F.when(goes, F.struct(state.alias("src_class"), last.alias("start"))))
        paths = pin(open_.where("_state IS NOT NULL").select("_state.*").distinct().select(
            "src_class", "start", F.lit(0).alias("place"), F.col("start").alias("id")))
        reached = self._reached(paths.select("src_class", F.col("start").alias("prev_id")), max_len, eos)
        jump, k = pin(self.jumps()) if reached is None else reached, 1
        while k < max_len:
            further = paths.join(jump, (paths["src_class"] == jump["src_class"]) & (paths["id"] == jump["prev_id"])).where(
                F.col("place") + k < max_len).select(paths["src_class"], "start", (F.col("place") + k).alias("place"), F.col("next_id").alias("id"))
            paths = pin(paths.unionByName(further))
            if 2 * k < max_len:
                then = jump.select(F.col("src_class").alias("_c"), F.col("prev_id").alias("_p"), F.col("next_id").alias("_n"))
                jump = pin(jump.join(then, (F.col("src_class") == F.col("_c")) & (F.col("next_id") == F.col("_p"))).select(
                    "src_class", "prev_id", F.col("_n").alias("next_id")))
            k *= 2
        tails = paths.where("place > 0").groupBy("src_class", "start").agg(
            F.array_sort(F.collect_list(F.struct("place", "id"))).alias("t")).select(
            F.struct("src_class", "start").alias("_from"), F.transform("t", lambda r: r["id"]).alias("_tail"))
        # all prompts share a few states: a row holds a path of up to max_len ids
        out = lookup_join(open_, F.col("_state"), tails, "_from", "left", row_bytes=8 * max_len + 64, salt_source=F.col(key))
        added = F.coalesce(F.slice("_tail", 1, F.greatest(F.lit(max_len) - F.size(ids), F.lit(0))), F.array().cast("array<int>"))
        extra = [c for c in prompts.columns if c not in (key, ids)]
        return out.select(key, F.concat(ids, added).alias(ids), *extra, F.size(added).alias("steps"))

    def __call__(self, frontier: DataFrame) -> DataFrame:
        key, ids = frontier.columns[0], frontier.columns[1]
        last = frontier.select(key, F.struct(F.coalesce("src_class", F.lit(BACK_OFF)).alias("src_class"),
                                             F.try_element_at(ids, F.lit(-1)).alias("prev_id")).alias("_at"))
        # sequences share states: the table is asked once for each
        states = pin(last.select("_at.*").distinct())
        n = states.count()
        if is_broadcastable(n):
            moves = self._moves(states)
        else:
            moves = states.join(self.jumps(), ["src_class", "prev_id"])
        moves = moves.select(F.struct("src_class", "prev_id").alias("_state"), "next_id")
        out = lookup_join(last, F.col("_at"), moves, "_state", "left", small_rows=n, salt_source=F.col(key))
        return out.select(key, "next_id", F.lit(0.0).alias("score")).where("next_id is not null")


def ngram_scores(encoded: DataFrame, ids: str = "trg_ids", order: int = 3, sos: int = SOS_ID, eos: int = EOS_ID) -> DataFrame:
    """``(context, next_id, n)``: counts of every id after each of its contexts, the
    last ``0`` to ``order - 1`` ids before it in ``[SOS] + ids + [EOS]``."""
    seq = F.col("_seq")
    at = F.sequence(F.lit(2), F.size(seq))

    def after(k: int) -> Callable[[Column], Column]:
        return lambda i: F.struct(F.slice(seq, F.greatest(i - k, F.lit(1)), k).alias("context"), (i > k).alias("whole"),
                                  F.element_at(seq, i).alias("next_id"))
    seen = [F.transform(at, after(k)) for k in range(order)]
    return (encoded.select(F.concat(F.array(F.lit(sos)), F.col(ids), F.array(F.lit(eos))).alias("_seq"))
            .select(F.inline(F.concat(*seen))).where("whole").groupBy("context", "next_id").agg(F.count(F.lit(1)).alias("n")))


class NgramStep:
    """The next id of one sequence: the most frequent one after the longest context
    of it that was seen."""

    columns = ()

    def __init__(self, table: dict[tuple[int, ...], int], order: int):
        self.table, self.order = table, order

    def __call__(self, ids: list[int]) -> int | None:
        for k in range(min(self.order - 1, len(ids)), -1, -1):
            found = self.table.get(tuple(ids[len(ids) - k:]))
            if found is not None:
                return found
        return None


class NgramScorer:
    """Scorer over n-gram counts with back-off. The frontier carries the whole
    prefix; a step reads its last ``order - 1`` ids and falls back to shorter
    contexts, down to the most frequent id of all."""

    def __init__(self, counts: DataFrame, order: int = 3):
        self.order = order
        # most frequent next id of each context; ties to the lowest id
        self.best = stored(counts.groupBy("context").agg(F.max_by("next_id", F.struct("n", -F.col("next_id"))).alias("next_id")))

    def row_local(self) -> NgramStep | None:
        if not is_broadcastable(self.best.count(), row_bytes=200 + 40 * self.order):  # as Python objects
            return None
        return NgramStep({tuple(r["context"]): r["next_id"] for r in self.best.collect()}, self.order)

    def _tail(self, ids: Column) -> Column:
        m = self.order - 1
        return F.slice(ids, F.greatest(F.size(ids) - m + 1, F.lit(1)), m)

    def _longest(self, tails: DataFrame, states: DataFrame) -> DataFrame:
        """``(tail, at)``: the state of the longest seen context that each tail ends in."""
        cuts = F.transform(F.sequence(F.lit(0), F.size("tail")), lambda k: F.slice("tail", F.size("tail") - k + 1, k))
        return (tails.select("tail", F.explode(cuts).alias("context")).join(states, "context")
                .groupBy("tail").agg(F.max_by("at", F.size("context")).alias("at")))

    def walk(self, prompts: DataFrame, max_len: int, eos: int = EOS_ID, key: str = "seq_id", ids: str = "ids") -> DataFrame:
        """Decode by path doubling, as ``BigramScorer.walk``: a state is the longest
        seen context that a sequence ends in, and its jump leads to the state after
        its best next id. States are numbered, so that a jump is two numbers and an id;
        only states that a jump or a prompt leads to are doubled."""
        best = stored(self.best.withColumn("at", F.monotonically_increasing_id()))
        states = best.select("context", "at")
        last = F.try_element_at(ids, F.lit(-1))
        goes = (F.size(ids) > 0) & (F.size(ids) < max_len) & (last != eos)
        open_ = prompts.withColumn("_tail", F.when(goes, self._tail(F.col(ids))))
        starts = pin(self._longest(open_.where("_tail IS NOT NULL").select(F.col("_tail").alias("tail")).distinct(), states))
        goal = F.when(F.col("next_id") != eos, self._tail(F.concat("context", F.array("next_id"))))
        aimed = best.select("at", "next_id", goal.alias("goal"))
        jump = stored(aimed.join(states.select(F.col("context").alias("goal"), F.col("at").alias("to")), "goal", "left"))
        # none where the counts come from whole sequences: what followed a context is a context, or ends
        lost = pin(jump.where("to IS NULL AND goal IS NOT NULL").select("at", "next_id", F.col("goal").alias("tail")))
        if not lost.isEmpty():
            seen = self._longest(lost.select("tail").distinct(), states).withColumnRenamed("at", "to")
            found = lost.join(seen, "tail", "left").select("at", "next_id", "to")
            jump = jump.where("to IS NOT NULL OR goal IS NULL").select("at", "next_id", "to").unionByName(found)
        jump = jump.select("at", F.col("next_id").alias("id"), "to")
        led = jump.select(F.col("to").alias("at")).unionByName(starts.select("at")).distinct()
        jump, k = stored(jump.join(led, "at", "left_semi")), 1
        paths = stored(starts.select(F.col("at").alias("start")).distinct().select(
            "start", F.lit(0).alias("place"), F.lit(None).cast("int").alias("id"), F.col("start").alias("to")))
        while k < max_len:
            then = jump.select(F.col("at").alias("_at"), F.col("id").alias("_id"), F.col("to").alias("_to"))
            further = paths.where(F.col("place") + k < max_len).join(then, F.col("to") == F.col("_at")).select(
                "start", (F.col("place") + k).alias("place"), F.col("_id").alias("id"), F.col("_to").alias("to"))
            paths = paths.unionByName(stored(further))
            if 2 * k < max_len:
                jump = stored(jump.join(then, F.col("to") == F.col("_at")).select("at", F.col("_id").alias("id"), F.col("_to").alias("to")))
            k *= 2
        tails = paths.where("place > 0").groupBy(F.col("start").alias("at")).agg(
            F.array_sort(F.collect_list(F.struct("place", "id"))).alias("t"))
        tails = starts.join(tails, "at").select(F.col("tail").alias("_from"), F.transform("t", lambda r: r["id"]).alias("_added"))
        # prompts share tails: a row holds a path of up to max_len ids
        out = lookup_join(open_, F.col("_tail"), tails, "_from", "left", row_bytes=8 * max_len + 64, salt_source=F.col(key))
        added = F.coalesce(F.slice("_added", 1, F.greatest(F.lit(max_len) - F.size(ids), F.lit(0))), F.array().cast("array<int>"))
        extra = [c for c in prompts.columns if c not in (key, ids)]
        return out.select(key, F.concat(ids, added).alias(ids), *extra, F.size(added).alias("steps"))

    def __call__(self, frontier: DataFrame) -> DataFrame:
        key, ids = frontier.columns[0], frontier.columns[1]
        n, out, names = self.best.count(), frontier.select(key, ids), []
        for k in range(self.order - 1, -1, -1):
            # a context longer than the prefix matches nothing
            context = F.when(F.size(ids) >= k, F.slice(ids, F.greatest(F.size(ids) - k + 1, F.lit(1)), k))
            small = self.best.where(F.size("context") == k).select(F.col("context").alias(f"_c{k}"), F.col("next_id").alias(f"_n{k}"))
            out = lookup_join(out, context, small, f"_c{k}", "left", small_rows=n, salt_source=F.col(key))
            names.append(f"_n{k}")
        return out.select(key, F.coalesce(*names).alias("next_id"), F.lit(0.0).alias("score")).where("next_id is not null")


def row_local(step: Callable, columns: Sequence[str] = ()) -> Scorer:
    """Declare ``step(ids, *values of columns) -> next id or None`` a row-local
    scorer. The function, with whatever model it holds, is broadcast."""
    class Local:
        def row_local(self):
            step.columns = tuple(columns)
            return step
    return Local()


def pandas_scorer(fn, schema: str | None = None):
    """Wrap ``fn(pandas.DataFrame frontier) -> pandas.DataFrame candidates`` as a
    scorer. It runs per Arrow batch inside ``mapInPandas`` (the plug point for a
    neural model); the frontier it sees has the key, ``ids`` and any extra
    prompt columns. The candidates schema defaults to
    ``<key> long, next_id int, score double``."""
    def scorer(frontier: DataFrame) -> DataFrame:
        def run(batches):
            for pdf in batches:
                yield fn(pdf)
        out_schema = schema or f"{frontier.columns[0]} long, next_id int, score double"
        return frontier.mapInPandas(run, out_schema)
    return scorer


def _finish_flags(ids, max_len: int, eos: int):
    return F.coalesce(F.try_element_at(ids, F.lit(-1)) == F.lit(eos), F.lit(False)) | (F.size(ids) >= max_len)


def greedy_decode(prompts: DataFrame, scorer: Scorer, max_len: int, eos: int = EOS_ID,
                  key: str = "seq_id", ids: str = "ids", checkpoint_every: int = 4) -> DataFrame:
    """Decode every prompt; returns ``(key, ids, ..., steps)`` (``steps`` = tokens
    added; other prompt columns are kept). An empty prompt gets no token."""
    if hasattr(scorer, "prepare"):
        prompts = scorer.prepare(prompts)
    step = scorer.row_local() if hasattr(scorer, "row_local") else None
    if step is not None:
        return decode_rows(prompts, step, max_len, eos, key, ids)
    if hasattr(scorer, "walk"):
        return scorer.walk(prompts, max_len, eos, key, ids)
    return decode_loop(prompts, scorer, max_len, eos, key, ids, checkpoint_every)


def decode_rows(prompts: DataFrame, step: Callable, max_len: int, eos: int = EOS_ID,
                key: str = "seq_id", ids: str = "ids") -> DataFrame:
    """Decode each sequence to its end where it is, with a broadcast step function."""
    extra = [c for c in prompts.columns if c not in (key, ids)]
    rows = prompts.select(key, F.col(ids).cast("array<int>").alias(ids), *extra)
    schema = T.StructType([*rows.schema, T.StructField("steps", T.IntegerType())])
    reads = [rows.columns.index(c) for c in getattr(step, "columns", ())]

    # Spark broadcasts a function of this size with its model
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, added = [], []
            for start, *state in zip(batch.column(1).to_pylist(), *[batch.column(i).to_pylist() for i in reads], strict=True):
                got = list(start or ())
                while got and got[-1] != eos and len(got) < max_len:
                    follow = step(got, *state)
                    if follow is None:
                        break
                    got.append(follow)
                done.append(None if start is None else got)
                added.append(len(got) - len(start or ()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(done, pa.list_(pa.int32())), *batch.columns[2:], pa.array(added, pa.int32())],
                names=schema.names)

    return rows.mapInArrow(run, schema)


def decode_loop(prompts: DataFrame, scorer: Scorer, max_len: int, eos: int = EOS_ID,
                key: str = "seq_id", ids: str = "ids", checkpoint_every: int = 4) -> DataFrame:
    """The step loop: only unfinished sequences are scored. ``checkpoint_every``
    steps make one job; at its end the active rows and those that finished are
    written to the checkpoint folder, and only there is the end tested. No
    union grows across steps, so partition counts and plans stay bounded."""
    spark = prompts.sparkSession
    n_parts = work_partitions(spark)
    extra = [c for c in prompts.columns if c not in (key, ids)]
    state = pin(prompts.select(key, F.col(ids).alias("ids"), *extra, F.lit(0).alias("steps"),
                               (_finish_flags(F.col(ids), max_len, eos) | (F.size(ids) < 1)).alias("done"))
                .repartition(n_parts, key))
    pieces = [state.where(F.col("done"))]
    active = state.where(~F.col("done"))
    while not active.isEmpty():
        cached, finished = [], []
        for _ in range(checkpoint_every):
            frontier = active.select(key, F.col("ids").alias(ids) if ids != "ids" else F.col("ids"), *extra)
            best = scorer(frontier).groupBy(key).agg(
                F.max_by("next_id", F.struct("score", -F.col("next_id"))).alias("_next"))
            moved = active.join(best, key, "left")
            new_ids = F.when(F.col("_next").isNull(), F.col("ids")).otherwise(
                F.concat(F.col("ids"), F.array(F.col("_next").cast("int"))))
            moved = moved.select(
                key, new_ids.alias("ids"), *extra,
                (F.col("steps") + F.col("_next").isNotNull().cast("int")).alias("steps"),
                (F.col("_next").isNull() | _finish_flags(new_ids, max_len, eos)).alias("done")).persist()
            cached.append(moved)
            finished.append(moved.where(F.col("done")))
            active = moved.where(~F.col("done"))
        both = pin(reduce(DataFrame.unionByName, [active, *finished]).coalesce(n_parts))
        for c in cached:
            c.unpersist()
        pieces.append(both.where(F.col("done")))
        active = both.where(~F.col("done"))
    out = reduce(DataFrame.unionByName, pieces)
    return out.select(key, F.col("ids").alias(ids), *extra, "steps")


def source_prompts(encoded: DataFrame, seq_len: int, key: str, sos: int = SOS_ID) -> DataFrame:
    """``([SOS], encoder input, encoder mask)`` of every source that fits."""
    enc = A.encoder_input(F.col("src_ids"), seq_len)
    return encoded.where(F.size("src_ids") <= seq_len - 2).select(
        key, F.array(F.lit(sos)).alias("ids"), enc.alias("encoder_input"), A.encoder_mask(enc).alias("encoder_mask"))


def translate_batch(routed: DataFrame, vocab: DataFrame, scorer: Scorer, seq_len: int,
                    mode: str = "word", sos: int = SOS_ID,
                    eos: int = EOS_ID, vocab_stats: tuple[int, int] | None = None,
                    trg_vocab: DataFrame | None = None) -> DataFrame:
    """Translate routed inputs ``(key, source, expected, found, ...)``.

    Encode the source, apply the length check (too-long or unknown inputs get
    NULL ``predicted`` and a ``reason``), decode greedily from [SOS] given the
    padded encoder input and its mask, up to ``seq_len`` tokens, and turn ids
    back into text with ``trg_vocab`` (``vocab`` if not given): ``predicted`` is
    the whole sequence (special tokens kept, as the reference returns it),
    ``generated`` the tokens after the prompt (what the reference prints).
    """
    from parallex.operators.encode import decode, encode
    from parallex.operators.vocab import vocab_stats as measure

    if vocab_stats is None:
        vocab_stats = measure(vocab)
    # inputs are named by a generated id: theirs may be NULL or repeated
    given, key = routed, "_row"
    routed = pin(routed.withColumn(key, F.monotonically_increasing_id()))
    ok = routed.where(F.col("found"))
    # written once: the prompts and the reasons both read it
    enc = pin(encode(ok.select(key, "source"), {"src_ids": "source"}, vocab, mode, vocab_stats=vocab_stats).drop("source"))
    enc = enc.withColumn("reason", F.when(F.size("src_ids") > seq_len - 2, F.lit("src_too_long")))
    out = greedy_decode(source_prompts(enc, seq_len, key, sos), scorer, seq_len, eos, key=key)
    out = out.select(key, "ids", F.slice("ids", 2, F.greatest(F.size("ids") - 1, F.lit(0))).alias("gen_ids"))
    text = decode(out, {"predicted": "ids", "generated": "gen_ids"}, trg_vocab if trg_vocab is not None else vocab, mode,
                  vocab_stats=None if trg_vocab is not None else vocab_stats)
    # every decoded row has an encoded row: attach the texts to the reasons,
    # then join the inputs once
    results = enc.select(key, "reason").join(text, key, "left")
    return (routed.join(results, key, "left")
            .withColumn("reason", F.when(~F.col("found"), F.lit("unknown_id")).otherwise(F.col("reason")))
            .select(*given.columns, *[c for c in results.columns if c != key]))
