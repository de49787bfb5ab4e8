"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Arrays are rendered as comma-separated text and derived floats rounded to 6
places so results compare across engines; the library functions themselves
return real arrays and full-precision doubles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.config import SOS_ID, Options
from parallex.functions import scores as S
from parallex.functions.arrays import render, render_rows
from parallex.functions import arrays as A
from parallex.jobs import log_losses, prepare, read_prepared, training_batches, validate
from parallex.operators import curves, examples, lengths, metrics, sampling, scoring, subword, translation
from parallex.operators.decoding import (BigramScorer, NgramScorer, bigram_scores, decode_loop, greedy_decode, ngram_scores, source_class,
                                         source_prompts, translate_batch)
from parallex.operators.encode import decode, encode, encode_sides, encode_with
from parallex.operators.examples import build_examples
from parallex.operators.vocab import build_vocab, vocab_size, vocab_stats
from parallex.plans import standins as T
from parallex.session import ensure_checkpoint_dir, pin
from parallex.sources import clustered, corpus, runlog
from parallex.sources.vocab_store import get_or_build_vocab
from parallex.streaming.metrics import last_values_stream, read_last_values

OPTS = Options()
SEED = OPTS.seed
CHECK_SEQ_LEN = 128  # a second length-check setting that rejects pairs in the stand-in corpus
MASK_SEQ_LEN = 64    # a setting at which whole decoder masks are compared
LOOP_LEN = 8         # tokens decoded by the general step loop
PREVIEW_ROWS = 5
EVENTS_PER_STEP = 50  # events that share a step, so that steps are logged more than once
NGRAM_ORDER = 4
PROMPT_WORDS = 2     # of a target, from which its continuation is decoded
SUBWORD_MERGES = 256
LONG_CHUNK = 24      # scores a task holds together, so that the 64 of a position come in three parts
SIDES = {"src_ids": "src_text", "trg_ids": "trg_text"}


def _r(c, places: int = 6):
    return F.round(c, places)


def _folder(spark, name: str) -> str:
    """A new folder for a table that a query writes and reads again."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- shared plans -------------------------------------------------------------

def src_vocab(spark, d):
    return build_vocab(T.pairs(spark, d), "src_text", "word")


def shared_vocab(spark, d):
    p = T.pairs(spark, d)
    texts = p.select(F.col("src_text").alias("text")).unionByName(p.select(F.col("trg_text").alias("text")))
    return build_vocab(texts, "text", "word")


def encoded_shared(spark, d, vocab=None):
    v = vocab if vocab is not None else shared_vocab(spark, d)
    return encode(T.pairs(spark, d), SIDES, v, "word")


def examples_df(spark, d):
    return build_examples(encoded_shared(spark, d), OPTS.seq_len, "annotate")


def split_df(spark, d):
    return sampling.split_exact(T.pairs(spark, d).select("pair_id"), ["pair_id"], OPTS.train_fraction, SEED)


def train_ranked(spark, d):
    train = split_df(spark, d).where(F.col("split") == "train").select("pair_id")
    return sampling.shuffle_rank(train, ["pair_id"], SEED, OPTS.num_epochs)


# ---- A, B: sources, lookups, predicates ---------------------------------------

def _stored_corpus(spark, d):
    """The corpus as a parallel corpus is stored: a translation record per pair,
    laid out by split."""
    path = _folder(spark, "corpus")
    (T.pairs(spark, d).select("pair_id", F.struct(F.col("src_text").alias("en"), F.col("trg_text").alias("ja")).alias("translation"),
                              F.when(F.col("pair_id") % 10 == 0, "test").otherwise("train").alias("split"))
     .write.partitionBy("split").parquet(path))
    return path


def q_pairs_load(spark, d):
    return corpus.read_pairs(spark, _stored_corpus(spark, d), "en", "ja", "all")


def q_pairs_load_split(spark, d):
    return corpus.read_pairs(spark, _stored_corpus(spark, d), "en", "ja", "test")


def q_pairs_count(spark, d):
    return corpus.pair_count(T.pairs(spark, d))


def q_pair_preview(spark, d):
    return corpus.preview(T.pairs(spark, d), PREVIEW_ROWS)


def q_pair_lookup(spark, d):
    got = corpus.pairs_by_ids(T.pairs(spark, d), T.lookup_ids(spark, d))
    return got.select("pair_id", "src_text", "trg_text", F.col("src_text").isNotNull().alias("found"))


def _clustered(spark, d) -> str:
    path = _folder(spark, "clustered")
    clustered.write_clustered(T.pairs(spark, d), path)
    return path


def q_pair_positions(spark, d):
    """Every pair of the corpus stored in id order, with its position."""
    return clustered.with_positions(spark, _clustered(spark, d)).select("position", "pair_id", "src_text", "trg_text")


def q_input_routing(spark, d):
    return corpus.route_inputs(T.routing_inputs(spark, d), T.pairs(spark, d))


def q_sentences_lang(spark, d):
    return corpus.sentences(T.table(spark, d, "documents"), OPTS.src_lang)


# ---- C: vocabulary, encode, decode ----------------------------------------------

def q_vocab_build(spark, d):
    return src_vocab(spark, d)


def q_vocab_by_lang(spark, d):
    docs = T.table(spark, d, "documents")
    return build_vocab(docs, "text", "word", by=["lang"])


def q_special_ids(spark, d):
    v = build_vocab(T.table(spark, d, "documents"), "text", "word", by=["lang"])
    return v.where("is_special").select("lang", "token", "id")


def q_vocab_store(spark, d):
    """Stored by the first call; the second finds it and does not look at its texts."""
    p, path = T.pairs(spark, d), _folder(spark, "vocab")
    get_or_build_vocab(spark, path, p, "trg_text")
    return get_or_build_vocab(spark, path, p.where(F.lit(False)), "src_text")


def q_vocab_size(spark, d):
    return vocab_size(src_vocab(spark, d))


def q_encode_word(spark, d):
    e = encoded_shared(spark, d)
    return e.select("pair_id", render(F.col("src_ids")).alias("src_ids"),
                    render(F.col("trg_ids")).alias("trg_ids"))


def q_encode_two_vocabs(spark, d):
    p = T.pairs(spark, d)
    e = encode_sides(p, SIDES, {"src_ids": build_vocab(p, "src_text"), "trg_ids": build_vocab(p, "trg_text")})
    return e.select("pair_id", render(F.col("src_ids")).alias("src_ids"),
                    render(F.col("trg_ids")).alias("trg_ids"))


def q_encode_by_lang(spark, d):
    """Documents encoded with the vocabulary of their language."""
    docs = T.table(spark, d, "documents").select("doc_id", "lang", "text")
    v = build_vocab(docs, "text", "word", by=["lang"])
    return encode(docs, {"ids": "text"}, v, by=["lang"]).select("doc_id", render(F.col("ids")).alias("ids"))


def q_encode_char(spark, d):
    p = T.pairs(spark, d)
    texts = p.select(F.col("src_text").alias("text")).unionByName(p.select(F.col("trg_text").alias("text")))
    e = encode(p, SIDES, build_vocab(texts, "text", "char"), "char")
    return e.select("pair_id", render(F.col("src_ids")).alias("src_ids"),
                    render(F.col("trg_ids")).alias("trg_ids"))


def q_decode_roundtrip(spark, d):
    v = shared_vocab(spark, d)
    e = encoded_shared(spark, d, v)
    return decode(e.select("pair_id", "src_ids", "trg_ids"), {"src_back": "src_ids", "trg_back": "trg_ids"}, v, "word").select(
        "pair_id", "src_back", "trg_back")


def _subword_texts(spark, d):
    p = T.pairs(spark, d)
    return p.select(F.col("src_text").alias("text")).unionByName(p.select(F.col("trg_text").alias("text")))


def q_subword_merges(spark, d):
    """Merges learned on both sides of the corpus, in their order."""
    merges, _ = subword.train(_subword_texts(spark, d), SUBWORD_MERGES)
    return subword.merges_frame(spark, merges)


def q_subword_encode(spark, d):
    """Both sides by the shared subword vocabulary."""
    v = pin(subword.subword_vocab(_subword_texts(spark, d), SUBWORD_MERGES))
    e = encode_with(T.pairs(spark, d), SIDES, subword.subword_tokenizer(v))
    return e.select("pair_id", render(F.col("src_ids")).alias("src_ids"), render(F.col("trg_ids")).alias("trg_ids"))


def q_subword_roundtrip(spark, d):
    """Every document cut by a vocabulary learned on all of them, and decoded."""
    docs = T.table(spark, d, "documents").select("doc_id", "text")
    v = pin(subword.subword_vocab(docs, SUBWORD_MERGES // 4))
    e = encode_with(docs, {"ids": "text"}, subword.subword_tokenizer(v))
    return decode(e, {"back": "ids"}, v, "subword").select("doc_id", "back")


# ---- D: lengths -------------------------------------------------------------------

def q_token_lengths(spark, d):
    return lengths.token_lengths(encoded_shared(spark, d))


def q_max_lengths(spark, d):
    return lengths.max_lengths(encoded_shared(spark, d))


def _quarantine(spark, d, seq_len):
    a = lengths.check_lengths(encoded_shared(spark, d), seq_len, "annotate")
    return a.select("pair_id", F.size("src_ids").cast("long").alias("n_src"),
                    F.size("trg_ids").cast("long").alias("n_trg"), "reason")


def q_length_quarantine(spark, d):
    return _quarantine(spark, d, OPTS.seq_len)


def q_length_quarantine_128(spark, d):
    return _quarantine(spark, d, CHECK_SEQ_LEN)


# ---- E: examples ------------------------------------------------------------------

def q_examples(spark, d):
    ex = examples_df(spark, d)
    return ex.select("pair_id", *[render(F.col(c)).alias(c) for c in
                                  ("encoder_input", "decoder_input", "label", "encoder_mask", "dec_valid")],
                     "src_text", "trg_text", "reason")


def q_examples_128(spark, d):
    """At a length that rejects pairs: they stay, without arrays."""
    ex = build_examples(encoded_shared(spark, d), CHECK_SEQ_LEN, "annotate")
    return ex.select("pair_id", render(F.col("encoder_input")).alias("encoder_input"),
                     render(F.col("label")).alias("label"), "reason")


def _one_column(name):
    def q(spark, d):
        return examples_df(spark, d).select("pair_id", render(F.col(name)).alias(name))
    return q


def q_decoder_mask(spark, d):
    """Set cells at the full length, from the compact form."""
    return examples_df(spark, d).select("pair_id", A.decoder_mask_cells(F.col("dec_valid")).alias("cells_set"))


def q_decoder_mask_cells(spark, d):
    """Every cell, at a length where a mask is small: rows of 0 and 1."""
    m = examples.decoder_mask(build_examples(encoded_shared(spark, d), MASK_SEQ_LEN, "annotate"))
    return m.select("pair_id", F.array_join(F.transform("decoder_mask", lambda r: F.array_join(r, "")), ";").alias("cells"))


def q_causal_mask(spark, d):
    """The mask that the longest target of the corpus needs, row by row."""
    n = lengths.max_lengths(encoded_shared(spark, d)).first()["max_trg"]
    cells = examples.causal_mask(spark, n + 1)
    return cells.groupBy("i").agg(F.sum(F.col("allowed").cast("long")).alias("allowed"), F.max(F.when(F.col("allowed"), F.col("j"))).alias("last"),
                                  F.count(F.lit(1)).alias("cells"))


def q_example_sizes(spark, d):
    return examples.assert_example_sizes(examples_df(spark, d), OPTS.seq_len)


# ---- F: split, shuffle, batches ---------------------------------------------------

def q_split_exact(spark, d):
    return split_df(spark, d).select("pair_id", "split_rank", "split")


def q_shuffle_rank(spark, d):
    return train_ranked(spark, d).select("pair_id", "epoch", "rank")


def q_batch_assign(spark, d):
    return sampling.assign_batches(train_ranked(spark, d), OPTS.batch_size).select(
        "pair_id", "epoch", "rank", "batch_id")


def q_batch_collate(spark, d):
    b = sampling.assign_batches(train_ranked(spark, d), OPTS.batch_size)
    c = sampling.collate(b, ["pair_id"])
    return c.select("epoch", "batch_id", render(F.col("pair_id")).alias("pair_ids"))


def q_epoch_schedule(spark, d):
    train = split_df(spark, d).where(F.col("split") == "train").select("pair_id")
    s = sampling.epoch_schedule(train, ["pair_id"], SEED, OPTS.batch_size, 0, OPTS.num_epochs, 0)
    return s.select("pair_id", "epoch", "rank", "batch_id", "global_step")


def q_val_sample(spark, d):
    val = split_df(spark, d).where(F.col("split") == "val").select("pair_id")
    return sampling.first_shuffled(val, ["pair_id"], SEED, 0, OPTS.val_examples).select("pair_id", "rank")


def q_train_batches(spark, d):
    """The stacked batches of all epochs, at the production length, over the
    training pairs that fit; rows are named by their rank in the split."""
    split = split_df(spark, d).select("pair_id", "split", F.col("split_rank").alias("row_id"))
    enc = pin(encoded_shared(spark, d).join(split, "pair_id")
              .where((F.col("split") == "train") & lengths.length_reason(OPTS.seq_len).isNull()))
    schedule = sampling.epoch_schedule(enc.select("row_id", "pair_id"), ["pair_id"], SEED, OPTS.batch_size, 0, OPTS.num_epochs)
    b = training_batches(enc, schedule, OPTS.seq_len)
    fields = ("encoder_input", "decoder_input", "label", "encoder_mask", "dec_valid")
    return b.select("epoch", "batch_id", "global_step", render(F.col("pair_id")).alias("pair_ids"),
                    *[F.md5(render_rows(F.col(f))).alias(f) for f in fields])


def q_train_batches_prepared(spark, d):
    """The same batches from the tables that the preparation job writes: its row
    ids, its split, its length check and its schedule."""
    folder = _folder(spark, "prepared")
    prepare(spark, T.pairs(spark, d), folder, OPTS)
    b = training_batches(read_prepared(spark, folder, "train"), spark.read.parquet(f"{folder}/schedule"), OPTS.seq_len)
    return b.select("epoch", "batch_id", "global_step", render(F.col("pair_id")).alias("pair_ids"),
                    *[F.md5(render_rows(F.col(f))).alias(f) for f in ("encoder_input", "label")])


# ---- G: scores --------------------------------------------------------------------

def q_log_softmax(spark, d):
    s = T.scores(spark, d)
    return s.select("vec_id", F.posexplode(S.log_softmax(F.col("logits"))).alias("k", "log_prob")).select(
        "vec_id", F.col("k").cast("int").alias("k"), _r(F.col("log_prob")).alias("log_prob"))


def q_top1_token(spark, d):
    return T.scores(spark, d).select("vec_id", S.top1(F.col("logits")).alias("top1"))


def q_top1_long(spark, d):
    long = scoring.to_long(T.scores(spark, d), ["vec_id"])
    return scoring.top1_long(long, ["vec_id"])


def q_flatten_scores(spark, d):
    s = T.scores(spark, d)
    nested = s.groupBy("example_id").agg(F.array_sort(F.collect_list(F.struct("pos", "logits", "label"))).alias("r"))
    nested = nested.select("example_id", F.transform("r", lambda x: x["logits"]).alias("logits"),
                           F.transform("r", lambda x: x["label"]).alias("labels"))
    flat = scoring.flatten_scores(nested, "example_id")
    return flat.select("example_id", F.col("pos").cast("int").alias("pos"), "label",
                       S.top1(F.col("logits")).alias("top1"), F.size("logits").alias("n_classes"))


def q_masked_ce(spark, d):
    r = scoring.masked_ce(T.scores(spark, d), T.SCORE_PAD, 0.0)
    return r.select(_r(F.col("loss")).alias("loss"), "n_positions")


def q_smoothed_ce(spark, d):
    r = scoring.masked_ce(T.scores(spark, d), T.SCORE_PAD, OPTS.label_smoothing)
    return r.select(_r(F.col("loss")).alias("loss"), "n_positions")


def q_mean_val_loss(spark, d):
    per_batch = scoring.masked_ce(T.scores(spark, d), T.SCORE_PAD, 0.0, by=["example_id"])
    r = scoring.mean_val_loss(per_batch)
    return r.select(_r(F.col("mean_loss")).alias("mean_loss"), "n_batches")


def _long(spark, d):
    s = T.scores(spark, d)
    return scoring.to_long(s, ["vec_id"]), s.select("vec_id", "label")


def q_log_softmax_long(spark, d):
    r = scoring.log_softmax_long(_long(spark, d)[0], ["vec_id"], chunk=LONG_CHUNK)
    return r.select("vec_id", F.col("token_id").alias("k"), _r(F.col("log_prob")).alias("log_prob"))


def _ce_long(smoothing):
    def q(spark, d):
        long, labels = _long(spark, d)
        r = scoring.masked_ce_long(long, labels, ["vec_id"], T.SCORE_PAD, smoothing, chunk=LONG_CHUNK)
        return r.select(_r(F.col("loss")).alias("loss"), "n_positions")
    return q


# ---- H: text metrics ---------------------------------------------------------------

def q_cer(spark, d):
    r = metrics.char_error_rate(T.eval_set(spark, d))
    return r.select("edits", "total", _r(F.col("cer")).alias("cer"))


def q_wer(spark, d):
    r = metrics.word_error_rate(T.eval_set(spark, d))
    return r.select("edits", "total", _r(F.col("wer")).alias("wer"))


def q_document_edits(spark, d):
    """Word edits from every document to the one with the next id, whatever their lengths."""
    docs = T.table(spark, d, "documents").select("doc_id", "text")
    after = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("next"))
    r = metrics.with_word_edits(docs.join(after, "doc_id"), "next", "text", "word_edits", "n_words")
    return r.select("doc_id", "word_edits", "n_words")


def q_bleu_ngrams(spark, d):
    return metrics.bleu_ngrams(T.eval_set(spark, d)).select(F.col("n").cast("int").alias("n"),
                                                             "matches", "candidates")


def q_bleu(spark, d):
    r = metrics.bleu(T.eval_set(spark, d))
    return r.select(_r(F.col("bleu")).alias("bleu"), "hyp_len", "ref_len")


def q_metrics_by_turn(spark, d):
    """CER, WER and BLEU per user-turn position (the ``by`` form of H1-H3)."""
    ev = T.eval_by_turn(spark, d)
    c = metrics.char_error_rate(ev, by=["turn"]).select("turn", _r(F.col("cer")).alias("cer"))
    w = metrics.word_error_rate(ev, by=["turn"]).select("turn", _r(F.col("wer")).alias("wer"))
    b = metrics.bleu(ev, by=["turn"]).select("turn", _r(F.col("bleu")).alias("bleu"))
    return c.join(w, "turn").join(b, "turn")


def q_comparison_report(spark, d):
    return runlog.comparison_report(T.eval_set(spark, d)).select(
        "pair_id", F.col("line_no").cast("int").alias("line_no"), "line")


# ---- I: decoding ---------------------------------------------------------------------

def _bigram(enc):
    """Stand-in model: greedy next-token choice learned from target-side bigrams
    by source class, with back-off to all sources."""
    enc_in = A.encoder_input(F.col("src_ids"), OPTS.seq_len)
    classed = enc.withColumn("src_class", source_class(enc_in, A.encoder_mask(enc_in)))
    return BigramScorer(bigram_scores(classed, "trg_ids", by=["src_class"]))


def _decoded(spark, d, decode_with, max_len):
    """Every pair with its decoded ids, or none and the reason."""
    enc = pin(encoded_shared(spark, d).select("pair_id", "src_ids", "trg_ids").withColumn("_row", F.monotonically_increasing_id()))
    scorer = _bigram(enc)
    out = decode_with(source_prompts(enc, OPTS.seq_len, "_row"), scorer, max_len)
    reason = lengths.length_reason(OPTS.seq_len, texts=())
    return enc.select("_row", "pair_id", reason.alias("reason")).join(out, "_row", "left").select(
        "pair_id", render(F.when(F.col("reason").isNull(), F.col("ids"))).alias("ids"),
        F.when(F.col("reason").isNull(), F.col("steps")).cast("int").alias("steps"), "reason")


def q_greedy_decode(spark, d):
    return _decoded(spark, d, lambda p, s, n: greedy_decode(p, s, n, key="_row"), OPTS.seq_len)


def q_decode_loop(spark, d):
    """The general step loop, over the same scorer used as joins."""
    return _decoded(spark, d, lambda p, s, n: decode_loop(s.prepare(p), s, n, key="_row"), LOOP_LEN)


def q_decode_paths(spark, d):
    """The same sequences by path doubling, as above the broadcast bound."""
    return _decoded(spark, d, lambda p, s, n: s.walk(s.prepare(p), n, key="_row"), OPTS.seq_len)


def q_decode_ngrams(spark, d):
    """Every target continued from its first words by n-grams with back-off."""
    enc = pin(encoded_shared(spark, d).select("pair_id", "trg_ids").withColumn("_row", F.monotonically_increasing_id()))
    scorer = NgramScorer(ngram_scores(enc, order=NGRAM_ORDER), NGRAM_ORDER)
    prompts = enc.select("_row", F.concat(F.array(F.lit(SOS_ID)), F.slice("trg_ids", 1, PROMPT_WORDS)).alias("ids"), "pair_id")
    out = greedy_decode(prompts, scorer, OPTS.seq_len, key="_row")
    return out.select("pair_id", render(F.col("ids")).alias("ids"), "steps")


def q_translation_table(spark, d):
    """The best translation of every source token, and its probability."""
    enc = encoded_shared(spark, d).select("src_ids", "trg_ids")
    table = translation.translation_table(translation.links(enc))
    # the probability comes with the best translation: the table is read once and not kept
    return translation.best_translations(table, with_p=True).select("s", "t", _r(F.col("p")).alias("p"))


def _translated(spark, d):
    v = pin(shared_vocab(spark, d))
    stats = vocab_stats(v)  # measured once, reused by every lookup below
    pairs = pin(T.pairs(spark, d))
    enc = encode(pairs, SIDES, v, "word", vocab_stats=stats).select("src_ids", "trg_ids")
    scorer = translation.TranslationScorer(translation.translation_table(translation.links(enc)))
    routed = pin(corpus.route_inputs(T.routing_inputs(spark, d), pairs))
    return translate_batch(routed, v, scorer, OPTS.seq_len, vocab_stats=stats)


def q_translate_batch(spark, d):
    return _translated(spark, d).select("input_id", "is_row_id", "found", "predicted", "reason")


def q_validation_metrics(spark, d):
    """Validation entry end to end: a bigram scorer learned from the training
    split decodes every validation pair from [SOS]; CER, WER and BLEU of the
    decoded text against the targets."""
    v = pin(shared_vocab(spark, d))
    split = split_df(spark, d).select("pair_id", "split")
    # the prepared table: written once to the checkpoint folder, then read by
    # the scorer (training rows) and the decoder (validation rows)
    enc = pin(encode(T.pairs(spark, d).join(split, "pair_id"), SIDES, v, "word", vocab_stats=vocab_stats(v)))
    scorer = _bigram(enc.where(F.col("split") == "train"))
    out = validate(enc.where(F.col("split") == "val"), v, scorer, OPTS)["metrics"]
    return out.select(*[_r(F.col(c)).alias(c) for c in ("cer", "wer", "bleu")])


# ---- A5-A7, J: run log and curves -----------------------------------------------------

def q_translation_report(spark, d):
    return runlog.translation_report(_translated(spark, d)).select(
        "input_id", F.col("line_no").cast("int").alias("line_no"), "line")


def q_artifact_latest(spark, d):
    recs = runlog.artifact_records(T.artifact_log(spark, d), OPTS)
    return runlog.latest_artifact(recs, "latest")


def q_resume_point(spark, d):
    recs = runlog.artifact_records(T.artifact_log(spark, d), OPTS)
    return runlog.resume_point(recs, runlog.latest_artifact(recs, "latest"))


def q_artifact_log(spark, d):
    """Records appended in two parts and read back."""
    path = _folder(spark, "artifacts")
    recs = runlog.artifact_records(T.artifact_log(spark, d), OPTS)
    for part in (F.col("global_step") % 2 == 0, F.col("global_step") % 2 == 1):
        runlog.append_artifacts(recs.where(part), path)
    return runlog.read_artifacts(spark, path)


def q_metric_log_by_tag(spark, d):
    """Written to the log, read back and summed up by run and tag."""
    path = _folder(spark, "metrics")
    runlog.append_metrics(T.metric_log(spark, d), path)
    r = runlog.metric_summary(runlog.read_metrics(spark, path))
    return r.select("run", "tag", "n", "last_step", "last_value")


def q_metric_stream(spark, d):
    """The log as a stream of files in which steps occur more than once: the last
    value of each, kept in state over several micro-batches."""
    folder = _folder(spark, "stream")
    log = T.metric_log(spark, d).withColumn("step", F.expr(f"step div {EVENTS_PER_STEP}"))
    log.repartition(4, "ts").write.parquet(f"{folder}/log")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/log")
    last_values_stream(stream, f"{folder}/out", f"{folder}/state").awaitTermination()
    return read_last_values(spark, f"{folder}/out").select("run", "tag", "step", "value")


def q_loss_log(spark, d):
    """Losses computed, logged under their fixed tags, read back as curves."""
    path = _folder(spark, "losses")
    log_losses(T.scores(spark, d), path, "run", T.BATCHES_PER_EPOCH, T.SCORE_PAD, OPTS.label_smoothing)
    r = curves.loss_curves(runlog.read_metrics(spark, path), T.BATCHES_PER_EPOCH)
    return r.select("run", "epoch", _r(F.col("train_loss")).alias("train_loss"), "train_steps", _r(F.col("val_loss")).alias("val_loss"))


def q_train_curve(spark, d):
    return curves.train_curve(T.metric_log(spark, d), T.TRAIN_TAG)


def q_val_curve(spark, d):
    return curves.val_curve(T.metric_log(spark, d), T.STEPS_PER_EPOCH, T.VAL_TAG)


def q_loss_curves(spark, d):
    r = curves.loss_curves(T.metric_log(spark, d), T.STEPS_PER_EPOCH, T.TRAIN_TAG, T.VAL_TAG)
    return r.select("run", "epoch", _r(F.col("train_loss"), 9).alias("train_loss"), "train_steps", "val_loss")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pairs_load": q_pairs_load,
    "pairs_load_split": q_pairs_load_split,
    "pairs_count": q_pairs_count,
    "pair_preview": q_pair_preview,
    "pair_lookup": q_pair_lookup,
    "pair_positions": q_pair_positions,
    "input_routing": q_input_routing,
    "sentences_lang": q_sentences_lang,
    "vocab_build": q_vocab_build,
    "vocab_by_lang": q_vocab_by_lang,
    "special_ids": q_special_ids,
    "vocab_store": q_vocab_store,
    "vocab_size": q_vocab_size,
    "encode_word": q_encode_word,
    "encode_two_vocabs": q_encode_two_vocabs,
    "encode_by_lang": q_encode_by_lang,
    "encode_char": q_encode_char,
    "decode_roundtrip": q_decode_roundtrip,
    "subword_merges": q_subword_merges,
    "subword_encode": q_subword_encode,
    "subword_roundtrip": q_subword_roundtrip,
    "token_lengths": q_token_lengths,
    "max_lengths": q_max_lengths,
    "length_quarantine": q_length_quarantine,
    "length_quarantine_128": q_length_quarantine_128,
    "examples": q_examples,
    "examples_128": q_examples_128,
    "encoder_input": _one_column("encoder_input"),
    "decoder_input": _one_column("decoder_input"),
    "label_ids": _one_column("label"),
    "encoder_mask": _one_column("encoder_mask"),
    "decoder_mask": q_decoder_mask,
    "decoder_mask_cells": q_decoder_mask_cells,
    "example_sizes": q_example_sizes,
    "causal_mask": q_causal_mask,
    "split_exact": q_split_exact,
    "shuffle_rank": q_shuffle_rank,
    "batch_assign": q_batch_assign,
    "batch_collate": q_batch_collate,
    "epoch_schedule": q_epoch_schedule,
    "train_batches": q_train_batches,
    "train_batches_480": q_train_batches,
    "train_batches_prepared": q_train_batches_prepared,
    "val_sample": q_val_sample,
    "log_softmax": q_log_softmax,
    "top1_token": q_top1_token,
    "top1_long": q_top1_long,
    "flatten_scores": q_flatten_scores,
    "masked_ce": q_masked_ce,
    "smoothed_ce": q_smoothed_ce,
    "mean_val_loss": q_mean_val_loss,
    "log_softmax_long": q_log_softmax_long,
    "masked_ce_long": _ce_long(0.0),
    "smoothed_ce_long": _ce_long(OPTS.label_smoothing),
    "cer": q_cer,
    "wer": q_wer,
    "document_edits": q_document_edits,
    "bleu_ngrams": q_bleu_ngrams,
    "bleu": q_bleu,
    "metrics_by_turn": q_metrics_by_turn,
    "comparison_report": q_comparison_report,
    "greedy_decode": q_greedy_decode,
    "decode_loop": q_decode_loop,
    "decode_paths": q_decode_paths,
    "decode_ngrams": q_decode_ngrams,
    "translation_table": q_translation_table,
    "translate_batch": q_translate_batch,
    "translation_report": q_translation_report,
    "validation_metrics": q_validation_metrics,
    "artifact_log": q_artifact_log,
    "artifact_latest": q_artifact_latest,
    "resume_point": q_resume_point,
    "metric_log_by_tag": q_metric_log_by_tag,
    "metric_stream": q_metric_stream,
    "loss_log": q_loss_log,
    "train_curve": q_train_curve,
    "val_curve": q_val_curve,
    "loss_curves": q_loss_curves,
}
