"""Command line: ``prepare`` a corpus for training, ``translate`` inputs.

    python -m parallex.cli prepare --corpus PATH --format json --out DIR [--split test]
    python -m parallex.cli translate --prepared DIR [--corpus PATH ...] "sentence or row id" ...

``translate`` decodes greedily with a bigram scorer learned from the prepared
training split (the network itself is not part of this toolkit; pass a
``pandas_scorer`` from Python to use a model).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from parallex.config import Options
from parallex.jobs import prepare, read_prepared
from parallex.operators.decoding import BigramScorer, bigram_scores, translate_batch
from parallex.session import get_spark
from parallex.sources.corpus import read_pairs, route_inputs
from parallex.sources.runlog import translation_report

# Fixed value: the default sentence translated when no input is given.
DEFAULT_SENTENCE = "I am not a very good a student."


def main(argv: list[str] | None = None) -> int:
    opts = Options()
    ap = argparse.ArgumentParser(prog="parallex")
    sub = ap.add_subparsers(dest="cmd", required=True)
    pp = sub.add_parser("prepare")
    pp.add_argument("--corpus", required=True)
    pp.add_argument("--format", default="parquet")
    pp.add_argument("--out", required=True)
    pp.add_argument("--split", default="all")
    pp.add_argument("--src", default=opts.src_lang)
    pp.add_argument("--trg", default=opts.trg_lang)
    pp.add_argument("--seq-len", type=int, default=opts.seq_len)
    pp.add_argument("--min-count", type=int, default=1)
    tp = sub.add_parser("translate")
    tp.add_argument("--prepared", required=True)
    tp.add_argument("--seq-len", type=int, default=opts.seq_len)
    tp.add_argument("inputs", nargs="*", default=[DEFAULT_SENTENCE])
    for p in (pp, tp):
        p.add_argument("--master", default="local[*]")
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    if a.cmd == "prepare":
        pairs = read_pairs(spark, a.corpus, a.src, a.trg, a.split, fmt=a.format)
        o = Options(seq_len=a.seq_len)
        for r in prepare(spark, pairs, a.out, o, min_count=a.min_count).orderBy("split").collect():
            print(f"{r['split']}: {r['pairs']} pairs, max source {r['max_src']}, max target {r['max_trg']}")
        return 0
    enc = read_prepared(spark, a.prepared)
    vocab = spark.read.parquet(f"{a.prepared}/vocab")
    scorer = BigramScorer(bigram_scores(enc.where(F.col("split") == "train")))
    inputs = spark.createDataFrame([(i, t) for i, t in enumerate(a.inputs)], "input_id long, input string")
    routed = route_inputs(inputs, enc.select("pair_id", "src_text", "trg_text"))
    out = translate_batch(routed, vocab, scorer, a.seq_len)
    for r in translation_report(out).orderBy("input_id", "line_no").collect():
        print(r["line"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
