"""Streaming example builder.

Encoding regroups tokens per pair, which a streaming aggregation could only do
with a watermark. Each micro-batch is finite, so the batch plan runs unchanged
on it inside ``foreachBatch``. Output goes to ``<out>/batch=<id>`` with
overwrite, so a micro-batch replayed after a failure replaces its own files
instead of duplicating rows (exactly-once together with the checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from parallex.operators.encode import encode
from parallex.operators.examples import build_examples
from parallex.operators.lengths import check_lengths
from parallex.operators.vocab import vocab_stats


def examples_stream(stream: DataFrame, vocab: DataFrame, seq_len: int, out_path: str,
                    checkpoint_path: str, rejected_path: str | None = None, mode: str = "word",
                    available_now: bool = True) -> StreamingQuery:
    """Build examples from a stream of ``(pair_id, src_text, trg_text)``."""
    stats = vocab_stats(vocab)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        enc = encode(batch, {"src_ids": "src_text", "trg_ids": "trg_text"}, vocab, mode,
                     vocab_stats=stats)
        kept, rejected = check_lengths(enc, seq_len, "quarantine")
        build_examples(kept, seq_len).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        if rejected_path:
            rejected.select("pair_id", "reason").write.mode("overwrite").parquet(
                f"{rejected_path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_examples(spark, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path).drop("batch")


__all__ = ["examples_stream", "read_examples"]
