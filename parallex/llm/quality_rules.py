"""Quality rules as a short-circuit cascade.

A document is kept when no rule rejects it. A rule reads measures of the text
(word count, symbol count, ...), each computed once per document and only when
the first rule that needs it is reached. The rules' cost (seconds) and
selectivity (share rejected) are estimated on a sample, and the rules are run in
the order of rejections per second, so most rejected documents pay for one or
two cheap measures only. The order never changes the verdict: the rules are
joined by "and". An estimate is therefore free to be noisy.

NULL and empty texts have no words and are rejected by the word-count rule.
Texts of any length are measured whole. Repeated rows get the same verdict.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.llm.common import add_columns, at, documents, named, numbered

SYMBOLS = b"#*$%&|<>"
WINDOW = 8          # words in a window of the repetition measure
MIN_WORDS = 20
MAX_REPEATED = 30   # percent of the words
SAMPLE_ROWS = 2000  # documents on which costs and selectivities are estimated
_MUL = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, WINDOW + 1)], np.uint64)


class Measures:
    """Measures of one text, computed on first use."""

    def __init__(self, text: bytes | None):
        self.text = text or b""
        self._done: dict[str, int] = {}

    def __getitem__(self, name: str) -> int:
        if name not in self._done:
            self._done[name] = getattr(self, name)()
        return self._done[name]

    def words(self) -> list[bytes]:
        return self.text.split()

    def n_words(self) -> int:
        return len(self["words"])

    def word_chars(self) -> int:
        """Code points in words: every byte that starts one."""
        inside = b"".join(self["words"])
        return len(inside.decode("utf-8", "replace"))

    def n_symbols(self) -> int:
        return sum(map(self.text.count, (bytes([c]) for c in SYMBOLS)))

    def lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x.strip()]

    def n_lines(self) -> int:
        return len(self["lines"])

    def n_dup_lines(self) -> int:
        return len(self["lines"]) - len(set(self["lines"]))

    def n_repeat_words(self) -> int:
        """Words inside 8-word windows that occur twice or more in the text."""
        words = self["words"]
        n = len(words) - WINDOW + 1
        if n < 2:
            return 0
        seen: dict[bytes, int] = {}
        ids = np.array([seen.setdefault(w, len(seen) + 1) for w in words], np.uint64)
        ids ^= ids << np.uint64(29)
        ids *= np.uint64(0xBF58476D1CE4E5B9)
        ids ^= ids >> np.uint64(32)
        windows = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            windows += ids[k:k + n] * _MUL[k]
        order = np.sort(windows)
        twice = order[1:][order[1:] == order[:-1]]
        if not len(twice):
            return 0
        # the hash only proposes; equal words decide
        maybe = np.flatnonzero(np.isin(windows, twice)).tolist()
        grams = Counter(tuple(words[i:i + WINDOW]) for i in maybe)
        edge = np.zeros(len(words) + 1, np.int64)
        for i in maybe:
            if grams[tuple(words[i:i + WINDOW])] > 1:
                edge[i] += 1
                edge[i + WINDOW] -= 1
        return int((np.cumsum(edge[:-1]) > 0).sum())

    def n_stutter(self) -> int:
        """Words equal to the word before."""
        return sum(map(eq, self["words"], self["words"][1:]))

    def n_wordy(self) -> int:
        """Words with at least one letter."""
        texts = [w.decode("utf-8", "replace") for w in self["words"]]
        return sum(1 for w in texts if w.isalpha() or any(map(str.isalpha, w)))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


#: The two base rules, then the rest of the cascade.
BASE = (
    Rule("too_short", lambda m: m["n_words"] < MIN_WORDS),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > MAX_REPEATED * m["n_words"]),
)
RULES = (
    *BASE,
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule("stutter", lambda m: 10 * m["n_stutter"] > 3 * m["n_words"]),
    Rule("word_length", lambda m: not 2 * m["n_words"] <= m["word_chars"] <= 12 * m["n_words"]),
    Rule("letters", lambda m: 10 * m["n_wordy"] < 7 * m["n_words"]),
)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Seconds per document and share rejected of each rule, alone, on a sample of
    about ``sample_rows`` rows (a hash of the text decides; only sums return)."""
    n = docs.count()
    if not n:
        return {r.name: (0.0, 0.0) for r in rules}
    part = F.pmod(F.xxhash64(text, F.lit(4)), F.lit(1 << 20)) < int(min(1.0, sample_rows / n) * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for value in batch.column(0).to_pylist():
                for r in rules:
                    m = Measures(value)
                    began = time.perf_counter()
                    hit = r.rejects(m)
                    rows.append((r.name, time.perf_counter() - began, float(hit)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64()))],
            names=["rule", "cost", "rejected"])

    got = (docs.where(part).select(F.encode(F.col(text), "utf-8").alias("t"))
           .mapInArrow(run, "rule string, cost double, rejected double")
           .groupBy("rule").agg(F.avg("cost").alias("c"), F.avg("rejected").alias("r")).collect())
    found = {x["rule"]: (x["c"], x["r"]) for x in got}
    return {r.name: found.get(r.name, (0.0, 0.0)) for r in rules}


def order_rules(rules: Sequence[Rule], estimates: dict[str, tuple[float, float]]) -> list[Rule]:
    """Rules by rejections per second, highest first (given order on ties)."""
    return sorted(rules, key=lambda r: -estimates[r.name][1] / max(estimates[r.name][0], 1e-9))


def verdict(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` plus ``kept`` and ``failed_rule`` (the first rule of the run order
    that rejected, NULL if kept). A column of ``docs`` with one of these names is
    replaced. Empty input gives empty output."""
    ordered = order_rules(rules, estimate(docs, rules, text, sample_rows))

    def run(texts: list) -> list[list]:
        failed = []
        for t in texts:
            m = Measures(t)
            failed.append(next((r.name for r in ordered if r.rejects(m)), None))
        return [[f is None for f in failed], failed]

    return add_columns(docs, text, run, "kept boolean, failed_rule string")


def measured(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The base measures of every document, ``base_failed`` and the cascade's
    ``kept``, without the text. The cascade is entered only by documents that
    pass the base rules, and reuses the measures already made."""
    rest = [r for r in order_rules(rules, estimate(docs, rules, text, sample_rows)) if r not in BASE]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(texts: list) -> list[list]:
        rows = []
        for t in texts:
            m = Measures(t)
            base = [m[x] for x in names]
            failed = any(r.rejects(m) for r in BASE)
            rows.append((*base, failed, not failed and not any(r.rejects(m) for r in rest)))
        return [list(x) for x in zip(*rows, strict=True)] if rows else [[]] * 7

    return add_columns(docs, text, run, ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean",
                       drop=[text])


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(documents(spark, sf_dir).select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that no rule rejects."""
    return named(verdict(numbered(docs), text=at(docs, "text")).where("kept"), docs)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 9),
k AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS gram FROM g),
c AS (SELECT r, i FROM k QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
p AS (SELECT r, count(DISTINCT i + j) AS n FROM c, range(0, 8) AS x(j) GROUP BY r),
m AS (SELECT w.r, doc_id, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
             coalesce(p.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) AS n_wordy,
             len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutter
      FROM w LEFT JOIN p USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 10 * n_wordy < 7 * n_words
            OR 10 * n_stutter > 3 * n_words) AS kept
FROM b
"""
