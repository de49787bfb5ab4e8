"""Subword vocabulary (C4) and segmentation of any text (C1).

**Training.** Merges are learned on the table of distinct words and their counts.
A round counts the pairs of neighbouring symbols by one aggregation and applies
several merges at once: the most frequent pairs, down to ``SHARE`` of the round's
best, of which no two have a symbol in common. Merges without a common symbol do
not change each other's counts, so a round gives what merging one pair at a time
gives but for the order in which merges enter. The driver sees at most
``CANDIDATES`` pairs a round. Between the rounds the words lie in blocks of some
ten thousand, their symbols as numbers one after another; a block is merged and
its pairs are counted by whole arrays.

A word begins with a space, its first symbol with the word's first character: a
space occurs in no word, so it marks the beginnings without clashing with any
text. Text without spaces (Japanese) is one long word and is learned all the same.

**Segmentation.** A text is cut by the best path over the lattice of vocabulary
entries that match it (by a trie): the path with the highest sum of log
probabilities, ties to the longer last token. A character that no entry covers is
[UNK]. Rows stay where they are: the vocabulary, of checked size, is broadcast and
each task cuts the distinct words of a stretch of texts side by side, one place
after another. Joining tokens gives the words of the text again, one space
between them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallex.config import SPECIAL_TOKENS, UNK_ID
from parallex.functions.text import arrow_words, chars, cuts, for_arrow, stretches
from parallex.operators.ranking import exact_rank
from parallex.operators.vocab import specials_frame, vocab_stats
from parallex.session import is_broadcastable, pin

SEP = "\x1f"  # between the symbols of a word; white space, so it is in no word
CANDIDATES = 1000
PER_ROUND = 48
SHARE = 0.5
BLOCK = 1 << 20  # bytes of the words of a block
CELLS = 1 << 18  # characters that are cut side by side
FEW = 128  # words that are cut one by one: side by side, a place costs the same for any number of them

# Numbers of symbols: a character's code point, with FIRST added where it begins a
# word; merges count on from MERGED
FIRST, MERGED = 1 << 21, 1 << 22
BLOCKS = "ids binary, sizes binary, n binary, pairs array<struct<left:string,right:string,n:bigint>>"


def choose(pairs: list[tuple[str, str, int]], room: int, min_count: int) -> list[tuple[str, str, int]]:
    """The merges of a round from ``(left, right, n)``, most frequent first."""
    out, used = [], set()
    for left, right, n in pairs:
        if n < min_count or n < SHARE * pairs[0][2] or len(out) == min(room, PER_ROUND):
            break
        if not {left, right} & used:
            out.append((left, right, n))
            used |= {left, right}
    return out


def _points(words: pa.Array) -> np.ndarray:
    """The code points of all words, one word after another."""
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "")[0].as_py()
    return np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int32)


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the exact sum of ``n`` for each."""
    got = pa.table({"k": keys, "n": n}).group_by("k", use_threads=False).aggregate([("n", "sum")])
    return got["k"].to_numpy(), got["n_sum"].to_numpy()


class Symbols:
    """Symbols by number and by name. Merges that spell the same are one symbol."""

    def __init__(self, merges: list[tuple[str, str, int]]):
        self.made = list(dict.fromkeys(a + b for a, b, _ in merges))
        self.number = {s: MERGED + i for i, s in enumerate(self.made)}

    def of(self, name: str) -> int:
        return self.number.get(name) or (ord(name) if len(name) == 1 else FIRST + ord(name[1]))

    def name(self, i: int) -> str:
        return self.made[i - MERGED] if i >= MERGED else " " + chr(i - FIRST) if i >= FIRST else chr(i)

    def names(self, ids: np.ndarray) -> pa.Array:
        distinct, at = np.unique(ids, return_inverse=True)
        return pa.array([self.name(i) for i in distinct.tolist()], pa.string()).take(pa.array(at))


def _pairs(ids: np.ndarray, sizes: np.ndarray, n: np.ndarray, symbols: Symbols) -> list[dict]:
    """The pairs of neighbours in a block's words and how often they stand in the corpus."""
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(sizes) - 1] = False
    at = np.flatnonzero(inner)
    keys, sums = _sums(ids[at].astype(np.int64) << 32 | ids[at + 1], np.repeat(n, sizes)[at])
    names: dict[int, str] = {}

    def name(i: int) -> str:
        if i not in names:
            names[i] = symbols.name(i)
        return names[i]
    return [{"left": name(k >> 32), "right": name(k & 0xFFFFFFFF), "n": s} for k, s in zip(keys.tolist(), sums.tolist(), strict=True)]


class Round:
    """The merges of a round as they apply to a block: each pair, from left to right."""

    def __init__(self, merges: list[tuple[str, str, int]], symbols: Symbols):
        self.right = np.full(MERGED + len(symbols.made), -1, np.int32)
        self.made = np.zeros_like(self.right)
        for a, b, _ in merges:
            self.right[symbols.of(a)], self.made[symbols.of(a)] = symbols.of(b), symbols.of(a + b)

    def apply(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(sizes)
        found = self.right[ids]
        found[ends - 1] = -1  # no pair reaches over the end of a word
        at = np.flatnonzero(found[:-1] == ids[1:])
        # only a pair of two equal symbols can overlap its next: every second one of a run
        k = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, k, 0))
        at = at[(k - begin) % 2 == 0]
        out = ids.copy()
        out[at] = self.made[ids[at]]
        kept = np.ones(len(ids), bool)
        kept[at + 1] = False
        fewer = np.bincount(np.searchsorted(ends, at, "right"), minlength=len(sizes))
        return out[kept], (sizes - fewer).astype(np.int32)


def _block(ids: np.ndarray, sizes: np.ndarray, n: np.ndarray, symbols: Symbols) -> pa.RecordBatch:
    pairs = pa.array([_pairs(ids, sizes, n, symbols)],
                     pa.list_(pa.struct([("left", pa.string()), ("right", pa.string()), ("n", pa.int64())])))
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (ids, sizes, n)] + [pairs], ["ids", "sizes", "n", "pairs"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The blocks in batches of them: symbols, symbols of each word, count of each word."""
    for batch in batches:
        for ids, sizes, n in zip(*(batch.column(c) for c in ("ids", "sizes", "n")), strict=True):
            yield np.frombuffer(ids.as_buffer(), np.int32), np.frombuffer(sizes.as_buffer(), np.int32), np.frombuffer(n.as_buffer(), np.int64)


def _counted(texts: DataFrame, text_col: str) -> DataFrame:
    """The distinct words ``(word, n)``; each stretch of texts is counted where it lies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in stretches(batch.column(0)):
                found = arrow_words(part)[0].value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])
    return (texts.select(for_arrow(F.col(text_col)).alias("text")).mapInArrow(run, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _first_blocks(counted: DataFrame) -> DataFrame:
    """Every word as its characters, the first one marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, kept, held = Symbols([]), [], 0

        def block() -> pa.RecordBatch:
            words, n = (pa.concat_arrays([b.column(c) for b in kept]) for c in ("word", "n"))
            sizes, ids = pc.utf8_length(words).to_numpy(), _points(words)
            ids[np.cumsum(sizes) - sizes] += FIRST
            return _block(ids, sizes, n.to_numpy(), symbols)
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("word")).to_numpy(), dtype=np.int64)
            for at, to in cuts(ends, BLOCK):
                kept.append(batch.slice(at, to - at))
                held += int(ends[to - 1] - (ends[at - 1] if at else 0))
                if held >= BLOCK:
                    yield block()
                    kept, held = [], 0
        if held:
            yield block()
    return counted.mapInArrow(run, BLOCKS)


def _merged(blocks: DataFrame, merges: list[tuple[str, str, int]], fresh: int) -> DataFrame:
    """The blocks after the last ``fresh`` of all merges so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(merges)
        step = Round(merges[-fresh:], symbols)
        for ids, sizes, n in _read(batches):
            yield _block(*step.apply(ids, sizes), n, symbols)
    return blocks.select("ids", "sizes", "n").mapInArrow(run, BLOCKS)


def _learn(texts: DataFrame, n_merges: int, text_col: str, min_count: int) -> tuple[list[tuple[str, str, int]], DataFrame]:
    """The merges, and the blocks of distinct words cut by them."""
    blocks = pin(_first_blocks(_counted(texts, text_col)))
    merges: list[tuple[str, str, int]] = []
    while len(merges) < n_merges:
        top = (blocks.select(F.inline("pairs")).groupBy("left", "right").agg(F.sum("n").alias("n"))
               .orderBy(F.col("n").desc(), "left", "right").limit(CANDIDATES).collect())
        chosen = choose([(r["left"], r["right"], r["n"]) for r in top], n_merges - len(merges), min_count)
        if not chosen:
            break
        merges = merges + chosen
        blocks = pin(_merged(blocks, merges, len(chosen)))
    return merges, blocks


def train(texts: DataFrame, n_merges: int, text_col: str = "text", min_count: int = 2) -> tuple[list[tuple[str, str, int]], DataFrame]:
    """Up to ``n_merges`` merges ``(left, right, n)`` in their order, and the distinct
    words ``(symbols, n)`` cut by them. A pair seen fewer than ``min_count`` times is
    not merged. NULL and empty texts have no words."""
    merges, blocks = _learn(texts, n_merges, text_col, min_count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(merges)
        for ids, sizes, n in _read(batches):
            words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), symbols.names(ids))
            yield pa.RecordBatch.from_arrays([pc.binary_join(words, SEP), pa.array(n)], ["symbols", "n"])
    return merges, blocks.select("ids", "sizes", "n").mapInArrow(run, "symbols string, n bigint")


def merges_frame(spark, merges: list[tuple[str, str, int]]) -> DataFrame:
    rows = [(i + 1, a, b, n) for i, (a, b, n) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left string, right string, n long")


def subword_vocab(texts: DataFrame, n_merges: int, text_col: str = "text", min_count: int = 2) -> DataFrame:
    """Vocabulary ``(token, id, n, is_special)``: special tokens, every single
    character (at the beginning of a word and inside one) and every merge; ``n``
    is how often the token stands in the corpus cut by all merges. Ids go by ``n``,
    ties by token."""
    spark = texts.sparkSession
    merges, blocks = _learn(texts, n_merges, text_col, min_count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(merges)
        for ids, sizes, n in _read(batches):
            found, sums = _sums(ids, np.repeat(n, sizes))
            yield pa.RecordBatch.from_arrays([symbols.names(found), pa.array(sums)], ["token", "n"])
    counts = pin(blocks.select("ids", "sizes", "n").mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n")))
    # every character of the corpus is in a token that stands in it
    letters = counts.select(F.explode(chars(F.regexp_replace("token", "^ ", ""))).alias("c")).distinct()
    base = letters.select(F.explode(F.array("c", F.concat(F.lit(" "), "c"))).alias("token"))
    made = spark.createDataFrame([(a + b,) for a, b, _ in merges], "token string")
    tokens = base.unionByName(made).distinct().join(counts, "token", "left").select(
        "token", F.coalesce("n", F.lit(0)).cast("long").alias("n")).where(~F.col("token").isin(*SPECIAL_TOKENS))
    ranked = exact_rank(tokens, [F.col("n").desc(), F.col("token").asc()])
    return specials_frame(spark).unionByName(ranked.select(
        "token", (F.col("rank") + len(SPECIAL_TOKENS) - 1).cast("int").alias("id"), "n", F.lit(False).alias("is_special")))


class Lattice:
    """Best path over the vocabulary entries that match a word."""

    def __init__(self, entries: list[tuple[str, int, int]]):
        whole = sum(n + 1 for _, _, n in entries)
        self.trie: dict = {}
        self.unknown = -1e9  # below any path of entries: only where nothing else leads on
        for token, i, n in entries:
            node = self.trie
            for c in token:
                node = node.setdefault(c, {})
            node[""] = (i, math.log((n + 1) / whole))
        self._flatten()

    def _flatten(self) -> None:
        """The trie as arrays: nodes by number, a node's entry, and the edges as sorted
        keys of node and character. Characters are numbered from 1; 0 is in no entry."""
        letters: dict[str, int] = {}
        nodes, edges = [self.trie], []
        for k, node in enumerate(nodes):
            for c, child in node.items():
                if c:
                    edges.append((k, letters.setdefault(c, len(letters) + 1), len(nodes)))
                    nodes.append(child)
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = list(letters.values())
        self.kinds = len(letters) + 1
        at = np.array(edges, np.int64).reshape(-1, 3)
        keys = at[:, 0] * self.kinds + at[:, 1]
        order = np.argsort(keys)
        self.edge = np.append(keys[order], np.iinfo(np.int64).max)
        self.child = np.append(at[order, 2], 0)
        self.root = np.zeros(self.kinds, np.int64)  # from the root, by character; no edge leads back to it
        top = at[at[:, 0] == 0]
        self.root[top[:, 1]] = top[:, 2]
        entry = [node.get("", (UNK_ID, -math.inf)) for node in nodes]
        self.entry, self.score = np.array([i for i, _ in entry], np.int32), np.array([s for _, s in entry])

    def cut(self, word: str) -> list[int]:
        size = len(word)
        best, back = [0.0] + [-math.inf] * size, [(0, 0)] * (size + 1)
        for a in range(size):
            node, b = self.trie, a
            while b < size and word[b] in node:
                node, b = node[word[b]], b + 1
                if "" in node:
                    i, score = node[""]
                    if best[a] + score > best[b]:  # from the left: at a tie the longer token is there first
                        best[b], back[b] = best[a] + score, (a, i)
            if best[a] + self.unknown > best[a + 1]:
                best[a + 1], back[a + 1] = best[a] + self.unknown, (a, UNK_ID)
        ids, b = [], size
        while b:
            b, i = back[b]
            ids.append(i)
        return ids[::-1]

    def cut_all(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``cut`` of every word: all ids, and where those of each word begin and how
        many they are. Words of about the same length are cut side by side."""
        size = pc.utf8_length(words).to_numpy().astype(np.int64)
        points, begin = self.letter[_points(words)], np.cumsum(size) - size
        order = np.argsort(-size, kind="stable")
        ids, at, many, held, k = [], np.zeros_like(size), np.zeros_like(size), 0, 0
        while k < len(order):
            some = order[k:k + max(CELLS // max(int(size[order[k]]), 1), 1)]
            if len(some) < FEW:
                got = [self.cut(words[int(w)].as_py()) for w in some]
                flat, n = np.array([i for g in got for i in g], np.int32), np.array([len(g) for g in got])
            else:
                flat, n = self._side_by_side(points, begin[some], size[some])
            ids.append(flat)
            at[some], many[some] = held + np.cumsum(n) - n, n
            held, k = held + len(flat), k + len(some)
        return np.concatenate([*ids, np.zeros(0, np.int32)]), at, many

    def _side_by_side(self, points: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of falling size, in one array, and their number a word."""
        rows, width = int(size[0]), len(size)
        live = [int(np.searchsorted(-size, -a, "left")) for a in range(rows + 1)]  # words with more than a characters
        text = np.zeros((rows + 1) * width, np.int32)  # a row for each place in the words
        for a in range(rows):
            text[a * width:a * width + live[a]] = points[begin[:live[a]] + a]
        # the entries that match, by length: where they begin, row by row
        matches, start, node = [], np.arange(rows * width), self.root[text[:rows * width]]
        for length in range(1, rows + 1):
            alive = np.flatnonzero(node)
            if not len(alive):
                break
            start, node = start[alive], node[alive]
            hit = np.flatnonzero(self.score[node] > -math.inf)
            if len(hit):
                s = start[hit]
                matches.append((length, s % width, self.entry[node[hit]], self.score[node[hit]], np.searchsorted(s, np.arange(rows + 1) * width)))
            if length < rows:
                start, node = (x[:np.searchsorted(start, (rows - length) * width)] for x in (start, node))
                key = node * self.kinds + text[start + length * width]
                edge = np.searchsorted(self.edge, key)
                node = np.where(self.edge[edge] == key, self.child[edge], 0)
        best = np.full((rows + 1, width), -math.inf)
        best[0] = 0
        token, back = np.full((rows + 1, width), UNK_ID, np.int32), np.ones((rows + 1, width), np.int32)
        for b in range(1, rows + 1):
            for length, word, entry, score, bounds in reversed(matches):  # at a tie the longer token is there first
                a = b - length
                if a >= 0 and bounds[a] < bounds[a + 1]:
                    part = slice(bounds[a], bounds[a + 1])
                    w = word[part]
                    sums = best[a, w] + score[part]
                    better = np.flatnonzero(sums > best[b, w])
                    w = w[better]
                    best[b, w], token[b, w], back[b, w] = sums[better], entry[part][better], length
            sums = best[b - 1, :live[b - 1]] + self.unknown
            w = np.flatnonzero(sums > best[b, :live[b - 1]])
            best[b, w], token[b, w], back[b, w] = sums[w], UNK_ID, 1
        ends = np.zeros((width, rows + 1), bool)  # on the path of the word, a token ends here
        w, b = np.arange(width), size.copy()
        while len(w):
            ends[w, b] = True
            b = b - back[b, w]
            more = b > 0
            w, b = w[more], b[more]
        ends[:, 0] = False
        return token.T[ends], ends.sum(axis=1)


def subword_tokenizer(vocab: DataFrame) -> Callable[[Column], Column]:
    """A tokenizer for ``encode_with``: text to ids by the best path. The vocabulary
    must fit the broadcast bound; training bounds it by its merges and the alphabet."""
    n, row_bytes = vocab_stats(vocab)
    if not is_broadcastable(n, 16 * row_bytes):  # as a trie of Python objects
        raise ValueError(f"{n} vocabulary entries are too many to broadcast")
    entries = [(r["token"], r["id"], r["n"]) for r in vocab.where("NOT is_special").select("token", "id", "n").orderBy("id").collect()]
    shared = vocab.sparkSession.sparkContext.broadcast(entries)

    @F.arrow_udf("array<int>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lattice = Lattice(shared.value)
        for batch in batches:
            for texts in stretches(batch):
                words, of_text = arrow_words(texts)
                found = words.dictionary_encode()
                ids, at, many = lattice.cut_all(pc.binary_join_element_wise(" ", found.dictionary, ""))
                word = found.indices.to_numpy()
                at, many = at[word], many[word]
                ends = np.cumsum(many)
                places = np.repeat(at - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)
                offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(of_text)])]
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[places], pa.int32()))

    return lambda text: cut(for_arrow(text))


def joined(tokens: Column) -> Column:
    """Decoded tokens to text: a token that begins with a space begins a word."""
    return F.regexp_replace(F.array_join(tokens, ""), "^ ", "")
