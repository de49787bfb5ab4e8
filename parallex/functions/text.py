"""Text column functions: word and character split (words also of Arrow arrays),
row-id test, and the word-to-symbol mapping used for word-level edit distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. The whitespace set of Python's ``str.split()`` (which the
# reference's metrics use to cut words), as a regular-expression class that
# Java and RE2 both read: ASCII \t \n \v \f \r and space, U+001C-U+001F,
# U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
WHITESPACE_RUN = (
    r"[\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
# One code point, newlines included.
ONE_CHAR = r"(?s)."
ROW_ID = r"^[0-9]+\z"  # ASCII digits only; \z so a trailing newline does not match


def _no_tokens() -> Column:
    return F.array().cast("array<string>")


def words(text: Column) -> Column:
    """Whitespace-separated words (no empty strings); a NULL text has none
    (so ``size`` is 0 whatever the session's ANSI setting)."""
    return F.coalesce(F.array_remove(F.split(text, WHITESPACE_RUN), ""), _no_tokens())


STRETCH_BYTES = 8 << 20


def cuts(ends: np.ndarray, most: int = STRETCH_BYTES) -> Iterator[tuple[int, int]]:
    """Stretches ``(from, to)`` of rows whose sizes add up to ``ends``, each of about
    ``most`` bytes; a larger row is one alone."""
    at = 0
    while at < len(ends):
        to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")), at + 1)
        yield at, to
        at = to


def stretches(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in slices of about ``STRETCH_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for at, to in cuts(np.cumsum(sizes, dtype=np.int64)):
        yield texts.slice(at, to - at)


def for_arrow(text: Column) -> Column:
    """The text for ``arrow_words``, which reads UTF-8 only: any other bytes become
    what ``words`` makes of them."""
    return F.when(F.is_valid_utf8(text), text).otherwise(F.array_join(words(text), " "))


def arrow_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words`` of an Arrow array of texts: all of them one after another, and how
    many each text has. Arrow cuts at the characters of ``WHITESPACE_RUN``."""
    lists = pc.utf8_split_whitespace(texts)
    found = lists.flatten()
    real = pc.greater(pc.binary_length(found), 0)  # white space at an end leaves an empty one
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    return found.filter(real), np.diff(before[ends], prepend=0)


def chars(text: Column) -> Column:
    """Code points of ``text`` (a surrogate pair stays one character); none for
    a NULL text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(ONE_CHAR), 0), _no_tokens())


def tokenize(text: Column, mode: str = "word") -> Column:
    if mode == "word":
        return words(text)
    if mode == "char":
        return chars(text)
    raise ValueError(f"unknown tokenizer mode {mode!r}")


def joiner(mode: str) -> str:
    """Separator that turns tokens of ``mode`` back into text."""
    return " " if mode == "word" else ""


def is_row_id(text: Column) -> Column:
    """True when the input is a row number rather than a sentence."""
    return text.rlike(ROW_ID)


# Code points used as one-character stand-ins for words. They start after
# Latin-1 and skip the UTF-16 surrogate block, so any index below ~1.1 million
# maps to exactly one code point (a pair that long is cut into blocks before).
_SYMBOL_BASE = 0x100
_SURROGATE_LO, _SURROGATE_HI = 0xD800, 0xDFFF


def symbol(index: Column) -> Column:
    """One character for a 1-based ``index`` (built JVM-side from its code point)."""
    cp = index + F.lit(_SYMBOL_BASE - 1)
    cp = F.when(cp >= _SURROGATE_LO, cp + (_SURROGATE_HI - _SURROGATE_LO + 1)).otherwise(cp)
    return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")


def as_symbols(tokens: Column, alphabet: Column) -> Column:
    """Rewrite a token array as a string with one character per token, the
    character chosen by the token's position in ``alphabet`` (distinct tokens).
    Edit distance on such strings equals edit distance on the token arrays.

    ``tokens`` and ``alphabet`` must be column references (or other cheap
    expressions): Spark evaluates a lambda body once per element, so an
    expression captured inside it is recomputed for every element.
    """
    idx = F.transform(tokens, lambda t: F.array_position(alphabet, t))
    return F.array_join(F.transform(idx, symbol), "")
