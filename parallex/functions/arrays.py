"""Array column functions that lay out model-ready examples.

All of them are per-row expressions: they run inside whole-stage codegen and
never shuffle. ``L`` is the sequence length; ids are ``array<int>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parallex.config import EOS_ID, PAD_ID, SOS_ID


def _ids(x: int) -> Column:
    return F.array(F.lit(x).cast("int"))


def _pads(n: Column, pad: int) -> Column:
    return F.array_repeat(F.lit(pad).cast("int"), n)


def encoder_input(src_ids: Column, seq_len: int, sos: int = SOS_ID,
                  eos: int = EOS_ID, pad: int = PAD_ID) -> Column:
    """``[SOS] + src + [EOS] + [PAD] * (L - n - 2)``."""
    return F.concat(_ids(sos), src_ids, _ids(eos), _pads(F.lit(seq_len) - F.size(src_ids) - 2, pad))


def decoder_input(trg_ids: Column, seq_len: int, sos: int = SOS_ID, pad: int = PAD_ID) -> Column:
    """``[SOS] + trg + [PAD] * (L - m - 1)`` (no EOS)."""
    return F.concat(_ids(sos), trg_ids, _pads(F.lit(seq_len) - F.size(trg_ids) - 1, pad))


def label(trg_ids: Column, seq_len: int, eos: int = EOS_ID, pad: int = PAD_ID) -> Column:
    """``trg + [EOS] + [PAD] * (L - m - 1)``: the decoder input shifted left."""
    return F.concat(trg_ids, _ids(eos), _pads(F.lit(seq_len) - F.size(trg_ids) - 1, pad))


def non_pad(ids: Column, pad: int = PAD_ID) -> Column:
    """1 where the id is not PAD, else 0 (the encoder mask)."""
    return F.transform(ids, lambda x: (x != F.lit(pad)).cast("int"))


def encoder_mask(encoder_ids: Column, pad: int = PAD_ID) -> Column:
    """The encoder mask: 1 where the encoder input is not PAD."""
    return non_pad(encoder_ids, pad)


def filled(n: Column, seq_len: int) -> Column:
    """``n`` ones, then zeros up to ``seq_len``: the mask of a row of ``n`` ids."""
    def cells(x: int, k: Column) -> Column:
        return F.array_repeat(F.lit(x).cast("int"), k)
    return F.concat(cells(1, n), cells(0, F.lit(seq_len) - n))


def expand_decoder_mask(dec_valid: Column) -> Column:
    """Decoder mask ``m[i][j] = valid[j] AND j <= i`` as ``array<array<int>>``.

    Only built on request: it holds L*L cells per row (230 400 at L = 480).
    """
    n = F.size(dec_valid)
    return F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.transform(dec_valid, lambda v, j: ((v == 1) & (j <= i)).cast("int")),
    )


def decoder_mask_cells(dec_valid: Column) -> Column:
    """Number of set cells of the decoder mask, without building it: a valid
    position ``j`` is set in the rows ``j .. L-1``."""
    n = F.size(dec_valid)
    return F.aggregate(F.transform(dec_valid, lambda v, j: (v * (n - j)).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)


def render(ids: Column, sep: str = ",") -> Column:
    """Array as text, for reports and cross-engine comparison."""
    return F.array_join(ids, sep)


def render_rows(rows: Column) -> Column:
    """Arrays of numbers as one text, ``render`` of each with ";" between them. Written
    as JSON, the numbers of a row go straight into one buffer; joining them makes a
    string of every cell first. No cell may be NULL."""
    written = F.transform(rows, lambda x: F.to_json(x).cast("binary"))
    # without the brackets: cut off the bytes, which takes no search through the text
    cells = F.transform(written, lambda x: F.substring(x, F.lit(2), F.octet_length(x) - 2).cast("string"))
    return F.array_join(cells, ";")
