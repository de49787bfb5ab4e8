"""Logistic mixing of hashed-context bit predictors over text units.

A text is cut into units: up to 62 bytes of a word and the white-space byte (or
the end mark ``\\xff``, which UTF-8 never holds) that ends it, or 63 bytes of a
longer word, whose rest is marked as going on. Both are fixed by the bytes seen
so far, so a text's probability is the product of its units' and sums to one
over all texts. A unit's bytes are coded bit by bit, highest first. Every bit
after the first byte is predicted from counts in four contexts hashed with the
bits already known: place in the unit; last byte; last two bytes; the unit's whole
prefix. These do not reach back over the unit's start, so a unit's probability
after its first byte is the same wherever it stands. The first byte is predicted
from what came before (``Firsts``): the previous unit's word, hashed; the last two
bytes of that word, hashed; and whether a cut word goes on.

The counts become stretched probabilities and are mixed by weights that a gate
(how often the prefix and the last two bytes were seen here) selects. Weights are
learned online: predict, compare, correct. A refinement table then corrects the
mixed probability by what followed such predictions, and keeps adapting as it
learns. During learning a unit's own occurrence is taken out of the counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LONG = 63
_ENDS = frozenset(b" \t\n\r\x0b\x0c\xff")
_END = np.isin(np.arange(256), list(_ENDS))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1)
_SAME = np.array([8 - i.bit_length() for i in range(256)])  # leading bits in which two bytes agree, by their xor
CUT = b"\xfd"        # leads a unit that goes on with a cut word (no UTF-8 text holds it)
WORD_MARK = b"\xfe"  # leads the key of a word too long for one unit

N_GLOBAL, N_LOCAL = 3, 1
GLOBAL_BITS = (14, 18, 20)  # slots of the tables for place, last byte, last two bytes
LOCAL_BITS = 22             # slots of a partition's tables for prefixes, at least
UNIT_SLOTS = 16             # of them, for every unit of the partition
LOCAL_FROM = 3              # bytes a prefix needs at least: units are dealt by their first bytes or more
PRIOR = 0.05
GATES = 18
INPUTS = N_GLOBAL + N_LOCAL + 1
CELLS = 33
_STEP = 1 << 14
FIRST = 1                   # bytes of a unit that are predicted from the unit before
WORD_CLASSES, END_CLASSES = 1 << 12, 1 << 11  # hashed contexts of the first byte
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def split(texts: Sequence[bytes | None]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The units of all texts in order as keys, then the words that span several of
    them, and the number of the text that each stands in."""
    joined = b"\xff".join([*[t or b"" for t in texts], b""])
    data = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(_END[data]) + 1
    starts = np.concatenate([np.zeros(1, np.int64), ends])[:-1]
    stop = np.searchsorted(ends, np.cumsum([len(t or b"") + 1 for t in texts]), side="right")
    of = np.repeat(np.arange(len(texts)), np.diff(stop, prepend=0))
    pieces = -(-(ends - starts) // LONG)
    long = np.flatnonzero(pieces > 1)
    if not len(long):
        return _keys(np.append(starts, len(data)), joined), of
    marks = [WORD_MARK + joined[a:b - 1].lower() for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    unit = np.repeat(np.arange(len(starts)), pieces)
    nth = np.arange(len(unit)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at, goes_on = starts[unit] + LONG * nth, nth > 0
    data = np.insert(data, at[goes_on], CUT[0])
    at = np.append(at + np.cumsum(goes_on) - goes_on, len(data))
    return pa.concat_arrays([_keys(at, data), pa.array(marks, pa.large_binary())]), np.concatenate([of[unit], of[long]])


def _keys(at: np.ndarray, data) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])


def _raw(found: Sequence[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all keys in one array, where each begins there, and its size."""
    found = found.cast(pa.large_binary()) if isinstance(found, pa.Array) else pa.array(found, pa.large_binary())
    _, at, data = found.buffers()
    if not len(found) or data is None:
        return np.zeros(1, np.uint8), np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    at = np.frombuffer(at, np.int64)[found.offset:found.offset + len(found) + 1]
    return np.frombuffer(data, np.uint8), at[:-1].copy(), np.diff(at)


def _crc(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    order = np.argsort(-size, kind="stable")
    at, size = at[order], size[order]
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for t in range(int(size[0]) if len(at) else 0):
        n = int(np.searchsorted(-size, -t, side="left"))
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + t]) & 255] ^ crc[:n] >> 8
    out = np.empty_like(crc)
    out[order] = ~crc
    return out


def crc(found: Sequence[bytes] | pa.Array) -> np.ndarray:
    """The CRC-32 of every key."""
    return _crc(*_raw(found))


def hashes(found: Sequence[bytes] | pa.Array) -> np.ndarray:
    """64 bits for every key, the same for equal keys within a process."""
    data, at, size = _raw(found)
    out = np.empty(len(at), np.uint64)
    long = size > LONG + 1  # words that span several units
    out[long] = [hash(data[a:a + n].tobytes()) & (1 << 64) - 1 for a, n in zip(at[long].tolist(), size[long].tolist(), strict=True)]
    order = np.argsort(-size, kind="stable")[int(long.sum()):]
    at, size, found = at[order], size[order], np.zeros(len(order), np.uint64)
    for t in range(int(size[0]) if len(at) else 0):
        n = int(np.searchsorted(-size, -t, side="left"))
        mixed = (found[:n] ^ (data[at[:n] + t] + np.uint64(1))) * _K[0]
        found[:n] = mixed ^ mixed >> np.uint64(32)
    out[order] = found
    return out


def keys(text: bytes | None) -> list[bytes]:
    """The units of the text and the words that span several of them, as keys."""
    return split([text])[0].to_pylist()


def word_of(key: bytes) -> bytes | None:
    """The word (A-Z lower-cased) that a key stands for, if it holds a whole one."""
    if key[:1] == WORD_MARK:
        return key[1:]
    if key[:1] == CUT or key[-1] not in _ENDS or len(key) < 2:
        return None
    return key[:-1].lower()


def _lead(word: bytes) -> int:
    return (zlib.crc32(word) % WORD_CLASSES) * END_CLASSES + zlib.crc32(word[-2:]) % END_CLASSES


START = _lead(b"\xff")  # before a text's first unit


def traits(found: Sequence[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For every key what it is as the unit before another (its hashed contexts), and
    its own first byte with 256 for a unit that goes on with a cut word; -1 for the
    key of a long word, which is no unit."""
    data, at, size = _raw(found)
    cut, mark = data[at] == CUT[0], data[at] == WORD_MARK[0]
    at, size = at + cut, np.where(mark, 0, size - cut)
    first = np.where(mark, -1, data[at] + 256 * cut.astype(np.int64))
    size = size - (_END[data[at + size - 1]] & (size > 0))
    low, two = _LOWER[data], np.minimum(size, 2)
    word, end = _crc(low, at, size), _crc(low, at + size - two, two)
    return (word % WORD_CLASSES).astype(np.int64) * END_CLASSES + end % END_CLASSES, first


def first_codes(at: list[np.ndarray] | np.ndarray, lead: np.ndarray, first: np.ndarray,
                text: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Texts are given by the positions of their keys: an array each, or one for all
    with the ``text`` of each position. One code for every unit of all texts (contexts of
    the unit before, own first byte), and the text it stands in."""
    if text is None:
        text = np.repeat(np.arange(len(at)), np.array([len(a) for a in at], np.int64))
        at = np.concatenate([*at, np.zeros(0, np.int64)])
    own = first[at]
    if len(own) and own.min() < 0:
        at, text, own = at[own >= 0], text[own >= 0], own[own >= 0]
    before = np.full(len(at), START, np.int64)
    before[1:] = lead[at[:-1]]
    before[1:][text[1:] != text[:-1]] = START
    return before * 512 + own, text


class Firsts:
    """Distinct codes of first bytes with the walk over their bits. Tables are those of
    ``Units`` by number: kind alone; none; ending of the word before; word before."""

    SLOTS = (512, 1, END_CLASSES * 256, WORD_CLASSES * 256)

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.count, self.whole = codes, np.asarray(counts, np.float64), None

    @classmethod
    def tables(cls) -> list[np.ndarray]:
        return [np.zeros((n, 2), np.float32) for n in cls.SLOTS]

    def walk(self):
        byte, kind, lead = self.codes & 255, self.codes >> 8 & 1, self.codes >> 9
        word, end = (lead // END_CLASSES ^ kind * 0xA5A) * 256, (lead % END_CLASSES ^ kind * 0x2D5) * 256
        node = np.ones(len(byte), np.int64)
        for b in range(7, -1, -1):
            bit = byte >> b & 1
            yield len(byte), bit, node, [kind * 256 + node, None, end + node, word + node]
            node = node << 1 | bit


class Units:
    """Units in arrays, longest first, with the walk over their bits."""

    def __init__(self, found: list[bytes], counts: np.ndarray, bits: int = LOCAL_BITS, whole: np.ndarray | None = None):
        """``whole``: bytes of its key from which a unit counts for its prefixes (default: all)."""
        self.bits = bits
        kind = np.array([k[:1] == CUT for k in found], bool)
        found = [k[1:] if c else k for k, c in zip(found, kind.tolist(), strict=True)]
        size = np.array([len(k) for k in found], np.int64)
        self.order = np.argsort(-size, kind="stable")
        self.size = size[self.order]
        self.count = np.asarray(counts, np.float64)[self.order]
        self.kind = kind.astype(np.uint64)[self.order]
        self.whole = None if whole is None else (np.asarray(whole, np.int64) - kind)[self.order]
        width = int(self.size[0]) if len(found) else 0
        flat = b"".join([found[i].ljust(width, b"\0") for i in self.order])
        self.data = np.frombuffer(flat, np.uint8).reshape(len(found), width)

    def walk(self):
        """Yields ``(n, bit, node, slots)`` for every bit of the first ``n`` units, from
        byte ``FIRST`` on; ``slots`` are the rows of the tables with both counts, None for a prefix
        of less than ``LOCAL_FROM`` bytes."""
        kind, prefix, one, two = _begin(self.kind)
        for t in range(self.data.shape[1]):
            n = int(np.searchsorted(-self.size, -t, side="left"))  # units with more than t bytes
            kind, prefix, one, two = kind[:n], prefix[:n], one[:n], two[:n]
            byte = self.data[:n, t].astype(np.uint64)
            contexts = _contexts(t, kind, prefix, one, two)
            node = np.ones(n, np.uint64)
            for b in range(7, -1, -1) if t >= FIRST else ():
                bit = (byte >> np.uint64(b)) & np.uint64(1)
                yield n, bit.astype(np.int64), node.astype(np.int64), _slots(contexts, node, self.bits)
                node = (node << np.uint64(1)) | bit
            prefix, one, two = _after(byte, prefix, one)


class Grams:
    """The distinct bytes of units, from byte ``FIRST`` on, with what the tables that no
    partition holds alone see of the bytes before; and the walk over their bits."""

    def __init__(self, found: list[bytes], counts: np.ndarray):
        units, codes, count = Units(found, counts), [np.zeros(0, np.int64)], [np.zeros(0)]
        data, kind = units.data, units.kind.astype(np.int64) << 26
        for t in range(FIRST, data.shape[1]):
            n = int(np.searchsorted(-units.size, -t, side="left"))
            two = data[:n, t - 2].astype(np.int64) << 16 if t > 1 else 0
            codes.append(kind[:n] | min(t, 3) << 24 | two | data[:n, t - 1].astype(np.int64) << 8 | data[:n, t])
            count.append(units.count[:n])
        coded = pa.array(np.concatenate(codes)).dictionary_encode()
        self.codes, self.whole = coded.dictionary.to_numpy(), None
        self.count = np.bincount(coded.indices.to_numpy(), np.concatenate(count), len(self.codes))

    def walk(self):
        for t in range(FIRST, 4):  # later bytes count as byte 3
            mine = (self.codes >> 24 & 3) == t
            code = self.codes[mine].astype(np.uint64)
            kind, byte, one = code >> np.uint64(26), code & np.uint64(255), (code >> np.uint64(8) & np.uint64(255)) + np.uint64(1)
            two = one + (((code >> np.uint64(16) & np.uint64(255)) + np.uint64(1)) * np.uint64(257) if t > 1 else np.uint64(0))
            contexts = _contexts(t, kind, None, one, two)
            node = np.ones(len(code), np.uint64)
            for b in range(7, -1, -1):
                bit = (byte >> np.uint64(b)) & np.uint64(1)
                yield self.count[mine], bit.astype(np.int64), node.astype(np.int64), _slots(contexts, node, LOCAL_BITS)
                node = (node << np.uint64(1)) | bit


class Paths:
    """Distinct units in the order of their bytes: bits that neighbours share from the
    start are walked once. No unit may be the start of another."""

    def __init__(self, found: list[bytes], counts: np.ndarray, bits: int = LOCAL_BITS, whole: np.ndarray | None = None):
        """``whole`` as in ``Units``."""
        found = pa.array(found, pa.large_binary())
        self.bits, self.order = bits, pc.sort_indices(found).to_numpy()
        self.data, at, size = _raw(found)
        at, size = at[self.order], size[self.order]
        kind = self.data[at] == CUT[0]
        self.kind, self.at, self.size = kind.astype(np.uint64), at + kind, size - kind
        self.count = np.asarray(counts, np.float64)[self.order]
        self.whole = None if whole is None else np.asarray(whole, np.int64)[self.order] - kind
        self.shared = np.zeros(len(at), np.int64)  # bits that are those of the unit before
        pair = np.flatnonzero(kind[1:] == kind[:-1]) + 1
        for t in range(int(self.size.max(initial=0)) + 1):
            on = np.minimum(self.size[pair], self.size[pair - 1]) > t
            self.shared[pair[~on]] = 8 * t
            pair = pair[on]
            apart = self.data[self.at[pair] + t] ^ self.data[self.at[pair - 1] + t]
            self.shared[pair[apart > 0]] = 8 * t + _SAME[apart[apart > 0]]
            pair = pair[apart == 0]

    def walk(self, tables: slice = slice(None)) -> Iterator[tuple]:
        """Yields ``(depth, rows, lead, bit, node, slots)`` for every bit from byte
        ``FIRST`` on: the units that have it, the places in ``rows`` of the first of those that
        agree up to and with it, and for these the bit and the rows of ``tables``."""
        rows = np.arange(len(self.at))
        kind, prefix, one, two = _begin(self.kind)
        for t in range(int(self.size.max(initial=0))):
            on = self.size[rows] > t
            if not on.all():
                rows, kind, prefix, one, two = (x[on] for x in (rows, kind, prefix, one, two))
            byte, shared = self.data[self.at[rows] + t].astype(np.uint64), self.shared[rows]
            contexts = _contexts(t, kind, prefix, one, two)
            contexts = [c if i in range(N_GLOBAL + N_LOCAL)[tables] else None for i, c in enumerate(contexts)]
            for b in range(7, -1, -1) if t >= FIRST else ():
                depth = 8 * t + 7 - b
                lead = np.flatnonzero(shared <= depth)
                coded = byte[lead] | np.uint64(256)
                node, bit = coded >> np.uint64(b + 1), coded >> np.uint64(b) & np.uint64(1)
                slots = _slots([None if c is None else c[lead] for c in contexts], node, self.bits)
                yield depth, rows, lead, bit.astype(np.int64), node.astype(np.int64), slots
            prefix, one, two = _after(byte, prefix, one)


def _begin(kind: np.ndarray) -> tuple[np.ndarray, ...]:
    return kind, np.full(len(kind), 0x243F6A8885A308D3, np.uint64), np.zeros(len(kind), np.uint64), np.zeros(len(kind), np.uint64)


def _contexts(t: int, kind, prefix, one, two) -> list[np.ndarray]:
    """What byte ``t`` is predicted from: place, last byte, last two, and the prefix where it is long enough."""
    contexts = [kind * np.uint64(8) + np.uint64(min(t, 3)), one * np.uint64(4) + np.uint64(min(t, 2)),
                two * np.uint64(4) + np.uint64(min(t, 3))]
    if t >= LOCAL_FROM and prefix is not None:
        contexts.append(prefix + kind)
    return [(c + np.uint64(1)) * k for c, k in zip(contexts, _K, strict=False)]


def _slots(contexts: list[np.ndarray | None], node: np.ndarray, bits: int) -> list[np.ndarray | None]:
    mixed, slots = node * _K[2], []
    for c, b in zip(contexts, [*GLOBAL_BITS, *[bits] * N_LOCAL], strict=False):
        if c is None:
            slots.append(None)
            continue
        h = (c ^ mixed) * _K[3]
        h ^= h >> np.uint64(29)
        slots.append(((h * _K[1]) >> np.uint64(64 - b)).astype(np.int64))
    return slots + [None] * (N_GLOBAL + N_LOCAL - len(slots))


def _after(byte: np.ndarray, prefix: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, ...]:
    prefix = (prefix ^ (byte + np.uint64(1))) * _K[0]
    return prefix ^ (prefix >> np.uint64(32)), byte + np.uint64(1), one * np.uint64(257) + byte + np.uint64(1)


def new_global() -> list[np.ndarray]:
    return [np.zeros((1 << b, 2), np.float32) for b in GLOBAL_BITS]


def local_bits(n: int) -> int:
    """Size of the prefix tables of a partition with ``n`` units."""
    return max(LOCAL_BITS, (UNIT_SLOTS * n - 1).bit_length())


def new_local(bits: int = LOCAL_BITS) -> list[np.ndarray]:
    return [np.zeros((1 << bits, 2), np.float32) for _ in range(N_LOCAL)]


def learn_counts(units: Units | Firsts, tables: list[np.ndarray | None]) -> None:
    """Add the units' counts to the tables that are given."""
    for i, (n, bit, _, slots) in enumerate(units.walk()):
        w = units.count[:n].astype(np.float32)
        whole = w if units.whole is None else w * (units.whole[:n] <= FIRST + i // 8)
        for k, (table, s) in enumerate(zip(tables, slots, strict=True)):
            if table is not None and s is not None:
                np.add.at(table.reshape(-1), 2 * s + bit, w if k < N_GLOBAL else whole)


def learn_low_counts(grams: Grams, tables: list[np.ndarray]) -> None:
    """Add the counts of units, given by their bytes, to the tables that no partition holds alone."""
    for count, bit, _, slots in grams.walk():
        for table, s in zip(tables, slots, strict=False):
            np.add.at(table.reshape(-1), 2 * s + bit, count.astype(np.float32))


def learn_prefix_counts(paths: Paths, tables: list[np.ndarray]) -> None:
    """Add the units' counts to a partition's tables."""
    for depth, rows, lead, bit, _, slots in paths.walk(slice(N_GLOBAL, None)):
        if depth < 8 * LOCAL_FROM or not len(lead):
            continue
        count = paths.count[rows] if paths.whole is None else paths.count[rows] * (paths.whole[rows] <= depth // 8)
        count = np.add.reduceat(count, lead).astype(np.float32)
        for table, s in zip(tables, slots[N_GLOBAL:], strict=True):
            np.add.at(table.reshape(-1), 2 * s + bit, count)


def new_weights() -> np.ndarray:
    w = np.full((GATES, INPUTS), 0.3)
    w[:, -1] = 0.0
    return w


def _inputs(tables, slots, bit):
    """Stretched predictions of the contexts that a unit has here, and the gate; every
    unit's own occurrence is taken out."""
    sign = (2 * bit - 1).astype(np.float32)
    x, gate = [], 0
    for i, (table, s) in enumerate(zip(tables, slots, strict=True)):
        if s is None:
            continue
        flat, at = table.reshape(-1), 2 * s + bit
        same, other = np.maximum(flat.take(at) - 1, 0), flat.take(at ^ 1)
        if i in (2, 3):
            gate = gate + _gate(i, same + other)
        stretched = np.log((same + np.float32(PRIOR)) / (other + np.float32(PRIOR))) * sign
        x.append((i, np.clip(stretched, -12, 12, out=stretched)))
    return x, gate


def _gate(table: int, seen: np.ndarray) -> np.ndarray:
    """A table's part of the gate, by how often the context and node were seen."""
    if table == 2:
        return (seen > 30).astype(np.int64) + (seen > 3000)
    return 3 * (1 + (seen > 0).astype(np.int64) + (seen > 2) + (seen > 15) + (seen > 255))


def _cell(dot):
    return np.rint((np.clip(dot, -8, 8) + 8) * 2).astype(np.int64)


def learn_weights(units: Units | Firsts, tables, weights: np.ndarray, moved: np.ndarray, refine: np.ndarray, rate: float = 0.02) -> None:
    """One online pass: ``weights``, their gradient sums ``moved`` and the
    refinement counts (node, cell, bit) change in place."""
    cells = refine.reshape(-1)
    for n, bit, node, slots in units.walk():
        x, gate = _inputs(tables, slots, bit)
        mix = np.ascontiguousarray(weights.T, np.float32)
        dot = mix[-1].take(gate) * np.float32(0.3)
        for i, xi in x:
            dot += mix[i].take(gate) * xi
        p = 1 / (1 + np.exp(-np.clip(dot, -30, 30)))
        w = units.count[:n]
        error = (bit - p) * w
        mass = np.bincount(gate, w, GATES)
        step = np.zeros((GATES, INPUTS))
        step[:, -1] = 0.3 * np.bincount(gate, error, GATES)
        for i, xi in x:
            step[:, i] = np.bincount(gate, error * xi, GATES)
        step /= np.maximum(mass, 1e-9)[:, None]
        moved += step * step
        weights += rate * step / np.sqrt(moved + 1e-6)
        np.add.at(cells, 2 * (node * CELLS + _cell(dot)) + bit, w)


class Scorer:
    """The learned model with what scoring reads: stretched predictions and each table's
    part of the gate (worked out beforehand in all but prefix tables, of which a slot is
    read about once), and the refinement as a line in p."""

    def __init__(self, tables, weights: np.ndarray, refine: np.ndarray, trust: float = 50.0):
        self.tables = tables
        self.ready = {i: self._worked_out(i, t) for i, t in enumerate(tables) if len(t) < 1 << LOCAL_BITS}
        self.weights = np.ascontiguousarray(weights.T.astype(np.float32))
        zero, ones = refine[..., 0].ravel(), refine[..., 1].ravel()
        self.base = (0.5 * ones / (zero + ones + trust)).astype(np.float32)
        self.slope = (0.5 + 0.5 * trust / (zero + ones + trust)).astype(np.float32)

    @staticmethod
    def _worked_out(i: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        zero, ones = np.ascontiguousarray(counts[:, 0]), np.ascontiguousarray(counts[:, 1])
        stretched = np.log(ones + np.float32(PRIOR)) - np.log(zero + np.float32(PRIOR))
        return np.clip(stretched, -12, 12, out=stretched), _gate(i, zero + ones).astype(np.uint8) if i in (2, 3) else None

    def _log10(self, bit: np.ndarray, node: np.ndarray, slots: list[np.ndarray | None]) -> np.ndarray:
        read = {}
        for i, s in enumerate(slots):
            if i in self.ready and s is not None:
                read[i] = [None if x is None else x.take(s) for x in self.ready[i]]
            elif s is not None:
                read[i] = self._worked_out(i, self.tables[i].take(s, axis=0))
        gate = read[2][1].astype(np.int64)
        if 3 in read:
            gate += read[3][1]
        dot = self.weights[-1].take(gate) * np.float32(0.3)
        for i, (stretched, _) in read.items():
            dot += self.weights[i].take(gate) * stretched
        np.clip(dot, -30, 30, out=dot)
        at = node * CELLS + _cell(dot)
        p = self.base.take(at) + self.slope.take(at) / (1 + np.exp(-dot))
        return np.log10(np.clip(np.where(bit == 1, p, 1 - p), 1e-6, 1))

    def log_probability(self, units: Units | Firsts | Paths) -> np.ndarray:
        """log10 probability of every unit after its first byte, or of every first byte,
        in the order in which they were given."""
        total = np.zeros(len(units.count))
        if isinstance(units, Paths):
            for depth, rows, lead, *step in units.walk():
                rows = rows[lead]
                new = np.flatnonzero(units.shared[rows] == depth)  # they part from an earlier unit here
                old = np.arange(len(rows))
                old[new] = 0
                total[rows[new]] = total[rows[np.maximum.accumulate(old)[new]]]
                for i in range(0, len(rows), _STEP):
                    total[rows[i:i + _STEP]] += self._log10(*[x[i:i + _STEP] for x in step[:2]], [s if s is None else s[i:i + _STEP] for s in step[2]])
        else:
            for n, *step in units.walk():
                total[:n] += self._log10(*step)
        if isinstance(units, Firsts):
            return total
        out = np.empty_like(total)
        out[units.order] = total
        return out
