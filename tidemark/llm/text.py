"""Vectorised text helpers for Arrow batches inside tasks.

Texts are read as one UTF-8 byte buffer per slice, so words, lines and shingles
come from array operations instead of per-character Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single text is its own slice.
SLICE_BYTES = 1_000_000

SPACES = b" \t\n\v\f\r"
NOT_SPACE = np.array([b not in SPACES for b in range(256)])
#: A-Z to a-z, every other byte as it is.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_U = np.uint64
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply rounds)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_ODD))
_STEP = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_BACK = pow(_STEP, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        out[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(out)
    return have[:n]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about ``most`` bytes of ``text``."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pa.concat_arrays([column])  # a slice gets offsets of its own
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE):
    """Words as maximal runs of bytes for which ``inside`` holds, none crossing a row.

    Returns (starts, ends, words per row).
    """
    if not len(raw):
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(offsets) - 1, np.int64)
    mask = inside[raw]
    before = np.empty_like(mask)
    before[0] = False
    before[1:] = mask[:-1]
    edges = offsets[1:-1]
    before[edges[edges < len(raw)]] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty_like(mask)
    after[-1] = False
    after[:-1] = mask[1:]
    last = edges[edges > 0] - 1
    after[last] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, by prefix sums of a polynomial."""
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_STEP, len(raw)), out=total[1:])
    return mix((total[ends] - total[starts]) * _powers(_BACK, len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, counts: np.ndarray, width: int, short: bool):
    """Hashes of ``width`` consecutive words of a row.

    With ``short``, a row with 1 to ``width - 1`` words gives one hash of all of
    them; otherwise none. Returns (hashes, first word of each, windows per row).
    """
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    full = np.maximum(counts - width + 1, 0)
    row = np.repeat(np.arange(len(counts)), full)
    begin = np.concatenate(([0], np.cumsum(full)))[:-1]
    at = first[row] + np.arange(len(row)) - begin[row]
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(width):
        out = (out + hashes[at + j]) * _U(_STEP)
    out = mix(out)
    if short and (few := np.flatnonzero((counts > 0) & (counts < width))).size:
        each = np.zeros(len(few), dtype=np.uint64)
        for j in range(width - 1):
            has = counts[few] > j
            each[has] = (each[has] + hashes[first[few[has]] + j]) * _U(_STEP)
        each = mix(each + _U(_ODD) * counts[few].astype(np.uint64))
        out, at, row = np.concatenate((out, each)), np.concatenate((at, first[few])), np.concatenate((row, few))
        order = np.argsort(row, kind="stable")
        out, at, row = out[order], at[order], row[order]
        full = np.bincount(row, minlength=len(counts))
    return out, at, full


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a per-byte (or per-word) array over the rows that ``offsets`` bound."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def int_lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """One list of 64-bit integers per row."""
    at = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.view(np.int64)))
