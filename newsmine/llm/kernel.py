"""Array helpers that run inside tasks: words, fingerprints and anchored windows.

All functions work on one block of texts at a time; a block holds at most
``BLOCK`` bytes unless one text alone is longer, so memory follows the block and
not the partition.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK = 256 * 1024
# Workers live long and are reused: large arrays go back to the system when freed,
# instead of staying in the worker's heap (-3 is glibc's M_MMAP_THRESHOLD).
pa.set_memory_pool(pa.system_memory_pool())
with contextlib.suppress(OSError, AttributeError):
    ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 20)
U = np.uint64
_BASE = int(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)
#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * U(_BASE))


@lru_cache(maxsize=4)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(size: int, base: int = _BASE) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; kept for the usual block size."""
    return _powers(1 << max(16, int(size - 1).bit_length()), base)[:size]


def blocks(batch: pa.RecordBatch, column: str = "text", size: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) pieces of a batch, of ``size`` bytes at most or one text; a null text counts as empty."""
    at = batch.schema.get_field_index(column)
    texts = batch.column(at).cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        piece = offsets[start : end + 1]
        yield batch.slice(start, end - start), data[piece[0] : piece[-1]], piece - piece[0]
        start = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word number of every text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    ink = ~SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = ink[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    starts = np.flatnonzero(ink & ~before)
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = ink[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(ink & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of every word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    inner = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))), axis=0) if starts[0] == 0 else None
    if inner is None:  # white space in front: treat it as a piece of its own
        cuts = np.concatenate([[0], starts, [len(data)]])
        inner = np.arange(len(data)) - np.repeat(cuts[:-1], np.diff(cuts))
    value = np.where(SPACE[data], U(0), _BYTES[data]) * powers(int(inner.max()) + 1)[inner]
    return mix(np.add.reduceat(value, starts) ^ (sizes.astype(np.uint64) << U(40)))


def prefix_sums(units: np.ndarray) -> np.ndarray:
    """Prefix sums from which the fingerprint of any run of units follows."""
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers(len(units)), out=out[1:])
    return out


def run_hashes(sums: np.ndarray, first: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Fingerprint of the ``size`` units that begin at ``first``."""
    inverse = powers(len(sums), _INVERSE)
    length = np.asarray(size, np.uint64)
    return mix((sums[first + size] - sums[first]) * inverse[first] ^ (length << U(44)))


def byte_units(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima from both sides of fixed cuts."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    square = padded.reshape(-1, width)
    left = np.minimum.accumulate(square, axis=1).ravel()
    right = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchored(units: np.ndarray, offsets: np.ndarray, window: int, part: int, allowed: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Deal the windows of every text to anchors.

    The anchor of a window is that run of ``part`` units inside it with the least
    fingerprint, the leftmost of equals. It depends on the window's content only,
    so equal windows have equal anchors at equal distance. One entry for each
    anchor: text number, position ``at``, ``first`` and ``last`` window start
    (positions in the text), ``anchor`` (fingerprint of the part) and ``around``
    (fingerprint of all units that its windows cover, and the anchor's place).
    ``allowed`` says which windows count, by their starts; an anchor has an entry for each run of them.
    """
    n = len(units)
    if n < window:
        none = np.zeros(0, np.int64)
        return {k: none for k in ("text", "at", "first", "last")} | {k: np.zeros(0, np.uint64) for k in ("anchor", "around")}
    sums = prefix_sums(units)
    grams = run_hashes(sums, np.arange(n - part + 1), part)
    order = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    least = (sliding_minimum(order, window - part + 1) & U(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    valid = np.arange(len(least)) + window <= offsets[1:][text]
    if allowed is not None:
        valid &= allowed[: len(valid)]
    starts = np.flatnonzero(valid)
    anchors, texts = least[starts], text[starts]
    breaks = (anchors[1:] != anchors[:-1]) | (texts[1:] != texts[:-1]) | (np.diff(starts) > 1)
    head = np.flatnonzero(np.concatenate([[True], breaks])) if len(starts) else starts
    tail = np.append(head[1:], len(starts)) - 1 if len(starts) else starts
    first, last, at, text = starts[head], starts[tail], anchors[head], texts[head]
    around = mix(run_hashes(sums, first, last - first + window) ^ (at - first).astype(np.uint64))
    base = offsets[:-1][text]
    return {"text": text, "at": at - base, "first": first - base, "last": last - base, "anchor": grams[at], "around": around}


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
