"""Words of whole texts as 64-bit hashes, computed for many rows at once with numpy.

Texts come as Arrow string columns; their UTF-8 bytes are cut into words by a
byte table (every separator is ASCII, so multi-byte characters stay whole) and
each word gets the polynomial hash of its bytes, finished with a 64-bit mixer.
Long texts are worked through in blocks cut at separators, so memory stays
bounded by the block and the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes worked on at once: a block takes some 60 bytes of arrays for each, in every worker.
BLOCK = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
INV = pow(BASE, -1, 1 << 64)

#: Separators of `[^\x20\x09-\x0D]+`.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (the public splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd pseudo-random 64-bit multipliers made from ``seed``."""
    return mix(np.arange(1, n + 1, dtype=U) + U(seed * BASE % 2**64)) | U(1)


class Hasher:
    """Word hashing for one separator set; ``lower`` folds A-Z first."""

    def __init__(self, separators: bytes = SPACES, lower: bool = False):
        self.table = np.arange(256, dtype=np.uint8)
        if lower:
            self.table[ord("A"):ord("Z") + 1] += 32
        self.is_sep = np.zeros(256, dtype=bool)
        self.is_sep[list(separators)] = True
        self._powers(0)

    def _powers(self, n: int) -> None:
        with np.errstate(over="ignore"):
            self.pow = np.cumprod(np.full(max(n, 1), BASE, dtype=U))
            self.inv = np.cumprod(np.concatenate([np.ones(1, U), np.full(max(n, 1), INV, dtype=U)]))

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """Starts, ends and hashes of the words of the rows in ``data``.

        ``offsets`` (n rows + 1, from 0) bound the rows; a row start always
        starts a new word. Returns also each row's first word index (n + 1).
        """
        starts, ends, hashes, at = [], [], [], 0
        while at < len(data):
            stop = min(at + BLOCK, len(data))
            if stop < len(data):  # cut after a separator, or at a row start
                cut = np.flatnonzero(self.is_sep[self.table[data[at:stop]]])
                row = offsets[np.searchsorted(offsets, stop, "right") - 1]
                stop = max(at + int(cut[-1]) + 1 if len(cut) else at, int(row))
                if stop <= at:  # one word longer than the block
                    rest = np.flatnonzero(self.is_sep[self.table[data[at:]]])
                    stop = at + int(rest[0]) + 1 if len(rest) else len(data)
                    later = offsets[offsets > at]
                    stop = min(stop, int(later[0])) if len(later) else stop
            s, e, h = self._block(data[at:stop], offsets[(offsets >= at) & (offsets < stop)] - at)
            starts.append(s + at)
            ends.append(e + at)
            hashes.append(h)
            at = stop
        s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        h = np.concatenate(hashes) if hashes else np.zeros(0, U)
        return s, e, h, np.searchsorted(s, offsets)

    def _block(self, raw: np.ndarray, rows: np.ndarray):
        n = len(raw)
        if n > len(self.pow):
            self._powers(max(n, BLOCK))
        low = self.table[raw]
        word = np.zeros(n + 2, dtype=bool)
        word[1:-1] = ~self.is_sep[low]
        first = np.zeros(n + 1, dtype=bool)
        first[rows] = True
        s = np.flatnonzero(word[1:-1] & (~word[:-2] | first[:-1]))
        first = first[1:]
        first[-1:] = False
        e = np.flatnonzero(word[1:-1] & (~word[2:] | first)) + 1
        total = np.zeros(n + 1, dtype=U)
        np.cumsum((low.astype(U) + U(1)) * self.pow[:n], out=total[1:])
        h = (total[e] - total[s]) * self.inv[s]
        return s.astype(np.int64), e.astype(np.int64), mix(h + (e - s).astype(U) * U(0xD6E8FEB86659FD93))


def slices(texts: pa.Array, max_bytes: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``max_bytes`` (or one row), as bytes and offsets from 0.

    A null text counts as empty.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offs, data = texts.buffers()
    if not len(texts):
        return
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        stop = min(stop, len(texts))
        yield at, stop, raw[offsets[at]:offsets[stop]], offsets[at:stop + 1] - offsets[at]
        at = stop
    pa.default_memory_pool().release_unused()  # workers are reused: give a batch's memory back


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.astype(U).view(np.int64)
