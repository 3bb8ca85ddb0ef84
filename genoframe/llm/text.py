"""Vectorised tokenising and hashing of Arrow string columns (numpy over the UTF-8 bytes, whole texts)."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Texts are taken together up to this many bytes; a longer text is taken alone, whole.
CHUNK_BYTES = 1 << 19

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
_STEP = U(0xD6E8FEB86659FD93)
#: Places of a word whose byte values come from a table; those of later places come from a formula.
_PLACES = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, (_PLACES, 256), dtype=np.uint64) * U(2) + U(1)


_VALUES = _values(20240117)


def _fold(keep: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[0x41:0x5B] = fold[0x61:0x7B]
    return keep, fold, np.ascontiguousarray(_VALUES[:, fold]).reshape(-1)


def keyed(kind: tuple[np.ndarray, np.ndarray, np.ndarray], seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``kind`` with hashes of its own: whoever does not know the seed cannot make unequal words collide."""
    keep, fold, _ = kind
    return keep, fold, np.ascontiguousarray(_values(seed)[:, fold]).reshape(-1)


def _set(*spans: tuple[int, int], inverse: bool) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in spans:
        out[lo : hi + 1] = True
    return ~out if inverse else out


_SPACES = ((0x20, 0x20), (0x09, 0x0D))
#: Words ``[^\x20\x09-\x0D]+`` as they are, and with A-Z lower-cased.
SPACED = _fold(_set(*_SPACES, inverse=True), lower=False)
SPACED_LOWER = _fold(_set(*_SPACES, inverse=True), lower=True)
#: Words of digits, ASCII letters (A-Z lower-cased first) and everything beyond ASCII.
ALNUM_LOWER = _fold(_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF), inverse=False), lower=True)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) over a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n), data[offsets[lo] : offsets[min(hi, n)]], offsets[lo : min(hi, n) + 1] - offsets[lo]
        lo = min(hi, n)


class Words:
    """The words of some texts: byte spans, 64-bit hashes, and the word offsets of each text.

    A word's hash mixes the sum of one random value for each (place, byte), and
    a run's hash is built from mixed hashes of halves, so no regular pattern of
    bytes or words makes unequal ones collide, as it would in polynomials
    modulo a power of two.  Who knows the random values can still look for
    collisions: hashes only choose what is compared; what decides is keyed
    (``keyed``), spelled, or a digest of the words themselves (``digests``).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: tuple[np.ndarray, np.ndarray, np.ndarray], hashes: bool = True):
        keep, fold, values = kind
        self._runs: dict[int, np.ndarray] = {}
        n_docs, size = len(offsets) - 1, len(data)
        self.data, self.n_docs = data, n_docs
        if not size:
            self.start = self.end = np.zeros(0, np.int64)
            self.hash = np.zeros(0, U)
            self.offset = np.zeros(n_docs + 1, np.int64)
            return
        inside = keep[data]
        edge = np.zeros(size + 1, bool)
        edge[offsets] = True
        before = np.empty(size, bool)
        before[0], before[1:] = False, inside[:-1]
        before &= ~edge[:-1]
        after = np.empty(size, bool)
        after[-1], after[:-1] = False, inside[1:]
        after &= ~edge[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.offset = np.searchsorted(self.start, offsets)
        if hashes:
            place = np.arange(size, dtype=np.int64)
            begin = np.concatenate([[0], self.start, [size]])
            place -= np.repeat(begin[:-1], np.diff(begin))
            value = values[np.minimum(place, _PLACES - 1) * 256 + data]
            if len(self.start) and (self.end - self.start).max() > _PLACES:
                far = np.flatnonzero(place >= _PLACES)
                value[far] = mix(mix((place[far].astype(U) << U(8)) | fold[data[far]]) + values[0])
            total = np.empty(size + 1, U)
            total[0] = 0
            np.cumsum(value, out=total[1:])
            self.hash = mix(mix(total[self.end] - total[self.start]) + (self.end - self.start).astype(U) * _ODD)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offset)

    def left(self) -> np.ndarray:
        """For each word, how many words of its text start at it or later."""
        return np.repeat(self.offset[1:], self.counts) - np.arange(len(self.hash))

    def _run(self, level: int) -> np.ndarray:
        """Hashes of the runs of 2**level words, by first word."""
        if level not in self._runs:
            if not level:
                self._runs[0] = self.hash
            else:
                half, step = self._run(level - 1), 1 << (level - 1)
                self._runs[level] = mix(half[: max(len(half) - step, 0)] * _STEP + half[step:])
        return self._runs[level]

    def span_hash(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of the word runs [start, start+length), length 1 or more: of two runs of 2**n words that cover each."""
        out = np.empty(len(start), U)
        if not len(start):
            return out
        length = np.asarray(length, np.int64)
        level = np.frexp(length)[1] - 1
        for n in np.unique(level).tolist():
            run = self._run(n)
            if not length.ndim:
                out = run[start] if length == 1 << n else mix(run[start] * _STEP + run[start + (length - (1 << n))])
            else:
                m = level == n
                head = start[m]
                out[m] = np.where(length[m] == 1 << n, run[head], mix(run[head] * _STEP + run[head + (length[m] - (1 << n))]))
        return mix(out + length.astype(U) * _ODD)

    def digests(self, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of BLAKE2b over the words of the runs [start, start+length) as they stand, one space between them."""
        if not hasattr(self, "_joined"):
            size = self.end - self.start + 1
            at = np.concatenate([[0], np.cumsum(size)])
            source = np.repeat(self.start - at[:-1], size) + np.arange(at[-1])
            joined = self.data[np.minimum(source, len(self.data) - 1)]
            joined[at[1:] - 1] = 0x20
            self._joined = memoryview(joined.tobytes()), at
        body, at = self._joined
        spans = zip(at[start].tolist(), (at[start + length] - 1).tolist(), strict=True)
        out = np.frombuffer(b"".join([blake2b(body[a:b], digest_size=16).digest() for a, b in spans]), U)
        return out[0::2].copy(), out[1::2].copy()

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Per text: the sorted distinct hashes of its runs of k words; of the whole sequence if it has fewer, but not none."""
    grams = words.span_hash(np.flatnonzero(words.left() >= k), k)
    counts = words.counts
    at = np.concatenate([[0], np.cumsum(np.maximum(counts - k + 1, 0))])
    out = []
    for d in range(words.n_docs):
        if counts[d] >= k:
            out.append(np.unique(grams[at[d] : at[d + 1]]))
        elif counts[d]:
            out.append(words.span_hash(words.offset[d : d + 1], counts[d : d + 1]))
        else:
            out.append(np.zeros(0, U))
    return out


def as_long(x: np.ndarray) -> np.ndarray:
    """uint64 bits as the int64 that Spark's long holds."""
    return np.ascontiguousarray(x).view(np.int64)


def release() -> None:
    """Hand free memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run):
    """``run``, an iterator function over Arrow batches, that gives free memory back when it ends: workers outlive a stage."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped
