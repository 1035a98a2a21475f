"""Words of whole texts and rolling hashes over them, for Arrow batches.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``
(``[^\\x20\\x09-\\x0D]+``; the separators are ASCII, so they never fall inside
a UTF-8 character). Words are hashed to 64 bits with XXH3, one by one (in
``slice_hashes`` those of 16 bytes and less by columns); short word sequences
are hashed from the word hashes with numpy. (Sums of powers modulo 2^64 over
whole words or long sequences are not used: sequences of two symbols in
Thue-Morse order, and the same with the symbols exchanged, meet there for any
base from 1,024 symbols on.) Memory per text: about two bytes per byte and 24
bytes per word; ``slice_hashes`` about 5 bytes per byte and 80 per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
#: Words that are held as objects at a time.
HELD = 1 << 16

_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_Q = 0xD6E8FEB86659FD93
#: Masks of the first 0 to 8 bytes.
_UPTO = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all input bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text as a view of the batch's buffer; null: no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(n):
        yield raw[at[i]:at[i + 1]] if valid[i] else raw[:0]


def slices(texts: pa.Array, most_bytes: int, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring texts ``(start, end)``, ``most`` of them at most, that end once they hold that many bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        upto = min(start + most, int(np.searchsorted(ends, before + most_bytes)) + 1, len(ends))
        yield start, upto
        start = upto


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    if not raw.size:
        none = np.zeros(0, np.int64)
        return none, none
    inside = np.zeros(raw.size + 2, np.int8)
    np.logical_not(_SEP[raw], out=inside[1:-1].view(bool))
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The XXH3 hash of each word: equal words, equal hashes, wherever they stand."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), HELD):
        j = min(i + HELD, len(starts))
        words = raw[starts[i]:ends[j - 1]].tobytes().split()     # bytes are split at the same six separators
        out[i:j] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, j - i)
    return out


def packed_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word by whole columns: words of 16 bytes and less are
    mixed from their bytes as two numbers and their size (of one size up to 8
    bytes, different words have different hashes), longer ones have their XXH3 hash."""
    size = ends - starts
    padded = np.concatenate((raw, np.zeros(16, np.uint8)))
    eight = np.ndarray((len(raw) + 9,), "<u8", padded, strides=(1,))     # the 8 bytes from each byte on
    low = eight[starts] & _UPTO[np.minimum(size, 8)]
    high = eight[starts + 8] & _UPTO[np.clip(size - 8, 0, 8)]
    out = mix(low + mix(high + size.astype(U64) * U64(_Q)))
    for k in np.flatnonzero(size > 16).tolist():
        out[k] = xxhash.xxh3_64_intdigest(raw[starts[k]:ends[k]])
    return out


def slice_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The :func:`packed_hashes` of all words of several texts, one text after
    the other, and at which of them each text begins (and the last ends)."""
    texts = list(text_bytes(column))
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    starts, ends = word_spans(raw)
    return packed_hashes(raw, starts, ends), np.searchsorted(starts, np.cumsum([0, *(t.size + 1 for t in texts)]))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` words (none if there are fewer); for some dozen words at most."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    power, size, off, rest, run = _Q, 1, 0, k, h
    while rest:
        if rest & 1:
            out += run[off:off + n] * U64(pow(_Q, off, 1 << 64))
            off += size
        rest >>= 1
        if rest:
            run = run[:-size] + run[size:] * U64(power)
            power = power * power % (1 << 64)
            size *= 2
    return mix(out + U64(k))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum over each run of ``w`` values."""
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = w - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def shingles(raw: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of a text, A-Z taken
    as a-z; with fewer words the whole sequence is the one shingle, without
    words there is none."""
    raw = lower_ascii(raw)
    starts, ends = word_spans(raw)
    h = word_hashes(raw, starts, ends)
    if not len(h):
        return h
    return np.unique(windows(h, min(k, len(h))))
