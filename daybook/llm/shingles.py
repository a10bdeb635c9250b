"""Hashed shingle sets and min-hash values of a batch of texts, vectorised over the batch's bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    y = x >> np.uint64(30)
    y ^= x
    y *= _K[1]
    part = y >> np.uint64(27)
    y ^= part
    y *= _K[2]
    y ^= np.right_shift(y, np.uint64(31), out=part) if isinstance(part, np.ndarray) else y >> np.uint64(31)
    return y


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each text) of a string column without nulls."""
    if pa.types.is_large_string(column.type):
        offsets = np.frombuffer(column.buffers()[1], np.int64)
    else:
        offsets = np.frombuffer(column.buffers()[1], np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of each text's first word, one entry more than texts).  Words are
    runs of bytes other than blank and \\t to \\r; A to Z count as a to z."""
    word = ~_SPACE[raw]
    first = np.empty(len(raw), bool)
    if len(raw):
        first[0] = True
        np.logical_not(word[:-1], out=first[1:])
        first[offsets[:-1][offsets[:-1] < len(raw)]] = True
        first &= word
    starts = np.flatnonzero(first)
    counts = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    # Position of each byte in its word; blanks after a word weigh nothing.
    spans = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, spans)
    weight = np.full(int(spans.max()) + 1, _K[3])
    weight[0] = _K[0]
    weight = np.multiply.accumulate(weight)
    value = (_LOWER[raw[starts[0]:]].astype(np.uint64) + np.uint64(1)) * weight[place]
    value[~word[starts[0]:]] = 0
    return mix(np.add.reduceat(value, starts - starts[0])), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``n`` words, offsets per text).  A text of fewer words has one shingle,
    all its words; a text without words none."""
    sizes = np.diff(counts)
    number = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    offsets = np.append(0, np.cumsum(number))
    total = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for i in range(n):
        total = (total + words[i: i + len(total)]) * _K[(i + 1) % 4] ^ np.uint64(i + 1)
    full = sizes >= n
    at = np.repeat(counts[:-1] - offsets[:-1], number) + np.arange(offsets[-1])
    long_enough = np.repeat(full, number)
    out = np.zeros(offsets[-1], np.uint64)
    out[long_enough] = total[at[long_enough]]
    for t in np.flatnonzero((sizes > 0) & ~full):
        own = words[counts[t]: counts[t + 1]]
        places = np.arange(1, len(own) + 1, dtype=np.uint64)
        out[offsets[t]] = mix(own * _K[0] + places).sum(dtype=np.uint64)
    return mix(out), offsets


def byte_windows(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number (zeros beyond the end): a view."""
    padded = np.append(raw, np.zeros(8, np.uint8))
    return np.ndarray((len(raw),), "<u8", padded.data, 0, (1,))


def characters(raw: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """(a number for every UTF-8 character, its bytes; how many characters begin before each byte and
    the end, None if every byte is one).  ``lines`` always begin a character; in bytes that are not
    UTF-8, so does a continuation byte after three others."""
    follows = (raw & 0xC0) == 0x80
    if not follows.any():
        return raw, None
    fourth = follows[3:] & follows[2:-1] & follows[1:-2] & follows[:-3]
    begins = ~follows
    begins[3:] |= fourth
    begins[lines] = True
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(begins, out=before[1:])
    at = np.flatnonzero(begins)
    out = raw[at].astype(np.uint32)
    more = np.flatnonzero(~begins)  # few characters have several bytes
    more = more[begins[more - 1]]
    for k in range(1, 4):
        place = before[more + 1] - 1
        out[place] |= raw[more].astype(np.uint32) << np.uint32(8 * k)
        more = more[more + 1 < len(raw)] + 1
        more = more[~begins[more]]
    return out, before


def run_hashes(chars: np.ndarray, at: slice | np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the runs of ``n`` characters from each place ``at`` on; beyond the last
    character nothing is added."""
    if isinstance(at, slice):
        padded = np.zeros(at.stop - at.start + n - 1, np.uint64)
        part = chars[at.start: at.stop + n - 1]
        np.add(part, np.uint64(1), out=padded[:len(part)], dtype=np.uint64)
        size = at.stop - at.start
        taken = lambda k: padded[k: k + size]
    else:
        padded = chars if not len(at) or at.max() + n <= len(chars) else np.append(chars, np.zeros(n - 1, chars.dtype))
        taken = lambda k: padded[at + k].astype(np.uint64) + np.uint64(1)
    out = taken(n - 1).copy()
    for k in range(n - 2, -1, -1):
        out *= _K[0]
        out += taken(k)
    return out


def permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
    return a, rng.integers(0, 1 << 32, count, dtype=np.uint32)


def min_hashes(hashes: np.ndarray, offsets: np.ndarray, count: int, seed: int) -> np.ndarray:
    """``texts x count`` minima of ``a * x + b`` over 32 bits; texts without shingles get zeros."""
    full = np.flatnonzero(np.diff(offsets) > 0)
    out = np.zeros((len(offsets) - 1, count), np.uint32)
    if not len(full):
        return out
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    starts = offsets[:-1][full]
    for j, (a, b) in enumerate(zip(*permutations(count, seed))):
        out[full, j] = np.minimum.reduceat(x * a + b, starts)
    return out
