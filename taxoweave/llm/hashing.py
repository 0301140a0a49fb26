"""Word hashing over Arrow string columns with numpy.

A helper for tasks: the bytes of many texts are hashed at once, without a Python
object for each word.  A word is a maximal run of bytes that are not separators;
its 64-bit hash depends on its (ASCII lower-cased) bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; longer texts are cut between words and joined again.
CHUNK = 1 << 20
#: Bytes of short texts that are hashed together, so that the arrays stay in the cache.
TOGETHER = 1 << 17
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = _powers(_BASE, CHUNK + 1)
_UNPOW = _powers(_INVERSE, CHUNK + 1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_DIGIT = LOWER.astype(np.uint64) + np.uint64(1)
#: Separators of the words `[^\x20\x09-\x0D]+`.
WORD = np.ones(256, bool)
WORD[[9, 10, 11, 12, 13, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix (public domain), which spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow string array, or of a binary one without nulls; nulls have no bytes."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, kind)[
        texts.offset : texts.offset + len(texts) + 1
    ].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    return off, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def _hash_piece(data: np.ndarray, starts_of_texts: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of one piece, and where each word starts."""
    word = is_word[LOWER].take(data)
    edge = np.empty(len(word) + 1, bool)  # a word starts or ends before this byte
    edge[0], edge[-1] = word[0], word[-1]
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    edges = np.flatnonzero(edge)
    starts, ends = edges[::2], edges[1::2]
    inner = np.unique(starts_of_texts[starts_of_texts > 0])
    inner = inner[word[inner] & word[inner - 1]]  # no separator stands between two texts
    if len(inner):
        starts = np.insert(starts, np.searchsorted(starts, inner), inner)
        ends = np.insert(ends, np.searchsorted(ends, inner), inner)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    digits = _DIGIT.take(data)
    digits *= _POW[: len(data)]
    np.cumsum(digits, out=total[1:])
    return mix((total[ends] - total[starts]) * _UNPOW[starts] + (ends - starts).astype(np.uint64)), starts


def word_hashes(texts: pa.Array, is_word: np.ndarray = WORD) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, last row + 1, word hashes, offsets): the words of row
    first + i are hashes[offsets[i]:offsets[i + 1]].  Rows without words have none."""
    off, data = string_buffers(texts)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + min(CHUNK, TOGETHER), "right")) - 1)
        begin, end = int(off[lo]), int(off[hi])
        if end - begin <= CHUNK:
            if end == begin:
                yield lo, hi, np.zeros(0, np.uint64), np.zeros(hi - lo + 1, np.int64)
            else:
                inner = off[lo:hi] - begin
                hashes, starts = _hash_piece(data[begin:end], inner[inner < end - begin], is_word)
                yield lo, hi, hashes, np.searchsorted(starts, off[lo : hi + 1] - begin)
        else:  # one long text
            parts, at = [], begin
            while at < end:
                to = min(end, at + CHUNK)
                if to < end:
                    gaps = np.flatnonzero(~is_word[LOWER[data[at:to]]])
                    if len(gaps):
                        to = at + int(gaps[-1]) + 1
                    else:  # a word longer than a piece: its pieces' hashes are combined
                        parts.append(_long_word(data, at, end, is_word))
                        at = parts[-1][1]
                        parts[-1] = parts[-1][0]
                        continue
                parts.append(_hash_piece(data[at:to], np.zeros(1, np.int64), is_word)[0])
                at = to
            hashes = np.concatenate(parts)
            yield lo, hi, hashes, np.array([0, len(hashes)])
        lo = hi


def _long_word(data: np.ndarray, at: int, end: int, is_word: np.ndarray) -> tuple[np.ndarray, int]:
    total, start = np.uint64(0), at
    while at < end:
        to = min(end, at + CHUNK)
        piece = LOWER[data[at:to]]
        gaps = np.flatnonzero(~is_word[piece])
        if len(gaps):
            to = at + int(gaps[0])
            piece = piece[: gaps[0]]
        part = np.sum((piece.astype(np.uint64) + np.uint64(1)) * _POW[: len(piece)], dtype=np.uint64)
        total = mix(np.array([total + part + np.uint64(len(piece))], np.uint64))[0]
        at = to
        if len(gaps):
            break
    return np.array([total ^ np.uint64(at - start)], np.uint64), at


_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word shingles of one text; of the whole sequence if it has fewer words."""
    n = min(n, len(hashes))
    if n == 0:
        return hashes[:0]
    size = len(hashes) - n + 1
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out += hashes[k : k + size] * _FACTORS[k]
    return mix(out + np.uint64(n))


def shingle_sets(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted set of `shingles` of each of some texts, one after the other.

    The words of text i are hashes[offsets[i]:offsets[i + 1]]."""
    counts = np.diff(offsets)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.empty(at[-1], np.uint64)
    whole = counts >= n
    if whole.any():  # shingles at all places, of which those within one text are taken
        take = np.arange(int(sizes[whole].sum()))
        take += np.repeat(offsets[:-1][whole] - np.concatenate(([0], np.cumsum(sizes[whole])))[:-1], sizes[whole])
        inside = shingles(hashes, n)[take]
        if whole.all():
            flat = inside
        else:
            flat[np.repeat(whole, sizes)] = inside
    for i in np.flatnonzero(~whole & (counts > 0)).tolist():
        flat[at[i]] = shingles(hashes[offsets[i] : offsets[i + 1]], n)[0]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[at[:-1][sizes > 0]] = True
    return flat[new], np.concatenate(([0], np.cumsum(new)))[at]
