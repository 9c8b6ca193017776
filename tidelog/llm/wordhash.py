"""Vectorised word, line and n-gram hashing over Arrow string columns.

Words are runs of bytes other than space and \\t..\\r. A word's hash is a polynomial in its bytes
modulo 2**64 with a fixed random value per byte, so it is the same on every machine and does not
depend on where the word stands. Texts are taken whole, in chunks of about CHUNK bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_U = np.uint64
_SPACES = [0x20, 9, 10, 11, 12, 13]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with good low and high bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


IS_SPACE = np.zeros(256, bool)
IS_SPACE[_SPACES] = True
EXACT = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
LOWER = EXACT.copy()
LOWER[ord("A") : ord("Z") + 1] = EXACT[ord("a") : ord("z") + 1]
#: Only letters count (bytes of other scripts as letters), A-Z lower-cased; the rest separates.
IS_BREAK = np.ones(256, bool)
IS_BREAK[ord("a") : ord("z") + 1] = IS_BREAK[ord("A") : ord("Z") + 1] = IS_BREAK[128:] = False
STEP = _U(0x9E6C63D0876A9A99)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(CHUNK * 2, n)
        with np.errstate(over="ignore"):
            back = _U(pow(int(STEP), -1, 1 << 64))
            for name, base in (("up", STEP), ("down", back)):
                x = np.full(size, base, dtype=np.uint64)
                x[0] = 1
                _powers[name] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def chunks(texts: pa.Array):
    """(first row, one past the last row, bytes, bounds) over whole rows; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], (offsets[i : j + 1] - offsets[i]).astype(np.int64)
        i = j


def spans(buf: np.ndarray, bounds: np.ndarray, space: np.ndarray = IS_SPACE):
    """Starts and ends of the words, and each row's first word (one more entry at the end)."""
    word = ~space[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = word[:-1]
    inside = bounds[:-1][bounds[:-1] < len(buf)]
    before[inside] = False
    after = np.zeros(len(buf), bool)
    after[:-1] = word[1:]
    ends = bounds[1:][bounds[1:] > 0] - 1
    after[ends] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = EXACT) -> np.ndarray:
    """Hash of each byte span, in blocks so that one long text needs little memory."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            lo = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, lo + 2 * CHUNK, side="right")))
            hi = int(ends[j - 1])
            up, down = _power(hi - lo + 1)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(values[buf[lo:hi]] * up[: hi - lo], out=total[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (total[e] - total[s]) * down[s]
            i = j
    return mix64(out)


_NGRAM = [_U(x) for x in (0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03, 0x4CF5AD432745937F, 0xDA942042E4DD58B5, 0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)]


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words (across rows too; the caller leaves those out)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:m] * _NGRAM[0]
        for k in range(1, n):
            out += words[k : k + m] * _NGRAM[k]
    return mix64(out)


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values between consecutive bounds."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
