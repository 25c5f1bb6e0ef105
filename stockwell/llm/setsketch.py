"""SetSketch registers of word-shingle sets (Ertl, 2021), in numpy.

Register i keeps ``floor(1 - log_b(min h_i))`` over the elements of a set, where the
h_i are independent exponential values: minima on an exponentially spaced
scale, cut to a fixed range. Registers of a union are the larger of both, so
sketches merge, and two registers are equal almost as often as the sets are
alike, so groups of them serve as hash bands.

An odd sketch (Mitzenmacher et al., 2014) goes with them: one bit for each class of
hashes, set where the set holds an odd number of them. Bits in which two
sets differ are never more than the elements in which they differ.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash

REGISTERS = 512
#: The scale's base and the rate and top of the register range.
BASE, RATE, TOP = 1.01, 20.0, 65_535
#: All bands of a pair at the threshold miss with at most this probability.
MISS = 1e-6
#: Words of 64 bits in an odd sketch.
ODD_WORDS = 8
#: Time after which a register is empty once in e^3 sets, and draws made at a time.
_SPARE, _DRAWS = 3.0, 1 << 14
#: A worker remembers the hashes of at most so many words.
CACHED_WORDS = 100_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    Words stand between ASCII white space, A-Z lower-cased. A text with fewer
    words than ``width`` is one shingle, one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    used = min(width, len(words))
    h = np.full(len(words) - used + 1, used, np.uint64)
    for i in range(used):
        h = _mixed(h * _STEP + values[i : len(words) - used + 1 + i])
    h.sort()
    fresh = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=fresh[1:])
    return h[fresh]


def registers(elements: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes, as unsigned 16-bit numbers.

    Each element draws points in time at the rate of all registers together, each
    point for a register of its own: a register's first point is then exponential and
    independent of the others'. Points are drawn in order and only up to a time by
    which nearly always every register has one, so a set of n elements costs n draws
    and some m log m more, not n times m.
    """
    end = (math.log(REGISTERS) + _SPARE) / len(elements)
    while True:
        first = _first_points(elements, end)
        if np.isfinite(first).all():
            break
        end *= 2
    levels = np.floor(1 - np.log(first / RATE) / math.log(BASE))
    return np.clip(levels, 0, TOP).astype(np.uint16)


def _first_points(elements: np.ndarray, end: float) -> np.ndarray:
    first = np.full(REGISTERS, np.inf)
    left, reached, drawn = elements, np.zeros(len(elements)), 0
    while len(left):
        expected = REGISTERS * max(0.0, end - float(reached.min()))
        steps = max(1, min(int(expected + 3 * math.sqrt(expected)) + 1, _DRAWS // len(left)))
        numbers = np.arange(drawn + 1, drawn + steps + 1, dtype=np.uint64)
        draws = _mixed(left[:, None] + _STEP * numbers[None, :])
        uniform = ((draws >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        times = reached[:, None] + np.cumsum(-np.log(uniform) / REGISTERS, axis=1)
        early = times <= end
        np.minimum.at(first, (draws[early] & np.uint64(REGISTERS - 1)).astype(np.int64), times[early])
        on = early[:, -1]
        left, reached, drawn = left[on], times[on, -1], drawn + steps
    return first


def band_rows(threshold: float) -> int:
    """The most registers a band may have so that all bands miss rarely enough at ``threshold``."""
    return max(r for r in range(1, 65) if r == 1 or (1 - threshold**r) ** (REGISTERS // r) <= MISS)


def bands(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key for each band of ``rows`` registers."""
    count = REGISTERS // rows
    own = sketch[: count * rows].reshape(count, rows).astype(np.uint64)
    h = np.arange(count, dtype=np.uint64)
    for i in range(rows):
        h = _mixed(h * _STEP + own[:, i])
    return h.view(np.int64)


def odd_sketch(elements: np.ndarray) -> np.ndarray:
    """The parities of the elements' hash classes, as signed 64-bit words."""
    classes = (elements >> np.uint64(20)).astype(np.int64) % (64 * ODD_WORDS)
    odd = np.bincount(classes, minlength=64 * ODD_WORDS) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch rows with known set sizes.

    With shares u and v of the summed sizes, a register of one set is the larger
    with probability p(u - vJ), the other's with p(v - uJ), where
    p(x) = -log_b(1 - x (b - 1) / b).
    """
    u = n_a / (n_a + n_b)
    v = 1 - u
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    grid = np.linspace(0, 1, 201)
    j = grid[None, :] * np.minimum(u / v, v / u)[:, None]

    def p(x):
        return np.clip(-np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE), 1e-12, 1)

    more, less = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    same = np.clip(1 - more - less, 1e-12, 1)
    fit = above[:, None] * np.log(more) + below[:, None] * np.log(less) + equal[:, None] * np.log(same)
    return j[np.arange(len(j)), fit.argmax(axis=1)]
