"""Words of many texts at once: places and 64-bit hashes, computed on the bytes of an Arrow column.

All separators used here are ASCII, so words can be found in UTF-8 bytes. Work goes slice by slice
(cut between words), which bounds memory for texts of any length: only the arrays with one number
per word are as long as the text.
"""

import numpy as np

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


class Alphabet:
    """Which bytes belong to words, and the value of each byte in a hash (A-Z as a-z)."""

    def __init__(self, separators):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        folded = np.arange(256)
        folded[65:91] += 32
        values = np.random.default_rng(7).integers(1, 2 ** 63, 256, dtype=np.uint64)
        self.value = values[folded]


#: Words are runs of anything but space, tab, newline, vertical tab, form feed, carriage return.
SPACED = Alphabet([0x20, *range(0x09, 0x0E)])
#: Words are runs of digits, letters and anything beyond ASCII.
ALNUM = Alphabet([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
ALNUM.is_word[65:91] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n):
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers[0]) < n:
        n = max(n, SLICE + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2 ** 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def mixed(h):
    """Spread each bit of 64-bit numbers over all of them."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def words(data, offsets, alphabet, hashes=True):
    """Starts, ends and hashes of all words, and for each row the number of its first word."""
    starts, ends, out = [], [], []
    first, n = 0, len(data)
    while first < n:
        last = min(first + SLICE, n)
        if last < n:
            cuts = np.flatnonzero(~alphabet.is_word[data[first:last]])
            while not len(cuts) and last < n:  # a word longer than the slice
                step = last
                last = min(last + SLICE, n)
                cuts = np.flatnonzero(~alphabet.is_word[data[step:last]]) + (step - first)
            if last < n or len(cuts):
                last = first + int(cuts[-1]) + 1
        bounds = offsets[np.searchsorted(offsets, first):np.searchsorted(offsets, last, "right")]
        s, e, h = _slice(data[first:last], bounds - first, alphabet, hashes)
        starts.append(s + first)
        ends.append(e + first)
        out.append(h)
        first = last
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    out = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return starts, ends, out, np.searchsorted(starts, offsets)


def _slice(data, bounds, alphabet, hashes):
    inside = alphabet.is_word[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[bounds] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[bounds] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    if not hashes:
        return starts, ends, np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(alphabet.value[data] * up[:len(data)], out=sums[1:])
    return starts, ends, mixed((sums[ends] - sums[starts]) * down[starts])


def ngrams(h, n):
    """Hash of every n consecutive words (also those that run over the end of a row)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    factor = _BASE
    for k in range(n):
        total += h[k:len(h) - n + 1 + k] * np.uint64(factor)
        factor = factor * _BASE % 2 ** 64
    return mixed(total)


def count_words(data, offsets, alphabet):
    """Number of words of each row."""
    starts, _, _, first = words(data, offsets, alphabet, hashes=False)
    return np.diff(first)
