"""Word and shingle hashes of many texts at once, with numpy inside a task."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_P, _Q = _U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """texts: UTF-8. Hash of every word (what stands between blanks, A-Z lower-cased) of all texts in a row, and the
    number of words of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    inside = ~_BLANK[raw]
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & ~before)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    counts = np.diff(np.searchsorted(starts, begin))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    ends = np.flatnonzero(~inside & before)
    lengths = ends - starts
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()) + 1, _P))
        at = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw)))) if starts[0] == 0 else None
        if at is None:
            at = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
            raw, inside = raw[starts[0] :], inside[starts[0] :]
        value = np.where(inside, _BYTE[raw] * powers[np.minimum(at, len(powers) - 1)], _U(0))
        return mix(np.add.reduceat(value, starts - starts[0]) + lengths.astype(np.uint64)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every run of n words, within texts; a text of fewer words has one shingle, all of them."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    owner = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(first + counts, counts) - np.arange(len(words))  # words from here to the end of the text
    whole = (left >= n) | (np.arange(len(words)) == np.repeat(first, counts))
    with np.errstate(over="ignore"):
        total, power = np.zeros(len(words), np.uint64), _Q
        for k in range(min(n, len(words))):
            part = words[k:] * power
            total[: len(words) - k] += np.where(left[: len(words) - k] > k, part, _U(0))
            power = power * _Q
        total = mix(total + np.minimum(left, n).astype(np.uint64))
    return owner[whole], total[whole]


def bags(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Multisets, ordered by text and hash: (text, hash, weight), and for every occurrence its number among equals."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(owner)))
    return owner[at], hashes[at], weight, np.arange(len(owner)) - np.repeat(at, weight)
