"""Whole texts as numpy arrays: code points, words, word hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=None)
def _alnum() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=None)
def _alpha() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str | None) -> np.ndarray:
    """Lower-cased text as code points (uint32); empty for null."""
    return np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal true runs."""
    x = np.zeros(len(inside) + 2, bool)
    x[1:-1] = inside
    edge = np.flatnonzero(x[1:] != x[:-1])
    return edge[0::2], edge[1::2]


def word_runs(codes: np.ndarray, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Words: maximal runs of letters and digits, or of letters."""
    return runs((_alpha() if letters_only else _alnum()).take(codes, mode="clip"))


@lru_cache(maxsize=16)
def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a uint64 hash over all its bits."""
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=16)
def _inverse_powers(n: int) -> np.ndarray:
    out = np.full(n, pow(int(_BASE), -1, 1 << 64), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=16)
def _power_sums(n: int) -> np.ndarray:
    out = np.zeros(n + 1, np.uint64)
    np.cumsum(_powers(n), out=out[1:])
    return out


#: texts up to this length are hashed by one running sum
RUNNING = 1 << 18


def word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; equal words hash alike wherever they stand.

    A word's hash is the sum of its code points plus one times the powers of a base,
    counted from the word's start: a difference of running sums over the text,
    divided by the power that the word starts at (all modulo 2^64).
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    if len(codes) <= RUNNING:
        n = max(1024, 1 << (len(codes) - 1).bit_length())
        total, ones = np.zeros(len(codes) + 1, np.uint64), _power_sums(n)
        np.multiply(codes, _powers(n)[:len(codes)], out=total[1:])
        np.cumsum(total, out=total)
        h = (total[ends] - total[starts] + ones[ends] - ones[starts]) * _inverse_powers(n)[starts]
        return mixed(h + size.astype(np.uint64) * _MIX)
    at = np.arange(size.sum()) + np.repeat(starts - np.cumsum(size) + size, size)
    place = at - np.repeat(starts, size)
    most = int(size.max())
    power = _powers(64 if most <= 64 else 1 << (most - 1).bit_length())
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    term = (codes[at].astype(np.uint64) + np.uint64(1)) * power[place]
    return mixed(np.add.reduceat(term, first) + size.astype(np.uint64) * _MIX)


#: code points of texts that are hashed together
TOGETHER = 1 << 15


def hashes_of_words(texts: list[str | None]) -> list[np.ndarray]:
    """The :func:`word_hashes` of each text's :func:`word_runs`; short texts are taken together."""
    lowered, out = [(t or "").lower() for t in texts], []
    low = 0
    while low < len(lowered):
        high, held = low + 1, len(lowered[low])
        while high < len(lowered) and held + len(lowered[high]) < TOGETHER:
            held += len(lowered[high]) + 1
            high += 1
        group = lowered[low:high]
        joined = "\n".join(group)  # a line end is in no word
        try:
            raw = joined.encode("latin-1")
        except UnicodeEncodeError:
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            starts, ends = word_runs(codes)
        else:  # a byte for a code point, as most Western texts allow
            codes = np.frombuffer(raw, np.uint8)
            starts, ends = runs(np.frombuffer(raw.translate(_alnum()[:256].tobytes()), bool))
        cuts = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in group])).tolist()
        h = word_hashes(codes, starts, ends)
        out += [h[a:b] for a, b in zip([0, *cuts], cuts)]
        low = high
    return out
