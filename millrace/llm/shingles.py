"""Word shingles of texts as sets of 64-bit hashes, in blocks with NumPy.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case. The set of a text holds
its distinct runs of ``width`` words; a text with fewer words is one run, a text
without words has an empty set.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.common import UNSPACED, mix64

U = np.uint64
BLOCK_BYTES = 2_000_000
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_BASE = 0xB5297A4D3F84D5B5
_STEP = U(0x9FB21C651E98DF25)


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:  # powers double: the base to the number of those filled
        step = U(pow(_BASE, filled, 1 << 64))
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * step
        filled += more
    return out


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words of each text."""
    line = b" ".join(texts).translate(UNSPACED) + b" "
    data = np.frombuffer(line, np.uint8)
    inside = data != 0x20
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    lens = ends - starts
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    per_text = np.diff(np.searchsorted(starts, ends_of_texts), prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), per_text
    first = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum())) - np.repeat(first, lens)
    parts = _BYTES[data[inside]] * _powers(int(lens.max()))[place]
    return mix64(np.add.reduceat(parts, first) + lens.astype(np.uint64) * _STEP), per_text


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes.sort()
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])] if len(hashes) else hashes


def shingle_sets(texts: list[bytes | None], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    texts = [t or b"" for t in texts]
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_BYTES):
            size += len(texts[end])
            end += 1
        words, per_text = _words(texts[at:end])
        runs = words[: max(len(words) - width + 1, 0)].copy()
        for i in range(1, width):
            runs = runs * _STEP + words[i : len(runs) + i]
        runs = mix64(runs)
        lo = 0
        for n in per_text.tolist():
            if n >= width:
                out.append(_distinct(runs[lo : lo + n - width + 1].copy()))
            elif n:
                whole = words[lo : lo + 1].copy()
                for i in range(1, n):
                    whole = whole * _STEP + words[lo + i : lo + i + 1]
                out.append(mix64(whole + U(n)))
            else:
                out.append(np.zeros(0, np.uint64))
            lo += n
        at = end
    return out


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Fast similarity sketches: one row of ``size`` coordinates per set; zeros for empty sets.

    In the first ``size`` rounds each element goes to a hashed bin with a hashed value;
    a bin keeps the least (round, value). The next ``size`` rounds put all elements into
    one bin each, so that every bin is filled for sure. Rounds after a set's bins are
    all filled can't change it and are skipped: large sets need one or two.
    """
    n = len(sets)
    out = np.zeros((n, size), np.uint64)
    lens = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), lens)
    elements = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    filled = np.zeros((n, size), bool)
    for turn in range(2 * size):
        open_sets = ~filled.all(axis=1) & (lens > 0)
        if not open_sets.any():
            break
        if turn < 2 or turn % 16 == 0:  # leave out finished sets
            mine = open_sets[owner]
            owner, elements = owner[mine], elements[mine]
        drawn = mix64(elements ^ mix64(np.full(1, turn + 1, np.uint64) * _STEP))
        bins = (drawn % U(size)).astype(np.int64) if turn < size else np.full(len(drawn), turn - size)
        cell = owner * size + bins
        best = np.full(n * size, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(best, cell, mix64(drawn))
        best = best.reshape(n, size)
        touched = np.zeros(n * size, bool)
        touched[cell] = True
        fresh = touched.reshape(n, size) & ~filled
        out[fresh] = mix64(best[fresh] + U(turn))
        filled |= fresh
    return out


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct sets that aren't empty."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)
