"""Word shingles of many texts at once, as 64-bit hashes.

Words are hashed by xxHash of their bytes (see ``words``), so no two words are
equal by structure; a shingle is a sum of its words' hashes, each times an odd
constant, which is as good as random for different runs of words.

A word is a run of bytes other than the six white-space characters, after
A-Z are lower-cased.  A text's shingles are all runs of ``k`` words; a text
with fewer words has its whole sequence as its one shingle; a text without
words has none.
"""

from __future__ import annotations

import numpy as np

from laketide.llm.common import WHITE_BYTES, mixed, odd_constants
from laketide.llm.words import hashed

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[list(WHITE_BYTES)] = True
STRETCH = 4 << 20     # bytes of a text whose words are held as objects at a time

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        def table(base: int) -> np.ndarray:
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)
        _powers, _inverse = table(_BASE), table(pow(_BASE, -1, 1 << 64))
    return _powers[:n], _inverse[:n]


def _stretches(data: np.ndarray, start: int, end: int):
    """Cut a long text behind white space (a word longer than a stretch stays
    whole)."""
    size = STRETCH
    while end - start > size:
        white = np.flatnonzero(_SPACE[data[start:start + size]])
        if not len(white):
            size *= 2
            continue
        cut = start + int(white[-1]) + 1
        yield start, cut
        start, size = cut, STRETCH
    yield start, end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every text)."""
    out, counts = [], np.zeros(len(offsets) - 1, np.int64)
    few, held = [], 0       # words of small texts, hashed together
    ends = offsets.tolist()
    for i, (start, end) in enumerate(zip(ends, ends[1:])):
        for a, b in _stretches(data, start, end):
            words = data[a:b].tobytes().lower().split()
            counts[i] += len(words)
            few.extend(words)
            held += b - a
            if held >= STRETCH:
                out.append(hashed(few))
                few, held = [], 0
    out.append(hashed(few))
    return np.concatenate(out), counts


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of all texts in order, with repeats; end of each
    text's part, starting with 0)."""
    words, counts = word_hashes(data, offsets)
    weights = odd_constants(k, k)
    n_docs = len(counts)
    begin = np.concatenate([[0], np.cumsum(counts)])
    per_doc = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(per_doc)])
    if not ends[-1]:
        return np.zeros(0, np.uint64), ends
    owner = np.repeat(np.arange(n_docs), per_doc)
    at = begin[owner] + np.arange(ends[-1]) - ends[owner]
    left = begin[owner + 1] - at
    out = np.zeros(ends[-1], np.uint64)
    for j in range(k):
        have = left > j
        if have.all():
            out += words[at + j] * weights[j]
        else:
            out[have] += words[at[have] + j] * weights[j]
    short = left < k
    out[short] += left[short].astype(np.uint64)
    return mixed(out), ends
