"""Word shingles as 64-bit numbers without structural collisions.

A word is a run of bytes other than the six white-space characters, after
A-Z are lower-cased.  Words are hashed by xxHash of their bytes, and a
shingle chains its words through a non-linear mix; equal numbers of different
shingles are as rare as among random numbers, whatever the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from laketide.llm.common import mixed

REMEMBERED = 150_000    # words a worker remembers; dropped when full


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        n = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = n
        return n


_known = _Words()


def hashed(words: list[bytes]) -> np.ndarray:
    """Hashes of words, in order."""
    if len(_known) > REMEMBERED:
        _known.clear()
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def forget() -> None:
    """Give up the remembered words, at the end of a task: a worker that waits
    for its next one holds none."""
    _known.clear()


def words_of(text: str | None) -> list[bytes]:
    """Words of a text; ``bytes.split`` parts at exactly the six characters."""
    return text.encode().lower().split() if text else []


def shingle_sets(bodies: list[list[bytes]], k: int) -> list[np.ndarray]:
    """Sorted distinct shingles (uint64) of every list of words.  Fewer than
    ``k`` words are one shingle, none have none."""
    if len(_known) > REMEMBERED:
        _known.clear()
    counts = np.array([len(b) for b in bodies], np.int64)
    hashes = np.fromiter((_known[w] for b in bodies for w in b), np.uint64, counts.sum())
    per_doc = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    ends = np.cumsum(per_doc)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return [np.zeros(0, np.uint64) for _ in bodies]
    begin = np.cumsum(counts) - counts
    at = np.repeat(begin - (ends - per_doc), per_doc) + np.arange(total)
    left = np.repeat(begin + counts, per_doc) - at
    out = np.zeros(total, np.uint64)
    for j in range(k):
        have = left > j
        if have.all():
            out = mixed(out + hashes[at + j])
        else:
            out[have] = mixed(out[have] + hashes[at[have] + j])
    out += np.minimum(left, k).astype(np.uint64)
    return [np.unique(out[e - n:e]) for e, n in zip(ends.tolist(), per_doc.tolist())]


def texts(column: pa.Array) -> list[list[bytes]]:
    return [words_of(t) for t in pc.fill_null(column, "").to_pylist()]


def exact_set(words: list[bytes], k: int) -> set:
    """Shingles as tuples of the words themselves."""
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*[words[j:] for j in range(k)]))
