"""Windows of suffix dedup are compared byte by byte."""

import numpy as np
import pytest

from laketide.llm import suffix_dedup as S


def brute(data, start, depth):
    where = {}
    for i, a in enumerate(start.tolist()):
        where.setdefault(data[a:a + depth].tobytes(), []).append(i)
    return sorted(v for v in where.values() if len(v) > 1)


def grouped(at, group):
    found = {}
    for i, g in zip(at.tolist(), group.tolist()):
        found.setdefault(g, []).append(i)
    return sorted(sorted(v) for v in found.values())


@pytest.mark.parametrize("depth", [1, 5, 8, 9, 16, 50])
@pytest.mark.parametrize("digests", ["all equal", "few", "whole"])
def test_equal_windows(depth, digests):
    rng = np.random.default_rng(depth)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1500:2100] = data[100:700]             # a repeated passage
    data[2500:2600] = 97                        # one byte again and again
    start = np.arange(len(data) - depth + 1)
    whole = np.array([hash(data[a:a + depth].tobytes()) & (2 ** 63 - 1) for a in start], np.uint64)
    digest = {"all equal": whole * np.uint64(0), "few": whole % np.uint64(3), "whole": whole}[digests]
    assert grouped(*S._equal_windows(data, start, digest, depth)) == brute(data, start, depth)


def test_no_equal_windows():
    data = np.arange(200).astype(np.uint8)
    start = np.arange(151)
    for digest in (np.zeros(151, np.uint64), np.arange(151).astype(np.uint64)):
        at, group = S._equal_windows(data, start, digest, 50)
        assert not len(at) and not len(group)
    assert [len(x) for x in S._equal_windows(data, start[:0], start[:0].astype(np.uint64), 50)] == [0, 0]


def test_windows_with_one_hash_stay_apart(monkeypatch):
    """All windows of two documents get the same hash: only the shared
    passage goes."""
    monkeypatch.setattr(S, "mixed", lambda x: x * np.uint64(0))
    shared = bytes(range(65, 125))
    bodies = [b"first1" * 10 + shared, b"other2" * 10 + shared]
    runs = np.zeros(2, S._RUN)
    runs["n"] = [len(b) - 49 for b in bodies]
    size = np.array([len(b) for b in bodies])
    out, doc = S._repeated_in(np.arange(2), runs, np.arange(2), np.arange(2),
                              np.frombuffer(b"".join(bodies), np.uint8), np.cumsum(size) - size, size, 50)
    assert doc.tolist() == [1] * 11 and sorted(out["at"].tolist()) == list(range(60, 71))
