"""The n-gram join against all pairs on the words themselves."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from laketide.llm import ngram_join as N
from laketide.llm.words import exact_set, shingle_sets, words_of


def brute(rows, k=5, num=80, den=100):
    """(doc_id, set size, component) of rows (doc_id, text)."""
    sets = [exact_set(words_of(t), k) for _, t in rows]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for t in s:
            holders[t].add(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for t in s:
            for j in holders[t]:
                if j > i:
                    shared[j] += 1
        for j, both in shared.items():
            if den * both >= num * (len(s) + len(sets[j]) - both):
                parent[find(j)] = find(i)
    lowest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            lowest[r] = min(lowest.get(r, d), d)
    return sorted([(d, len(sets[i]), lowest.get(find(i))) for i, (d, _) in enumerate(rows)], key=repr)


def got(spark, rows, **kw):
    df = (spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("v", F.lit("x"))
          .withColumn("n_shingles", F.lit(1)).withColumn("body", F.lit(2)).repartition(3))
    return sorted([tuple(r) for r in N.ngram_join(df, **kw).select("doc_id", "n_shingles", "component_id").collect()], key=repr)


def near_copies(rnd, n, length=80, edits=6, words=400):
    base = [f"w{rnd.randrange(words)}" for _ in range(length)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randrange(edits)):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(9999)}"
        out.append(" ".join(own))
    return out


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\ttwo "), (6, "two one"), (7, "a b c d e"),
            (8, "A B\nC d E"), (9, "a b c d e f"), (10, long), (11, long + " end"), (11, long + " end"), (None, "a b c d e"),
            (None, "nothing like it is here at all"), (12, "one two"), (-3, "é é é é é é"), (13, "É é é é é é")]
    assert got(spark, rows) == brute(rows)


def test_words_of_equal_polynomials_stay_apart(spark):
    thue = [0]
    while len(thue) < 2048:
        thue += [1 - x for x in thue]
    a, b = ("".join("ab"[x] for x in thue), "".join("ba"[x] for x in thue))
    rows = [(1, a), (2, b), (3, f"{a} c d e f g h"), (4, f"{b} c d e f g h")]
    assert got(spark, rows) == brute(rows)


def test_empty(spark):
    assert got(spark, []) == []


@pytest.mark.parametrize("rare, common", [(32, 1024), (2, 6), (1, 1)])
def test_near_copies(spark, rare, common):
    """Frequent tokens of all classes; links near the threshold."""
    rnd = random.Random(rare)
    texts = []
    for _ in range(8):
        texts += near_copies(rnd, 40, rnd.choice([9, 20, 80, 300]), rnd.choice([2, 4, 9]))
    shared = near_copies(rnd, 1, 30)[0]
    texts += [f"{shared} {x}" for x in near_copies(rnd, 20, 4, 4)]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    assert got(spark, rows, classes=(rare, common)) == brute(rows)


def test_two_groups_apart(spark):
    """A large group in which many pairs are under the threshold."""
    rnd = random.Random(5)
    texts = near_copies(rnd, 400, 200, 9, 10_000)
    rows = list(enumerate(texts))
    assert got(spark, rows) == brute(rows)


def test_linked_sets_share_a_signature():
    rnd = np.random.default_rng(1)
    for _ in range(400):
        n = int(rnd.integers(1, 200))
        pool = np.unique(rnd.integers(0, 2 ** 63, 3 * n + 3).astype(np.uint64))
        df = {int(t): int(x) for t, x in zip(pool, rnd.integers(2, 9, len(pool)))}
        a = np.sort(rnd.choice(pool, n, replace=False))
        b = a.copy()
        for _ in range(int(rnd.integers(0, n // 8 + 1))):
            b[int(rnd.integers(0, n))] = rnd.choice(pool)
        b = np.unique(b)[int(rnd.integers(0, max(n // 20, 1))):]
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
            x, y = (N.signatures(s, np.array([df[int(t)] for t in s]), 80, 100, (2, 5)) for s in (a, b))
            assert len(np.intersect1d(x, y)), (n, len(b))


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(spark, rows) == brute(rows)


def test_sets():
    bodies = [words_of(t) for t in ("a b c", "a b c a b c", "", "x")]
    assert [len(s) for s in shingle_sets(bodies, 3)] == [len(exact_set(b, 3)) for b in bodies]


def test_no_row_for_a_pair_under_the_threshold(spark, monkeypatch):
    """A large group, most pairs of which are just under the threshold: sets
    that its first ones do not reach meet the others block by block."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for i in range(300):
        own = list(base)
        for j in rnd.sample(range(0, 100, 5), 3 if i % 3 else 1):
            own[j] = f"x{rnd.randrange(40)}"
        texts.append(" ".join(own))
    rows, made = list(enumerate(texts)), []
    written = N.written

    def counted(df, name):
        out = written(df, name)
        if name == "pairs":
            made.append(out.count())
        return out
    monkeypatch.setattr(N, "written", counted)
    for block in (512, 16):
        monkeypatch.setattr(N, "BLOCK", block, raising=False)
        made.clear()
        assert got(spark, rows) == brute(rows)
        assert len(made) <= 2 and sum(made) <= 2 * N.PIVOTS * len(rows), made


def test_shared_sizes():
    rnd = np.random.default_rng(3)
    base = np.unique(rnd.integers(0, 2 ** 63, 60).astype(np.uint64))
    sets = [np.unique(np.concatenate([base[rnd.random(len(base)) < 0.9], rnd.choice(base, 1), [np.uint64(i % 7)]])) for i in range(50)]
    sets += [sets[0], np.array([1, 2, 3], np.uint64)]
    shared = N.shared_sizes(sets)
    for i, s in enumerate(sets):
        assert shared(i).tolist() == [len(np.intersect1d(s, t)) for t in sets]
