import hashlib

import pytest

import numpy as np

from laketide.llm import fingerprints as fp

WHITE = " \t\n\x0b\x0c\r"


def shingles(text, k=5):
    for c in WHITE:
        text = text.replace(c, " ")
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in text.split(" ") if x]
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, nxt = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out.append((doc_id, text, text[:len(text) - half] + nxt[:half], nxt))
    return out


def check(rows, got):
    want = expected(rows)
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    digests = sorted(((d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in want), key=key)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == digests
    by_id = {r.doc_id: r for r in got}
    errors = []
    for d, t, e, n in want:
        if [w[0] for w in want].count(d) == 1:
            errors += [abs(by_id[d].near_edited - jaccard(t, e)), abs(by_id[d].near_next - jaccard(t, n))]
    return errors


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    errors = check(rows, fp.compare_neighbours(docs).collect())
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.03


@pytest.mark.parametrize("rows", [
    [], [(1, "one two")], [(1, None), (2, ""), (3, " \n "), (None, "x y z"), (None, None)],
    [(5, "same text of six short words"), (5, "same text of six short words"), (4, "é" * 3000)]])
def test_edges(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "f") for r in rows], "doc_id bigint, text string, part int, fingerprint string")
    got = fp.compare_neighbours(docs).collect()
    assert len(got) == len(rows)
    if rows:
        check(rows, got)
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    texts = {}
    for r in fp.fingerprint(docs).collect():
        texts.setdefault(r.doc_id, set()).add(r.fingerprint)
    if rows and rows[0][0] == 5:
        assert len(texts[5]) == 1


def test_short_texts_do_not_agree_by_chance():
    """Texts of one shingle fill all bins with copies of one value."""
    texts = [f"word{i} other{i}" for i in range(400)]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    prints = fp.fingerprints(np.frombuffer(b"".join(data), np.uint8), offsets)
    full = np.zeros(len(texts) - 1, bool)
    assert fp.likeness(prints[1:], prints[:-1], full, full).max() < 0.1


def test_many_shuffle_partitions(spark):
    """Neither the plan nor its time grows with the number of ranges."""
    rows = [(i * 3 - 2000, f"t{i % 7} " * (i % 20)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        df = fp.compare_neighbours(docs)
        assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 20_000
        got = df.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(check(rows, got)) < 0.2
