"""The Merkle manifest against one built by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from laketide.llm import merkle
from laketide.llm.queries import op12_merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    out = []
    for c in FIELDS:
        v = text if c == "text" else row[c]
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*out)


def tree(digests):
    """(root, for every leaf the runs above it as (siblings before, after))."""
    paths = [[] for _ in digests]
    owners = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, above_owners = [], []
        for i in range(0, len(digests), 3):
            run = digests[i:i + 3]
            for place in range(len(run)):
                for o in owners[i + place]:
                    paths[o].append((run[:place], run[place + 1:]))
            above.append(h(*run))
            above_owners.append([o for own in owners[i:i + 3] for o in own])
        digests, owners = above, above_owners
    return digests[0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in sources:
        own = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        subs[s] = (own, *tree([leaf(r, r["text"]) for r in own]))
    root, upper = tree([subs[s][1] for s in sources])
    out = []
    for s, above in zip(sources, upper):
        own, subroot, paths = subs[s]
        for r, path in zip(own, paths):
            full = path + above
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            d = leaf(r, text)
            for left, right in full:
                d = h(*left, d, *right)
            out.append((r["doc_id"], leaf(r, r["text"]), subroot, root,
                        h(*[x for left, right in full for x in left + right]), d, d == root))
    return sorted(out, key=repr)


def rows_of(spark, tmp_path, rows):
    spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA) \
        .withColumn("pos", F.lit("x")).withColumn("grp", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_merkle(spark, str(tmp_path))
    return sorted([tuple(r) for r in got.collect()], key=repr)


def docs(n, sources):
    texts = ["a\nb", "", None, "plain", "\n", "Zürich \U0001f600\nx" * 3]
    return [dict(doc_id=i, text=texts[i % len(texts)], lang=None if i % 5 == 0 else "de", source=sources[i % len(sources)],
                 n_chars=None if i % 7 == 0 else i) for i in range(n)]


@pytest.mark.parametrize("n, sources", [
    (1, ["a"]), (2, [None]), (3, ["a"]), (10, ["b", None, "", "é", "z", "Z"]), (100, ["one"]), (91, ["x", "x", "y"])])
def test_against_brute_force(spark, tmp_path, n, sources):
    rows = docs(n, sources)
    if n == 10:     # repeated rows, null ids, ties of ids
        rows += [rows[3], rows[3], dict(rows[4], doc_id=None), dict(rows[4], doc_id=None), dict(rows[5], doc_id=4, source="z")]
    assert rows_of(spark, tmp_path, rows) == expected(rows)


def test_long_text(spark, tmp_path):
    rows = [dict(doc_id=i, text="word\n" * 200_000 + str(i), lang="en", source="s", n_chars=1) for i in range(2)]
    assert rows_of(spark, tmp_path, rows) == expected(rows)


def test_empty(spark, tmp_path):
    assert rows_of(spark, tmp_path, []) == []


@pytest.mark.parametrize("levels", [1, 2])
def test_many_stages(spark, levels):
    """Trees that take many blocks and stages are the same trees."""
    rows = docs(200, ["a", "b", "b", "b", "b"])
    df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    got = merkle.manifest(df, levels=levels).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")).cast("binary"), 256).alias("p"),
        merkle.fold(F.col("leaf"), F.col("proof")).alias("folded"))
    want = [r[:5] for r in expected(rows)]
    out = got.collect()
    assert sorted([tuple(r)[:5] for r in out], key=repr) == want
    assert all(r["folded"] == r["root"] for r in out)


def test_sweep_proofs_lead_to_the_top():
    for n in range(1, 40):
        top, proofs = merkle.sweep([h(str(i)) for i in range(n)], merkle._levels(n))
        want, paths = tree([h(str(i)) for i in range(n)])
        assert top == want
        assert proofs == ["/".join("".join(a) + "." + "".join(b) for a, b in p) for p in paths]
