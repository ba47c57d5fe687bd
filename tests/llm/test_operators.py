"""Operators against brute force, and on awkward rows: nulls, empty and long
texts, repeated rows, ties, empty tables, columns with clashing names."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from laketide.llm import bpe, chat, exact_dedup, line_dedup, mixing, near_dedup, pii, quality, suffix_dedup
from laketide.llm.common import utf8
from laketide.llm.shingles import shingle_hashes

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "score double, n_lines string, key string, n int")
LONG = "lorem ipsum dolor " * 4000 + "0" * 3000
ROWS = [(1, "a b\tc\nd e f g"), (2, None), (3, ""), (4, LONG), (5, LONG + " end"), (6, "A  b c d e f\ng"),
        (6, "A  b c d e f\ng"), (None, "a b c d e f g"), (None, None), (8, " \n \n"), (9, "x" * 49), (10, "x" * 60),
        (11, "é" * 70 + "<a@b.co> 4111 1111 1111 1111 +49 30 1234567 300.1.1.1 10.0.0.1")]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", None if d == 2 else "s", 0, 0.0, "x", "k", 1) for d, t in rows], SCHEMA)


@pytest.fixture(params=["awkward", "empty"])
def rows(request):
    return ROWS if request.param == "awkward" else []


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_dedup(spark, rows, bits):
    got = exact_dedup.exact_dedup(frame(spark, rows), id_bits=bits).collect()
    norm = [(d, t or "", re.sub("[\x20\x09-\x0d]", "", t or "")) for d, t in rows]
    groups = {}
    for d, t, n in norm:
        groups.setdefault(n, []).append((-len(t), d is None, d or 0))
    want = []
    for d, t, n in norm:
        k = min(groups[n])
        keep = None if k[1] else k[2]
        want.append((d, keep, len(groups[n]), d == keep, sha(n)))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x) // 10 + (2 * x) % 10 for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base_spans(text):
    out = []
    for kind, p in BASE.items():
        for m in p.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii(spark, sf, rows):
    texts = [t for _, t in rows] + [
        "a@b.c_d@e.f x@y 1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 007.0.0.1", "4111-1111-1111-1111 4111111111111112 1 2 3 4",
        "+1 (23) 456-7890. ++123 +1 2", "a" * 20000 + "@x", "1" * 20000, "😀 a@b.cc 😀 10.1.1.1",
        " ".join(f"u{i}@h.io" for i in range(300))]
    if rows:
        texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame([(i, t, "p") for i, t in enumerate(texts)], "doc_id long, text string, pii string")
    base = F.filter("pii", lambda s: s["kind"] != "iban")
    for r in pii.find_pii(docs).select("text", pii.joined_spans(base).alias("s")).collect():
        assert r.s == base_spans(r.text or ""), (r.text or "")[:80]
    iban = spark.createDataFrame([("my iban DE89 3704 0044 0532 0130 00 ok",), ("DE88370400440532013000",)], "text string")
    got = [[(s.kind, s.start, s.end, s.score) for s in r.pii if s.kind == "iban"] for r in pii.find_pii(iban).collect()]
    assert got == [[("iban", 8, 35, 1.0)], []]


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", None), (1, 2, "assistant", "\\### <and></turn>\n\\b:"),
            (1, 2, "assistant", "a"), (None, 0, None, "x"), (2, None, "a:b\n#", "late"), (2, 5, "assistant", ""),
            (3, 0, "assistant", "é" * 5000), (1, 3, "user", "bye"), (1, 3, "user", "bye")]
    for part in (rows, []):
        t = spark.createDataFrame([(*r, 7) for r in part],
                                  "conv_id bigint, turn bigint, role string, text string, formatted int")
        done = chat.format_chats(t).select("conv_id", chat.read_back(F.col("formatted")).alias("turns"),
                                           chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
        want = {}
        for c, n, role, text in sorted(part, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
            want.setdefault(c, []).append((role or "", text or ""))
        assert {r.conv_id: [tuple(x) for x in r.turns] for r in done.collect()} == want
        assert {r.conv_id: r.loss for r in done.collect()} == {
            c: "".join(x for role, x in v if role == "assistant") for c, v in want.items()}


def test_suffix_dedup(spark, rows):
    rows = rows + [(20, "q" * 10 + "0123456789" * 9), (21, "0123456789" * 7 + "tail")] * bool(rows)
    got = suffix_dedup.remove_repeats(frame(spark, rows), depth=50, buckets=3).collect()
    want = []
    for d, t in rows:
        b = (t or "").encode()
        small = set()
        for e, u in rows:
            if d is not None and e is not None and e < d:
                o = (u or "").encode()
                small |= {o[i:i + 50] for i in range(len(o) - 49)}
        cover = bytearray(len(b))
        for i in range(len(b) - 49):
            if b[i:i + 50] in small:
                cover[i:i + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(cover)))
        want.append((d, len(b), sum(cover), spans, sha(bytes(x for x, c in zip(b, cover) if not c))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_quality(spark, rows):
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(1, 1), (4, 0), (11, 1), (None, 0), (5, None), (99, 1)], "doc_id bigint, quality int")
    model = quality.learn(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = quality.score(docs, quality.learn(docs, labels.limit(0)))
    assert all(r.score == 0.5 for r in none.collect())


def test_quality_reads_whole_texts_and_empty_ones():
    import numpy as np
    from laketide.llm.common import utf8
    import pyarrow as pa
    distinct = " ".join(f"w{i}" for i in range(3000))
    tail = distinct + " same" * 3000
    f = quality.features(*utf8(pa.array([distinct, tail, "", None])))
    assert f[0, -3] == 0 and f[1, -3] > 0.5        # repeats behind the first 2,000 words count
    assert not f[2:].any()
    model = quality.Model(np.concatenate([f[:2], f[2:3]]), np.array([1, 0, 0]), dims=2, k=1)
    assert model.score(f).tolist() == [1.0, 0.0, 0.0, 0.0]


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = quality.score(docs, quality.learn(docs, labels)).join(labels, "doc_id").where(quality.held_out(F.col("doc_id")))
    right = [(r.score >= 0.5) == (r.quality == 1) for r in scored.collect()]
    assert sum(right) / len(right) > 0.95


def test_mixing(spark, rows):
    docs = frame(spark, rows)
    got = mixing.copies(docs).collect()
    assert len(got) == len(rows)
    mixed = mixing.mix(docs, mixing.Target(entropy=1.0, cover=True, max_epochs=2.0))
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.collect()} == {d for d, _ in rows}


def test_mixing_meets_the_weights(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.copies(docs, mixing.Target(entropy=0.7, max_epochs=3.0)).collect()
    total = sum(r.n_tokens for r in got)
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        quota = own[0].source_weight * total
        realised = sum(r.n_tokens * r.copies for r in own)
        assert quota - max(r.n_tokens for r in own) - 1 <= realised <= quota + 1
        assert max(r.copies for r in own) <= 4


@pytest.mark.parametrize("shift", [32, 50])
def test_mixing_takes_documents_up_to_the_budget(spark, monkeypatch, shift):
    monkeypatch.setattr(mixing, "PART_SHIFT", shift)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    # keys of 52 bits: one block, so that the budget ends among many documents
    slim = docs.select(F.lit("s").alias("source"), mixing.token_count(F.col("text")).alias("n_tokens"),
                       F.shiftright(mixing.block_key(F.col("doc_id")), 8).alias("key"))
    rows = sorted((r.key, r.n_tokens) for r in slim.collect())
    total = sum(n for _, n in rows)
    for budget in (1, total // 3, total - 1):
        plan = mixing._plan(slim.withColumn("block", mixing.block_of(F.col("key"))),
                            mixing.Target(budget=budget, max_epochs=9.0)).first()
        through, fit = 0, []
        for key, n in rows:
            through += n
            if through <= budget:
                fit.append(key)
        assert plan.epochs == 0
        assert [k for k, _ in rows if k <= plan.edge_key] == fit


def test_bpe(spark, rows):
    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = rows + [(30, "it's we'll 'sfoo ''s ' s　\x85 \t\n x1٣ \U0001f600" + "ab" * 3000)] * bool(rows)
    docs = frame(spark, rows)
    ids = bpe.encode(docs, path, public_tokenizers.PATTERN)
    got = sorted(((r.doc_id, bytes(r.ids)) for r in ids.collect()), key=str)
    want = sorted(((d, b"".join(i.to_bytes(4, "little") for i in other.encode_ordinary(t or ""))) for d, t in rows), key=str)
    assert got == want
    back = bpe.decode(ids, path, public_tokenizers.PATTERN).collect()
    assert sorted(((r.doc_id, bytes(r.bytes).decode()) for r in back), key=str) == sorted(
        ((d, t or "") for d, t in rows), key=str)


def components(rows, k, num):
    sets = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= num * len(a | sets[j]):
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        c = min(ids, default=None)
        out.append((d, len(sets[i]), c, d == c))
    return out


def test_near_dedup(spark, rows, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    rows = rows + [(100 + i, " ".join([*words[:i], "new", *words[i + 1:]])) for i in range(0, 60, 3)] * bool(rows)
    for small in (2048, 4):             # 4: nodes count as large and branch on
        monkeypatch.setattr(near_dedup, "SMALL", small)
        got = near_dedup.near_dedup(frame(spark, rows), words=3, similarity=(85, 100)).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == sorted(
            components(rows, 3, 85), key=str)


def near_copies(n, seed, words, most):
    """Variants of one text in two families; similarities spread around the
    threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    other = [("o" + w if rng.random() < 0.02 else w) for w in base]
    rows = []
    for i in range(n):
        text = list(base if i % 2 else other)
        for j in rng.sample(range(words), rng.randint(1, most)):
            text[j] = f"x{i}_{j}"
        rows.append((i, " ".join(text)))
    return rows


def test_near_dedup_refused_partners(spark, monkeypatch):
    """A vertex whose link with a large node's first vertex fails goes on."""
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    asked, compare = [], near_dedup._confirmed

    def refuse(clusters, *args):
        asked.append({frozenset(map(bytes, r.vs)) for r in clusters.collect()})
        return compare(clusters, *args).where(F.lit(len(asked) > 1))
    monkeypatch.setattr(near_dedup, "_confirmed", refuse)
    near_dedup.near_dedup(frame(spark, near_copies(20, 3, 150, 1)), words=3, similarity=(85, 100)).collect()
    assert len(asked) > 1
    assert {max(pair) for pair in asked[0]} <= set().union(*(c for later in asked[1:] for c in later))


@pytest.mark.parametrize("small", [8, 64])
def test_near_dedup_large_nodes(spark, monkeypatch, small):
    rows = near_copies(400, 1, 150, 7)
    want = components(rows, 3, 85)
    monkeypatch.setattr(near_dedup, "SMALL", small)
    got = near_dedup.near_dedup(frame(spark, rows), words=3, similarity=(85, 100)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(want)


def test_near_dedup_jobs_on_the_driver(spark, monkeypatch):
    """No written table is broadcast by the size of its files, and no job
    grows with the depths that large nodes go through."""
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    plans, write = {}, near_dedup.written

    def planned(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)
    monkeypatch.setattr(near_dedup, "written", planned)
    near_dedup.near_dedup(frame(spark, near_copies(60, 1, 150, 7)), words=3, similarity=(85, 100)).collect()
    assert len(plans["nodes"]) > 2
    for name in ("nodes", "met_first", "clusters", "confirmed", "children"):
        for plan in plans[name]:
            assert "BroadcastHashJoin" not in plan, name
            assert plan.count("MapInArrow") <= 1, name


def test_near_dedup_large_clusters(spark, monkeypatch):
    """A cluster of many shingles has the links of a small one."""
    monkeypatch.setattr(near_dedup, "TOKENS", 2000)
    rows = near_copies(400, 10, 150, 8)
    hashes, ends = shingle_hashes(*utf8(pa.array([t for _, t in rows])), 3)
    sets = sorted((np.unique(hashes[x:y]) for x, y in zip(ends, ends[1:])), key=lambda x: x.tobytes())
    vs = [i.to_bytes(2, "big") for i in range(len(sets))]
    marks = [near_dedup.sketch(x).astype(np.uint8).tobytes() for x in sets]
    group = spark.createDataFrame([(vs, marks, [len(x) for x in sets])],
                                  "vs array<binary>, marks array<binary>, sizes array<bigint>")
    full = spark.createDataFrame([(v, x.tobytes()) for v, x in zip(vs, sets)], "v binary, tokens binary")
    links = near_dedup._confirmed(near_dedup._compare_groups(group, 0.85), full, 85, 100).collect()
    root = {v: v for v in vs}
    for r in links:
        x, y = root[bytes(r.a)], root[bytes(r.b)]
        root = {v: y if z == x else z for v, z in root.items()}
    assert len(set(root.values())) == len({r[2] for r in components(rows, 3, 85)})


@pytest.mark.parametrize("similarity, missed", [(0.85, 1e-6), (0.8, 2e-5)])
def test_near_dedup_recall(similarity, missed):
    """Chance that a pair at the threshold shares none of the first nodes."""
    q = 1.0
    for _ in range(near_dedup.FIRST_DEPTH):
        q = 1 - (1 - similarity * q) ** near_dedup.BRANCHES
    assert (1 - q) ** near_dedup.TREES < missed


@pytest.mark.parametrize("keep_first", [False, True])
def test_line_dedup(spark, rows, keep_first):
    rows = rows + [(200 + i, f" Same Line \nown {i}\n\nsame line\t") for i in range(12)] * bool(rows)
    docs = frame(spark, rows)
    drops = line_dedup.line_drops(docs, min_docs=10, keep_first=keep_first)
    got = line_dedup.drop_lines(docs, drops)
    assert set(docs.columns) <= set(got.columns)
    lines = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            lines.setdefault(line.strip(" \t\n\x0b\x0c\r").lower(), set()).add(r)
    seen, want = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        kept = []
        for line in (t or "").split("\n"):
            k = line.strip(" \t\n\x0b\x0c\r").lower()
            if k and len(lines[k]) >= 10 and (not keep_first or k in seen):
                continue
            if k and len(lines[k]) >= 10:
                seen.add(k)
            kept.append(line)
        n = (t or "").count("\n") + 1
        want.append((d, n, n - len(kept), "\n".join(kept)))
    assert sorted(((r.doc_id, int(r.n_lines), r.n_dropped, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


def test_components_follow_a_link_once(spark, monkeypatch):
    """A link that many clusters give, in either direction, is one link."""
    rows = {}

    def counted(df, name):
        out = written(df, name)
        rows[name] = out.count()
        return out
    written = near_dedup.written
    monkeypatch.setattr(near_dedup, "written", counted)
    path = [(bytes([i]), bytes([i + 1])) for i in range(9)] + [(bytes([20]), bytes([21]))]
    links = [x for a, b in path for x in [(a, b), (b, a)] * 20]
    got = near_dedup.components(spark.createDataFrame(links, "a binary, b binary")).collect()
    assert {(bytes(r.v), bytes(r.label)) for r in got} == {
        (bytes([i]), bytes([0])) for i in range(10)} | {(bytes([i]), bytes([20])) for i in (20, 21)}
    assert len(got) == 12 and rows["links"] == 2 * len(path)
