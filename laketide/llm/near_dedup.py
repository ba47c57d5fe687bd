"""MinHash near-dedup by a chosen-path set similarity join.

A document is its set of word shingles.  Documents with equal sets are one
vertex from the start.  A vertex has a sketch of ``COORDS`` minwise tokens.
``TREES`` independent trees branch it: at a node, the node's key chooses
``BRANCHES`` coordinates, and the vertex goes on to one child per chosen
coordinate, named by the minwise token there.  Two sets of similarity s
part at a node only if they differ in all chosen coordinates, so with two
branches they still share a node at any depth of one tree with probability
q = 1 - (1 - s q)^2 (0.97 for s = 0.85, 0.94 for 0.8), and miss each other
in the first nodes of all four trees with probability below 1e-6 (0.85) and
2e-5 (0.8).

* Nodes of up to ``SMALL`` vertices are compared exhaustively: by sketch,
  which parts them into clusters of possible partners, and then cluster by
  cluster on the full sets, of 64-bit shingle hashes made from the whole
  texts.  A cluster is searched breadth first, a vertex against all that no
  link has reached yet, so a cluster of n vertices gives at most n - 1 links.
* In a larger node every vertex is compared with the node's first vertex,
  by sketch and then on the full sets.  Confirmed partners of it leave the
  node, so a large group of near copies costs one comparison a member; all
  others, refused ones included, branch on.  A partner can link only to a
  vertex whose distance from the first one is at most twice that of the
  threshold (Jaccard distance is a metric).  If a refused vertex is so near,
  all that are so near are compared block by block, once for a first vertex
  and depth, whatever the number of its nodes.
* What is still large at ``DEPTH`` is compared block by block.

Components are found by label propagation with pointer jumping; only counts
reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import discard, in_pieces, mixed, odd_constants, utf8, written
from laketide.llm.shingles import shingle_hashes

COORDS = 128
TREES = 4
BRANCHES = 2
FIRST_DEPTH = 3     # nodes of this depth are made in the first pass
DEPTH = 8
SMALL = 2048
TOKENS = 2_000_000  # shingles of a cluster that are looked at in one go

_MULT = odd_constants(5, COORDS).astype(np.uint32) | np.uint32(1)
_XOR = odd_constants(6, COORDS).astype(np.uint32)
_ROOTS = odd_constants(9, TREES)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Minwise tokens (uint32) of a set of 64-bit hashes, not empty."""
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(h), 2048):
        part = (h[a:a + 2048, None] ^ _XOR) * _MULT
        np.minimum(low, part.min(axis=0), out=low)
    return low


def children(nodes: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """(rows, m) node keys -> (rows, m * BRANCHES) keys of the children."""
    out = []
    choice = mixed(nodes + np.uint64(0x51ED270B))
    at = (choice % np.uint64(COORDS)).astype(np.int64)
    step = (choice >> np.uint64(32)) % np.uint64(COORDS - 1) + np.uint64(1)
    for _ in range(BRANCHES):
        value = np.take_along_axis(sketches, at, axis=1).astype(np.uint64)
        out.append(mixed(nodes ^ mixed(value * np.uint64(COORDS) + at.astype(np.uint64) + np.uint64(1))))
        at = (at + step.astype(np.int64)) % COORDS
    return np.concatenate(out, axis=1)


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity estimates from the low byte of every minwise token."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def _margin(least: float) -> float:
    """Agreement below which a pair is given up: four standard deviations
    under the threshold."""
    return least - 4 * (least * (1 - least) / COORDS) ** 0.5


def _profiles(docs: DataFrame, words: int) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in in_pieces(batches):
            hashes, ends = shingle_hashes(*utf8(b.column("text")), words)
            n, keys, sketches, nodes = [], [], [], []
            for i in range(b.num_rows):
                own = np.unique(hashes[ends[i]:ends[i + 1]])
                n.append(len(own))
                if not len(own):
                    keys.append(None)
                    sketches.append(None)
                    nodes.append(None)
                    continue
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                s = sketch(own)
                sketches.append(s.tobytes())
                at = _ROOTS[None, :]
                for _ in range(FIRST_DEPTH):
                    at = children(at, s[None, :])
                nodes.append(at[0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sketches, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "n_shingles", "v", "sketch", "nodes"])
    return docs.mapInArrow(run, f"doc_id {id_type}, text_hash bigint, n_shingles bigint, v binary, "
                                "sketch binary, nodes array<bigint>")


_PAIR = "a binary, b binary"


def _scanned(df: DataFrame) -> DataFrame:
    """A side of a join that is read from a written table and grows with the
    input: never broadcast.  Spark goes by the size of the files, and hashes
    that lie there side by side take about eight times that on the driver."""
    return df.hint("merge")


def _clusters(found: list[list[bytes]]) -> pa.RecordBatch:
    """Clusters with a key made of their members."""
    found = [sorted(c) for c in found]
    return pa.RecordBatch.from_arrays(
        [pa.array([hashlib.blake2b(b"".join(c), digest_size=16).digest() for c in found], pa.binary()),
         pa.array(found, pa.list_(pa.binary()))], ["c", "vs"])


def _compare_groups(groups: DataFrame, least: float) -> DataFrame:
    """Clusters (c, vs) of the vertices of a group (columns vs, marks)
    whose sketches agree, directly or through others."""
    low = _margin(least)

    def run(batches):
        for batch in batches:
            found: list[list[bytes]] = []
            for vs, marks in zip(*[batch.column(c).to_pylist() for c in ("vs", "marks")]):
                m = np.frombuffer(b"".join(marks), np.uint8).reshape(len(vs), COORDS)
                rest = np.arange(len(vs))
                while len(rest) > 1:
                    members, front, rest = [rest[0]], [rest[0]], rest[1:]
                    while front and len(rest):
                        x = front.pop()
                        near = _agreement(m[x], m[rest]) >= low
                        members.extend(rest[near])
                        front.extend(rest[near])
                        rest = rest[~near]
                    if len(members) > 1:
                        found.append([vs[i] for i in members])
            yield _clusters(found)
    return groups.select("vs", "marks").mapInArrow(run, "c binary, vs array<binary>")


def _meet_first(large: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Rows (node, v, pivot) of large nodes -> distinct pairs (pivot, v, est)
    of the node's first vertex and a vertex that is, or can be linked to, a
    partner of it."""
    floor = _margin(max(2 * least - 1, 0))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            marks, first = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDS)
                            for c in ("mark", "pivot_mark"))
            est = _agreement(marks, first)
            yield pa.RecordBatch.from_arrays([*batch.select(["pivot", "v"]).columns, pa.array(est)],
                                             ["pivot", "v", "est"]).filter(pa.array(est >= floor))
    first = sketches.select(F.col("v").alias("pivot"), F.col("mark").alias("pivot_mark"))
    pairs = large.where("v <> pivot").select("pivot", "v").distinct()
    return (pairs.join(_scanned(sketches.select("v", "mark")), "v").join(_scanned(first), "pivot")
            .select("pivot", "v", "mark", "pivot_mark").mapInArrow(run, "pivot binary, v binary, est double"))


def _branched(staying: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows (node, v) -> distinct rows (v, node) of the children."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            full = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, COORDS)
            nodes = batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
            kids = children(nodes[:, None], full).view(np.int64)
            v = batch.column("v").take(pa.array(np.repeat(np.arange(len(kids)), BRANCHES)))
            yield pa.RecordBatch.from_arrays([v, pa.array(kids.reshape(-1), pa.int64())], ["v", "node"])
    return (staying.join(_scanned(sketches.select("v", "sketch")), "v").select("v", "sketch", "node")
            .mapInArrow(run, "v binary, node bigint").distinct())


def _candidates(vertices: DataFrame, least: float, confirm) -> tuple[DataFrame, list[DataFrame]]:
    """Distinct clusters (c, vs) of vertices whose sketches agree, written,
    and tables of links that ``confirm`` (clusters -> links, written) has
    found in large nodes.  A depth's clusters are written before the next
    depth, so no job grows with the number of depths."""
    low = _margin(least)
    sketches = vertices.select("v", "sketch", "mark")
    at = vertices.select("v", F.explode("nodes").alias("node"))
    found, last, links = [], [], []

    def find(groups: DataFrame) -> None:
        found.append(written(_compare_groups(groups, least).dropDuplicates(["c"]), "clusters"))
    for depth in range(FIRST_DEPTH, DEPTH + 1):
        sizes = at.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("pivot")).where("n > 1")
        shared = written(_scanned(at).join(sizes, "node"), "nodes")
        discard(*last)
        last = [shared]
        # the same members in several nodes are compared once
        find(_members(shared.where(F.col("n") <= SMALL), sketches, ["node"]).dropDuplicates(["vs"]))
        large = shared.where(F.col("n") > SMALL)
        if large.isEmpty():
            break
        if depth == DEPTH:
            find(_blocks(large, sketches))
            break
        met = written(_meet_first(large, sketches, least), "met_first")
        pair = F.array_sort(F.array("pivot", "v"))
        links.append(confirm(met.where(F.col("est") >= low).select(F.unhex(F.md5(F.concat(pair[0], pair[1]))).alias("c"), pair.alias("vs"))
                             .dropDuplicates(["c"])))
        linked = links[-1].select(F.col("a").alias("pivot"), F.col("b").alias("v"))
        linked = _scanned(linked.union(linked.select("v", "pivot")))
        staying = large.where("v <> pivot").join(linked, ["pivot", "v"], "left_anti")
        # links of those that leave to those that stay
        refused = met.join(linked, ["pivot", "v"], "left_anti").select("pivot").distinct()
        partners = linked.join(refused, "pivot", "left_semi").select("pivot").distinct()
        near = _scanned(met).join(partners, "pivot", "left_semi").select(F.col("pivot").alias("node"), "v")
        near = _scanned(near).join(near.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "node")
        find(_blocks(near, sketches))
        at = written(_branched(staying, sketches), "children")
        discard(shared, met)
        last = [at]
    discard(*last)
    if len(found) == 1:
        return found[0], links
    clusters = found[0]
    for f in found[1:]:
        clusters = clusters.union(f)
    clusters = written(clusters.dropDuplicates(["c"]), "clusters")
    discard(*found)
    return clusters, links


def _members(nodes: DataFrame, sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(vs, marks) of every node."""
    return (_scanned(nodes).join(_scanned(sketches.select("v", "mark")), "v")
            .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("v", "mark"))).alias("m"))
            .select(F.col("m.v").alias("vs"), F.col("m.mark").alias("marks")))


def _blocks(large: DataFrame, sketches: DataFrame) -> DataFrame:
    """Groups that bring together every two blocks of a node, blocks being
    dealt by hash."""
    dealt = (large.withColumn("parts", F.ceil(F.col("n") / F.lit(SMALL / 2)).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("node", "v", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")))
    return _members(dealt, sketches, ["node", "x", "y"])


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(v, set) of the wanted (doc_id, text_hash) rows: sorted 64-bit hashes."""
    w = wanted.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"))
    some = docs.join(w, docs["doc_id"].eqNullSafe(w["_id"]) & (docs["text_hash"] == w["_th"]), "left_semi")

    def run(batches):
        for b in in_pieces(batches):
            hashes, ends = shingle_hashes(*utf8(b.column("text")), words)
            own = [np.unique(hashes[x:y]).tobytes() for x, y in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in own], pa.binary()),
                 pa.array(own, pa.binary())], ["v", "tokens"])
    # rows that repeat a document give the same set
    return some.select("text").mapInArrow(run, "v binary, tokens binary").dropDuplicates(["v"])


def _numbered(sets: list[np.ndarray], piece: int) -> tuple[np.ndarray, int]:
    """(all sets one after the other, their tokens as numbers; how many)."""
    known, part, n = np.zeros(0, np.uint64), [], 0
    for x in sets:
        part.append(x)
        n += len(x)
        if n > piece:
            known, part, n = np.unique(np.concatenate([known, *part])), [], 0
    known = np.unique(np.concatenate([known, *part]))
    return np.concatenate([np.searchsorted(known, x).astype(np.int32) for x in sets]), len(known)


def _linked(sets: list[np.ndarray], num: int, den: int, piece: int = TOKENS):
    """Index pairs that link all of a cluster's vertices that links reach;
    about ``piece`` tokens are looked at in one go."""
    sizes = np.array([len(x) for x in sets])
    tokens, n_tokens = _numbered(sets, piece)
    starts = np.cumsum(sizes) - sizes
    flag = np.zeros(n_tokens, np.int32)

    def shared(some):
        n = sizes[some]
        at = np.cumsum(n) - n
        return np.add.reduceat(flag[tokens[np.repeat(starts[some] - at, n) + np.arange(n.sum())]], at)
    rest = np.arange(len(sets))
    while len(rest) > 1:
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            x = front.pop()
            own = tokens[starts[x]:starts[x] + sizes[x]]
            flag[own] = 1
            parts = np.split(rest, np.flatnonzero(np.diff(np.cumsum(sizes[rest]) // piece)) + 1)
            both = np.concatenate([shared(part) for part in parts])
            flag[own] = 0
            link = den * both.astype(np.int64) >= num * (sizes[rest] + sizes[x] - both)
            for y in rest[link].tolist():
                yield x, y
                front.append(y)
            rest = rest[~link]


def _confirmed(clusters: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links of the clusters.  A cluster's sets come one row each, so that
    no row grows with it."""
    piece = TOKENS

    def of_clusters(batches):
        last, vs, sets = None, [], []
        for batch in batches:
            for c, v, tokens in zip(*[batch.column(x).to_pylist() for x in ("c", "v", "tokens")]):
                if c != last and vs:
                    yield vs, sets
                    vs, sets = [], []
                last = c
                vs.append(v)
                sets.append(np.frombuffer(tokens, np.uint64))
        if vs:
            yield vs, sets

    def run(batches):
        a, b = [], []
        for vs, sets in of_clusters(batches):
            for x, y in _linked(sets, num, den, piece):
                a.append(vs[x])
                b.append(vs[y])
            if len(a) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
    full = _scanned(clusters.select("c", F.explode("vs").alias("v"))).join(_scanned(sets), "v").select("c", "v", "tokens")
    return full.repartition("c").sortWithinPartitions("c").mapInArrow(run, _PAIR)


def components(links: DataFrame) -> DataFrame:
    """(v, label) for every vertex with a link (columns a, b); the label is
    the smallest vertex of its component.

    A link may come many times, in either direction (a group of near copies
    is a cluster of many nodes, and each cluster gives its links); it is
    followed once.  Each round takes the smallest label of the neighbours (sums of a hot
    vertex are combined map-side) and then the label of that label; a path
    of n vertices takes about log n rounds.
    """
    once = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = written(once.select("a", "b").union(once.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    last = written(both.groupBy("a").agg(F.min("b").alias("near"))
                   .select(F.col("a").alias("v"), F.least("a", "near").alias("next")), "labels")
    while True:
        labels = last.select("v", F.col("next").alias("label"))
        near = (_scanned(both).join(_scanned(labels.select(F.col("v").alias("b"), F.col("label"))), "b")
                .groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near")))
        stepped = _scanned(labels).join(near, "v").select("v", "label", F.least("label", "near").alias("next"))
        # v's old label also hears of it, so that a whole group moves at once
        roots = (stepped.where(F.col("next") < F.col("label")).groupBy(F.col("label").alias("r"))
                 .agg(F.min("next").alias("r_next")))
        moved = (stepped.join(roots, F.col("next") == F.col("r"), "left")
                 .select("v", "label", F.coalesce("r_next", "next").alias("next")))
        moved = written(moved, "moved")
        changed = moved.where(F.col("next") != F.col("label")).count()
        discard(last)
        last = moved
        if not changed:
            discard(both)
            return last.select("v", F.col("next").alias("label"))


def near_dedup(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles,
    component_id, kept.

    Two documents are linked if ``100 * |A & B| >= 80 * |A | B|`` (the pair
    ``similarity``) holds for their sets of ``words``-word shingles;
    component_id is the smallest doc_id that links reach, and the row with
    this doc_id is kept.  A text with fewer words has its word sequence as
    its one shingle; null and empty texts and texts without words have none
    and are linked with nothing.  Rows with a null doc_id take part, but give
    no component_id unless no other row of the component has one (then it is
    null and the row is kept).  Repeated rows carry the same flags.  Other
    columns are not read; an empty table gives no rows.
    """
    num, den = similarity
    least = num / den
    plain = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    made = written(_profiles(plain, words), "profiles")
    full = made.where("v is not null")
    place = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash"))
    vertices = full.groupBy("v").agg(place.alias("k"))
    first = vertices.select("v", F.col("k.doc_id").alias("doc_id"), F.col("k.text_hash").alias("text_hash"))
    f = first.select(F.col("v").alias("_v"), F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"))
    heads = full.join(f, (full["v"] == f["_v"]) & full["doc_id"].eqNullSafe(f["_id"])
                      & (full["text_hash"] == f["_th"]), "left_semi").dropDuplicates(["v"])

    def low_bytes(batches):
        for b in batches:
            s = np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint32).astype(np.uint8).reshape(-1, COORDS)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([r.tobytes() for r in s], pa.binary())], [*b.schema.names, "mark"])
    heads = written(heads.select("v", "doc_id", "text_hash", "n_shingles", "sketch", "nodes").mapInArrow(
        low_bytes, f"v binary, doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash bigint, "
                   "n_shingles bigint, sketch binary, nodes array<bigint>, mark binary"), "vertices")

    def confirm(clusters):
        ends = clusters.select(F.explode("vs").alias("v")).distinct()
        wanted = heads.select("v", "doc_id", "text_hash").join(ends, "v", "left_semi")
        sets = written(_sets(plain, wanted, words), "sets")
        links = written(_confirmed(clusters, sets, num, den), "confirmed")
        discard(sets)
        return links
    clusters, links = _candidates(heads, least, confirm)
    confirmed = confirm(clusters)
    for more in links:
        confirmed = confirmed.union(more)
    discard(heads, clusters)
    labels = components(confirmed)

    own = full.select("doc_id", "text_hash", "n_shingles", "v").join(_scanned(labels), "v", "left")
    own = own.withColumn("label", F.coalesce("label", "v"))
    lowest = own.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = own.join(lowest, "label").select("doc_id", "text_hash", "n_shingles", "component_id")
    alone = made.where("v is null").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """``docs``, all columns, without the rows that :func:`near_dedup` does
    not keep."""
    out = (near_dedup(docs, words, similarity).where(~F.col("kept"))
           .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th")).distinct())
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(out, docs["doc_id"].eqNullSafe(out["_id"]) & (text_hash == out["_th"]), "left_anti")
