"""Similarity join of word shingles by token-combination prefixes.

A document is its set of word shingles (tokens).  Two sets of n and m tokens
with a Jaccard similarity of t share at least t * n tokens, so at most
``e = n - ceil(t * n)`` tokens of the first are not in the second.

1. *Rare tokens*: tokens are dealt by hash to count the sets that hold each.
   A token of one set only has no partner: a set with more than e of them is
   linked with nothing and leaves.  The first count looks at half of all
   tokens, which is enough for most sets; the second at all tokens of the sets
   that are left.
2. *Prefixes*: the tokens of a set are ordered from rare to frequent, the
   same way in all sets.  A rare token is a signature by itself.  Frequent
   tokens fall into classes (by frequency, then by hash) and give as
   signatures the combinations of two, of the most frequent ones of three,
   tokens of a class.  A class of c prefix tokens without a common
   combination has at least ``c - k + 1`` tokens that the partner lacks; the
   prefix is extended until these sum up to ``e + 1``.  Then two linked sets
   have a common signature: of two prefixes, all common tokens of the one that
   ends first lie in the other.
3. *Verification*: among the sets with a common signature the smallest one is
   compared with the others, on the words themselves.  Compared, it leaves the
   signature's group; groups whose sets are all in one component are done.
   Sets outside the component of their group's first one are compared with
   ``PIVOTS`` members of it, and those that are still outside with all others
   that may be linked, block by block: in a task, on what the sets do not have
   in common with one of them, so that no pair is a row.  So a group of n near
   copies costs about n comparisons, and no link between components is left
   out.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import discard, in_pieces, mixed, written
from laketide.llm.near_dedup import components
from laketide.llm.words import exact_set, shingle_sets, texts, words_of

RARE = 32           # sets up to which a token is a signature by itself
COMMON = 1024       # sets from which combinations of three are taken
PART = 2_000_000    # tokens that are counted in one go
SENT = 1_000_000    # tokens that a task deals out in one go
PIVOTS = 8          # of a component, for the sets that its first ones do not reach
PAIRS_A_TASK = 64   # comparisons with one set before it is sent to another task
BLOCK = 512         # sets that meet another block of sets in one go, about
BLOCK_BYTES = 4 << 20   # of their words, about


def allowed(n, num: int, den: int):
    """Tokens of a set of n that a partner may lack."""
    return n - -(-num * n // den)


def _profiles(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, v); v names the sequence of words."""
    def run(batches):
        for b in in_pieces(batches):
            bodies = texts(b.column("text"))
            v = [hashlib.blake2b(b" ".join(x), digest_size=16).digest() if x else None for x in bodies]
            n = [len(s) for s in shingle_sets(bodies, words)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()),
                                              pa.array(v, pa.binary())], ["doc_id", "text_hash", "n_shingles", "v"])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {id_type}, text_hash bigint, n_shingles bigint, v binary")


def _dealt(rows: DataFrame, column: str, words: int, parts: int, share: float) -> DataFrame:
    """Tokens of the lowest ``share`` of all hashes, dealt to ``parts`` ranges
    of hashes: rows (piece, part, vs, counts, tokens) that hold the tokens of
    many sets."""
    top = int(share * 2 ** 64) - 1
    bounds = np.array([top // parts * i for i in range(1, parts)], np.uint64)

    def sent(piece, held):
        cuts = np.array([[0, *np.searchsorted(s, bounds, "right"), len(s)] for s in held.values()])
        out = []
        for p in range(parts):
            some = [(v, s[x:y]) for (v, s), x, y in zip(held.items(), cuts[:, p].tolist(), cuts[:, p + 1].tolist()) if y > x]
            if some:
                out.append((piece, p, b"".join([v for v, _ in some]), np.array([len(t) for _, t in some], np.int32).tobytes(),
                            np.concatenate([t for _, t in some]).tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.int64(), pa.int32(), *[pa.binary()] * 3))],
            ["piece", "part", "vs", "counts", "tokens"])

    def run(batches):
        piece, n, held = TaskContext.get().partitionId() << 32, 0, {}
        for b in in_pieces(batches, column):
            bodies = texts(b.column(column).cast(pa.string()))
            for body, s in zip(bodies, shingle_sets(bodies, words)):
                v = hashlib.blake2b(b" ".join(body), digest_size=16).digest()
                if len(s) and v not in held:
                    held[v] = s[:np.searchsorted(s, np.uint64(top), "right")]
                    n += len(held[v])
            if n > SENT:
                yield sent(piece, held)
                piece, n, held = piece + 1, 0, {}
        if held:
            yield sent(piece, held)
    return (rows.select(column).mapInArrow(run, "piece bigint, part int, vs binary, counts binary, tokens binary")
            .repartition(parts, "part").sortWithinPartitions("part"))


_REPLY = "piece bigint, part int, vs binary, counts binary, tokens binary, dfs binary"


def _counted(dealt: DataFrame, reply: bool) -> DataFrame:
    """The rows of ``dealt`` back, for their pieces: with ``reply`` the tokens
    and (dfs) how many sets hold each, else instead of the counts how many of
    a set's tokens no other set holds."""
    def finish(held):
        seen, keep, tokens = set(), [], []
        for row in held:            # a set that several pieces sent counts once
            vs, counts, blob = row["vs"], np.frombuffer(row["counts"], np.int32), np.frombuffer(row["tokens"], np.uint64)
            first = np.ones(len(counts), bool)
            for i in range(len(counts)):
                v = vs[16 * i:16 * i + 16]
                first[i] = v not in seen
                seen.add(v)
            keep.append(np.repeat(first, counts))
            tokens.append(blob)
        mask, all_tokens = np.concatenate(keep), np.concatenate(tokens)
        _, at, df = np.unique(all_tokens[mask], return_inverse=True, return_counts=True)
        dfs = np.zeros(len(all_tokens), np.int32)       # 0 in a repeated set
        dfs[mask] = df[at]
        end = 0
        for row, blob in zip(held, tokens):
            own = dfs[end:end + len(blob)]
            end += len(blob)
            if not reply:
                counts = np.frombuffer(row["counts"], np.int32)
                row["counts"] = np.add.reduceat((own == 1).astype(np.int32), np.cumsum(counts) - counts, dtype=np.int32).tobytes()
                row["tokens"] = None
            row["dfs"] = own.tobytes() if reply else None
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[c]], kind) for c, kind in
                 (("piece", pa.int64()), ("part", pa.int32()), *[(c, pa.binary()) for c in ("vs", "counts", "tokens", "dfs")])],
                ["piece", "part", "vs", "counts", "tokens", "dfs"])

    def run(batches):
        held = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield from finish(held)
                    held = []
                held.append(row)
        if held:
            yield from finish(held)
    return dealt.mapInArrow(run, _REPLY).repartition("piece").sortWithinPartitions("piece", "part")


def _by_piece(batches):
    """Lists of the rows of a piece, in the order of its parts."""
    held = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["piece"] != row["piece"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _singles(counted: DataFrame) -> DataFrame:
    """(v, singles): tokens that no other set holds."""
    def run(batches):
        for rows in _by_piece(batches):
            total: dict[bytes, int] = {}
            for row in rows:
                vs = row["vs"]
                for i, n in enumerate(np.frombuffer(row["counts"], np.int32).tolist()):
                    v = vs[16 * i:16 * i + 16]
                    total[v] = total.get(v, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                             ["v", "singles"])
    return counted.mapInArrow(run, "v binary, singles bigint").groupBy("v").agg(F.sum("singles").alias("singles"))


def signatures(tokens: np.ndarray, dfs: np.ndarray, num: int, den: int, classes=(RARE, COMMON)) -> np.ndarray:
    """Signatures (int64) of a set, whose tokens are in ``dfs`` sets each."""
    n = len(tokens)
    e = allowed(n, num, den)
    if n <= 3:      # only an equal set can be linked
        return mixed(np.array([np.bitwise_xor.reduce(mixed(tokens)) + np.uint64(n)], np.uint64)).view(np.int64)
    if int((dfs == 1).sum()) > e:
        return np.zeros(0, np.int64)
    order = np.lexsort((tokens, dfs))
    tokens, dfs = tokens[order], dfs[order]
    k = np.where(dfs <= classes[0], 1, np.where(dfs <= classes[1], 2, 3))
    out: list[np.ndarray] = []
    # sets of these sizes are partners; their classes are made alike
    low, high = -(-num * n // den), den * n // num
    for bits in {max(int(x) // 8, 1).bit_length() - 1 for x in (low, n, high)}:
        slot = (mixed(tokens) & np.uint64((1 << bits) - 1)).astype(np.int64)
        members: dict[tuple[int, int], list[int]] = {}
        gained = 0
        for i, (kind, s) in enumerate(zip(k.tolist(), slot.tolist())):
            if kind == 1:
                gained += 1
            else:
                own = members.setdefault((kind, s), [])
                own.append(i)
                gained += len(own) >= kind
            if gained > e:
                break
        single = tokens[:i + 1][(k[:i + 1] == 1) & (dfs[:i + 1] > 1)]
        out.append(single)
        for (kind, _), own in members.items():
            if len(own) >= kind:
                own = np.sort(tokens[own])
                at = np.array(list(combinations(range(len(own)), kind)))
                s = np.full(len(at), bits * 4 + kind, np.uint64)
                for j in range(kind):
                    s = mixed(s + own[at[:, j]])
                out.append(s)
    return np.unique(np.concatenate(out)).view(np.int64)


def _signed(counted: DataFrame, num: int, den: int, classes) -> DataFrame:
    """Rows (sig, v, n)."""
    def run(batches):
        for rows in _by_piece(batches):
            parts: dict[bytes, list] = {}
            for row in rows:
                vs, at = row["vs"], 0
                tokens, dfs = np.frombuffer(row["tokens"], np.uint64), np.frombuffer(row["dfs"], np.int32)
                for i, n in enumerate(np.frombuffer(row["counts"], np.int32).tolist()):
                    parts.setdefault(vs[16 * i:16 * i + 16], []).append((tokens[at:at + n], dfs[at:at + n]))
                    at += n
            done = []
            for v, own in parts.items():
                s = np.concatenate([x for x, _ in own])
                done.append((v, len(s), signatures(s, np.concatenate([x for _, x in own]), num, den, classes)))
            for start in range(0, len(done), 500):
                some = done[start:start + 500]
                size = [len(sig) for _, _, sig in some]
                v = pa.array([v for v, _, _ in some], pa.binary()).take(pa.array(np.repeat(np.arange(len(some)), size)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([sig for _, _, sig in some]), pa.int64()), v,
                     pa.array(np.repeat([n for _, n, _ in some], size), pa.int64())], ["sig", "v", "n"])
    return counted.mapInArrow(run, "sig bigint, v binary, n bigint")


def _verified(pairs: DataFrame, sets: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Those of the distinct pairs (a, b) that are linked, on the words
    themselves.  Set a comes once for so many of its partners; the partners
    stream by."""
    tasks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_A_TASK).alias("tasks"))
    dealt = (pairs.join(tasks, "a")
             .select("a", "b", F.pmod(F.xxhash64("b"), F.col("tasks")).alias("task"), F.lit(1).alias("z")))
    heads = tasks.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"),
                         F.lit(0).alias("z"))
    rows = dealt.unionByName(heads).join(sets.select(F.col("v").alias("b"), "body"), "b")

    def run(batches):
        last, head = None, set()
        for b in in_pieces(batches, "body"):
            found = []
            for a, v, task, z, body in zip(*[b.column(c).to_pylist() for c in ("a", "b", "task", "z", "body")]):
                own = exact_set(body.split(), words)
                if not z:
                    last, head = (a, task), own
                    continue
                assert (a, task) == last
                both = len(head & own)
                if den * both >= num * (len(head) + len(own) - both):
                    found.append((a, v))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["a", "b"])
    return (rows.select("a", "b", "task", "z", "body").repartition("a", "task")
            .sortWithinPartitions("a", "task", "z").mapInArrow(run, "a binary, b binary"))


def _fits(a: Column, b: Column, num: int, den: int) -> Column:
    return den * F.least(a, b) >= num * F.greatest(a, b)


def _cheaper(at: DataFrame) -> DataFrame:
    """Rows (key, v, n, label, out) in which every set outside its component
    meets all that it has to be compared with: those of its signatures'
    groups, or those of all groups of the component if that is less work."""
    at = at.withColumn("out", F.col("label") != F.col("near"))
    out = F.sum(F.col("out").cast("long")).alias("o")
    groups = at.groupBy("near", "sig").agg(F.count(F.lit(1)).alias("c"), out).where("o > 0")
    members = at.select("near", "v", "n", "label", "out").distinct()
    way = (groups.groupBy("near").agg(F.sum(F.col("c") * F.col("o")).alias("by_sig"))
           .join(members.groupBy("near").agg(F.count(F.lit(1)).alias("c"), out), "near")
           .select("near", (F.col("by_sig") <= F.col("c") * F.col("o")).alias("narrow")))
    chosen = groups.select("near", "sig").join(way.where("narrow").select("near"), "near")
    narrow = at.join(chosen, ["near", "sig"], "left_semi").withColumn("key", F.struct("near", F.col("sig").alias("sig")))
    wide = (members.join(way.where(~F.col("narrow")).select("near"), "near", "left_semi")
            .withColumn("key", F.struct("near", F.lit(None).cast("bigint").alias("sig"))))
    rows = ["key", "v", "n", "label", "out"]
    return narrow.select(*rows).unionByName(wide.select(*rows))


def shared_sizes(sets: list[np.ndarray]):
    """A function that counts what set i has in common with each of the sets.

    Near copies differ little from any one of them: each set is held as what
    it and the first one do not share, and only the differences are looked
    through."""
    apart = [np.setxor1d(s, sets[0], assume_unique=True) for s in sets]
    n, d = (np.array([len(x) for x in some]) for some in (sets, apart))
    tokens = np.concatenate(apart)
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], np.repeat(np.arange(len(sets)), d)[order]

    def shared(i: int) -> np.ndarray:
        start, end = (np.searchsorted(tokens, apart[i], side) for side in ("left", "right"))
        size = end - start
        hit = owners[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        both = np.bincount(hit, minlength=len(sets))
        return (n[i] - d[i] + n - d + 2 * both) // 2
    return shared


def _joined(rows: list[tuple], words: int, num: int, den: int):
    """Links (a, b) of a block's rows (v, label, side, body) that join what
    links between its two sides join; sets of one label are joined already."""
    sets = shingle_sets([r[3].split() for r in rows], words)
    n = np.array([len(s) for s in sets])
    comp = np.unique([r[1] for r in rows], return_inverse=True)[1]
    side = np.array([r[2] for r in rows])
    shared = shared_sizes(sets)
    for i in np.flatnonzero(side == 1).tolist():
        both = shared(i)
        near = (side == 0) & (comp != comp[i]) & (den * both >= num * (n + n[i] - both))
        own = None
        for j in np.flatnonzero(near).tolist():
            if comp[j] == comp[i]:
                continue
            # on the words themselves
            own = own or exact_set(rows[i][3].split(), words)
            other = exact_set(rows[j][3].split(), words)
            common = len(own & other)
            if den * common >= num * (len(own) + len(other) - common):
                yield rows[i][0], rows[j][0]
                comp[comp == comp[j]] = comp[i]


def _across(rows: DataFrame, sets: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between sets of different labels, for every key of
    ``rows`` (see :func:`_cheaper`): all that are needed to join what links
    between an outside set and a set of the key join.

    A key's sets are dealt into blocks of about ``BLOCK`` sets or
    ``BLOCK_BYTES``; every block of outside sets meets every block of sets in
    one group of rows.  So no pair is a row, a set travels once for each block
    that it meets, and a task holds two blocks whatever the size of a key.
    """
    sized = rows.join(sets.select("v", F.octet_length("body").alias("size")), "v")

    def blocks(which):
        return F.ceil(F.greatest(F.sum(which.cast("long")) / BLOCK,
                                 F.sum(F.when(which, F.col("size"))) / BLOCK_BYTES)).cast("int")
    parts = (sized.groupBy("key").agg(blocks(F.lit(True)).alias("xs"), blocks(F.col("out")).alias("ys")).where("ys > 0"))
    dealt = rows.join(parts, "key").withColumn("h", F.xxhash64("v"))

    def meets(own, other, at, across):
        return [F.pmod("h", F.col(own)).cast("int").alias(at),
                F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(across)]
    inside = dealt.select("key", "v", "label", F.lit(0).alias("side"), *meets("xs", "ys", "x", "y"))
    outside = dealt.where("out").select("key", "v", "label", F.lit(1).alias("side"), *meets("ys", "xs", "y", "x"))
    full = (inside.unionByName(outside).join(sets.select("v", "body"), "v")
            .select("key", "x", "y", "side", "v", "label", "body"))

    def of_blocks(batches):
        last, held = None, []
        for b in in_pieces(batches, "body"):
            for key, x, y, side, v, label, body in zip(*[b.column(c).to_pylist()
                                                         for c in ("key", "x", "y", "side", "v", "label", "body")]):
                if (key, x, y) != last and held:
                    yield held
                    held = []
                last = (key, x, y)
                held.append((v, label, side, body))
        if held:
            yield held

    def run(batches):
        for held in of_blocks(batches):
            found = list(_joined(held, words, num, den))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)], ["a", "b"])
    return (full.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
            .mapInArrow(run, "a binary, b binary"))


def _links(signed: DataFrame, sets: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Written links (a, b) that join all sets that links reach."""
    sizes = signed.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("sig")
    at = written(signed.join(sizes, "sig"), "groups")
    discard(signed)
    done, scratch = [], [at]

    def verify(pairs):
        for tested, _ in done:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        done.append((pairs, written(_verified(pairs, sets, words, num, den), "links")))

    def ordered(x, y):
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    def still_open(rows):
        """Rows (sig, v, n, label, near) of groups with several components;
        near is the component of the first one."""
        labels = components(found())
        rest = rows.select("sig", "v", "n").join(labels, "v", "left")
        rest = rest.withColumn("label", F.coalesce("label", "v"))
        groups = (rest.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                          F.min(F.struct("v", "label")).alias("f"))
                  .where("x <> y").select("sig", F.col("f.label").alias("near")))
        out = written(rest.join(groups, "sig"), "open_groups")
        scratch.append(out)
        return out

    def found():
        links = done[0][1]
        for _, more in done[1:]:
            links = links.union(more)
        return links
    first = at.groupBy("sig").agg(F.min(F.struct("v", "n")).alias("f"))
    met = at.join(first, "sig").where(F.col("v") != F.col("f.v"))
    verify(met.where(_fits(F.col("n"), F.col("f.n"), num, den)).select(*ordered("v", "f.v")).distinct())
    at = still_open(met)        # the first one has met all others of its group
    if not at.isEmpty():
        # sets outside a component, with some that have much in common with it
        share = F.pmod(F.xxhash64("v"), F.lit(PIVOTS))
        inside = (at.where("label = near").groupBy("near", "v").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
                  .withColumn("share", share))
        pivots = (inside.groupBy("near", "share").agg(F.max(F.struct("c", "v", "n")).alias("p"))
                  .select("near", F.col("p.v").alias("pv"), F.col("p.n").alias("pn")))
        outside = at.where("label <> near").select("near", "v", "n").distinct()
        verify(outside.join(pivots, "near").where(_fits(F.col("n"), F.col("pn"), num, den))
               .select(*ordered("v", "pv")).distinct())
        at = still_open(at)
    if not at.isEmpty():
        # every set outside with all others of its groups, or with all that
        # have to do with the component, whichever are fewer
        done.append((None, written(_across(_cheaper(at), sets, words, num, den), "links")))
    out = written(found(), "all_links")
    discard(*scratch, *[t for both in done for t in both if t])
    return out


def ngram_join(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (80, 100),
               classes: tuple[int, int] = (RARE, COMMON)) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles,
    component_id.

    Two documents are linked if ``100 * |A & B| >= 80 * |A | B|`` (the pair
    ``similarity``) holds for their sets of ``words``-word shingles;
    component_id is the smallest doc_id that links reach.  ``classes`` are the
    frequencies up to which one token and two tokens make a signature; they
    change the work and not the result.  A text with fewer words has its word sequence as its one shingle; null and empty texts and
    texts without words have none and are linked with nothing.  Rows with a
    null doc_id take part, but give no component_id unless no other row of the
    component has one (then it is null).  Repeated rows carry the same values.
    A text is held whole by one task, a few times its length.  Other columns
    are not read; an empty table gives no rows.
    """
    num, den = similarity
    plain = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    made = written(_profiles(plain, words), "profiles")
    full = made.where("v is not null")
    total = made.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0

    singles = _counted(_dealt(plain, "text", words, total // 2 // PART + 1, 0.5), False)
    singles = written(_singles(singles), "singles")
    place = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash"))
    vertices = full.groupBy("v").agg(place.alias("k"), F.first("n_shingles").alias("n"))
    may = F.col("n") - F.ceil(F.col("n") * num / den)
    heads = (vertices.join(singles, "v", "left").where(F.coalesce("singles", F.lit(0)) <= may + 1e-6)
             .select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_th")))

    def bodies(batches):
        for b in in_pieces(batches):
            own = [b" ".join(words_of(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in own], pa.binary()),
                 pa.array(own, pa.binary())], ["v", "body"])
    some = plain.join(heads, plain["doc_id"].eqNullSafe(heads["_id"]) & (plain["text_hash"] == heads["_th"]), "left_semi")
    # rows that repeat a document give the same body
    sets = written(some.select("text").mapInArrow(bodies, "v binary, body binary").dropDuplicates(["v"]), "sets")
    left = sets.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    counted = _counted(_dealt(sets, "body", words, left // 4 // PART + 1, 1.0), True)
    signed = written(_signed(counted, num, den, classes), "signatures")
    discard(singles)
    links = _links(signed, sets, words, num, den)
    discard(sets)
    labels = components(links)

    own = full.select("doc_id", "text_hash", "n_shingles", "v").join(labels, "v", "left")
    own = own.withColumn("label", F.coalesce("label", "v"))
    lowest = own.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = own.join(lowest, "label").select("doc_id", "text_hash", "n_shingles", "component_id")
    alone = made.where("v is null").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
