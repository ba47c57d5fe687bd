"""Depth-limited radix sort of suffixes for repeated byte windows.

A suffix is ordered only through its first ``depth`` bytes (a window).  The
passes go from the most significant digit down, and a suffix that is alone
after a digit leaves:

1. The leading digit of a window is its anchor: the smallest hash among its
   ``GRAM``-byte substrings (the leftmost of equals), which depends on the
   window's bytes alone.  Neighbouring windows share their anchor, so the
   pass moves one short record for a run of windows.  Records go by the top
   bits of the digit to buckets, a bucket sorts them, and runs whose anchor
   occurs in one document only are done: their windows are not repeated.
2. The remaining runs come with their bytes.  A bucket orders their windows
   by a 64-bit hash of the whole window, then by its bytes, eight at a time
   from the most significant on; a window that is alone after a digit leaves.
   Equal groups are exactly the repeated windows, and all members but those
   of the first document go.

Before either pass a task combines what it has: of an anchor, or of a run
with the same bytes, one record goes out per batch of documents, and the
others are settled on the spot.  So a passage that a third of all documents
hold reaches a bucket once per batch, not once per document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import discard, in_pieces, mixed, odd_constants, utf8, written
from laketide.llm.shingles import _power_tables

DEPTH = 50
GRAM = 16
PIECE = 2 << 20             # bytes of text combined at a time
SEGMENT = 4 << 20           # a longer text is cut, with an overlap of depth - 1
BUCKET_BYTES = 16 << 20     # text bytes a bucket stands for
SLICE = 1 << 19             # windows a bucket orders at a time
_BYTE = odd_constants(21, 256)

# a run on its way: 56 bits of the anchor, its first window, its windows
_RUN = np.dtype([("key", "<u8"), ("at", "<u4"), ("n", "<u2")])


def _prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash, with a 0 in front."""
    powers, _ = _power_tables(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[:-1], dtype=np.uint64, out=out[1:])
    return out


def _hash_at(prefix: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    _, inverse = _power_tables(len(prefix))
    return mixed((prefix[start + size] - prefix[start]) * inverse[start])


def runs_of(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor key, first window, number of windows) of all runs of texts."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < depth:
        return np.zeros(0, np.uint64), none, none
    prefix = _prefix(data)
    gram = min(GRAM, depth)
    grams = _hash_at(prefix, np.arange(n - gram + 1), gram)
    width = depth - gram + 1                # grams in a window
    # smallest hash of each window, then where it stands: the leftmost
    low = grams
    have = 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:len(low) - step], low[step:])
        have += step
    least = low[:n - depth + 1]
    hit = np.zeros(len(least), bool)
    sizes = np.diff(offsets)
    ends = offsets[1:]
    last = np.repeat(ends - depth, sizes)[:len(least)]      # last window of the text of i
    valid = np.arange(len(least)) <= last
    # a run breaks where the least changes, or where window i - 1 starts with
    # its least gram: the anchor itself leaves
    hit[0] = True
    hit[1:] = (least[1:] != least[:-1]) | (grams[:len(least) - 1] == least[:-1])
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    hit |= first[:len(least)]
    # windows that cross into the next text belong to no run
    starts = np.flatnonzero(hit & valid)
    bounds = np.flatnonzero(hit | ~valid)
    upto = np.append(bounds, len(least))[np.searchsorted(bounds, starts) + 1]
    return least[starts], starts, upto - starts


def _split_long(texts: list[bytes], depth: int):
    """(document number, offset, bytes): parts of bounded size."""
    for i, t in enumerate(texts):
        if len(t) <= SEGMENT:
            yield i, 0, t
        else:
            for a in range(0, len(t) - depth + 1, SEGMENT):
                yield i, a, t[a:a + SEGMENT + depth - 1]


def _groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Index of the group of each element of a sorted array."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.cumsum(new) - 1


def _pieces(batch, depth: int):
    """Pieces of a batch: (doc index of each part, offset of each part in
    its text, bytes, part offsets)."""
    data, offs = utf8(batch.column("text"))
    raw = data.tobytes()
    parts = list(_split_long([raw[a:b] for a, b in zip(offs, offs[1:])], depth))
    group, size = [], 0
    for p in parts:
        if len(p[2]) < depth:
            continue
        if group and size + len(p[2]) > PIECE:
            yield _joined(group)
            group, size = [], 0
        group.append(p)
        size += len(p[2])
    if group:
        yield _joined(group)


def _joined(group):
    data = np.frombuffer(b"".join(p[2] for p in group), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(p[2]) for p in group])]).astype(np.int64)
    return np.array([p[0] for p in group]), np.array([p[1] for p in group], np.int64), data, offs


# a row: runs for one bucket, with the documents they are in (``doc`` holds
# an index into doc_ids for every run), or runs that are settled already
_RECORDS = ("bucket int, settled boolean, doc_ids array<bigint>, hashes array<bigint>, doc binary, runs binary, "
            "bodies binary")
_SCHEMA = pa.schema([("bucket", pa.int32()), ("settled", pa.bool_()), ("doc_ids", pa.list_(pa.int64())),
                     ("hashes", pa.list_(pa.int64())), ("doc", pa.binary()), ("runs", pa.binary()),
                     ("bodies", pa.binary())])


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _spread(hashes: list, doc: np.ndarray, buckets: int) -> np.ndarray:
    """Settled runs need no meeting place: they are dealt by document."""
    return np.array([h % buckets for h in hashes], np.int64)[doc]


def _anchor_records(texts: DataFrame, depth: int, buckets: int) -> DataFrame:
    """The runs for the first pass; settled are those whose anchor two
    documents of the batch share."""
    def run(batches):
        for batch in in_pieces(batches, "text", PIECE):
            ids = batch.column("doc_id").to_pylist()
            hashes = batch.column("text_hash").to_pylist()
            for owner, base, data, offs in _pieces(batch, depth):
                keys, at, n = runs_of(data, offs, depth)
                if not len(keys):
                    continue
                keys = keys >> np.uint64(8)
                part = np.searchsorted(offs, at, "right") - 1
                doc = owner[part]
                runs = np.empty(len(keys), _RUN)
                runs["key"], runs["at"], runs["n"] = keys, at - offs[part] + base[part], n
                order = np.argsort(keys, kind="stable")
                runs, doc = runs[order], doc[order]
                group = _groups(runs["key"])
                lo = np.minimum.reduceat(doc, np.flatnonzero(np.diff(group, prepend=-1)))
                hi = np.maximum.reduceat(doc, np.flatnonzero(np.diff(group, prepend=-1)))
                shared = (lo != hi)[group]
                head = np.ones(len(runs), bool)
                head[1:] = group[1:] != group[:-1]
                yield from _packed(_spread(hashes, doc[shared], buckets), ids, hashes, doc[shared], runs[shared], True)
                out = ~shared | head
                yield from _packed(_bucket_of(runs["key"][out], buckets), ids, hashes, doc[out], runs[out], False)
    return texts.mapInArrow(run, _RECORDS)


def _packed(bucket, ids, hashes, doc, runs, settled, bodies=None):
    """One row per bucket."""
    if not len(runs):
        return
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=bucket[order[0]] - 1))
    cols: list[list] = [[], [], [], [], [], [], []]
    for part in np.split(order, cuts[1:]):
        named, local = np.unique(doc[part], return_inverse=True)
        for col, value in zip(cols, (
                int(bucket[part[0]]), settled, [ids[i] for i in named], [hashes[i] for i in named],
                local.astype(np.int32).tobytes(), runs[part].tobytes(),
                b"".join([bodies[i] for i in part.tolist()]) if bodies is not None else None)):
            col.append(value)
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _SCHEMA.types)], _SCHEMA.names)


def _in_buckets(records: DataFrame, judge, buckets: int) -> DataFrame:
    """(doc_id, text_hash, runs), a row per document: the settled runs, and
    of the others those that ``judge(runs, documents, names, bodies)``
    returns, bucket by bucket."""
    def bucket(table):
        out = []
        for settled in (True, False):
            part = table.filter(table.column("settled") if settled else pc.invert(table.column("settled")))
            if part.num_rows:
                runs, doc, names = _unpacked(part)
                if not settled:
                    runs, doc = judge(runs, doc, names, part.column("bodies"))
                ids, hashes = [x[0] for x in names], [x[1] for x in names]
                out.extend(_packed(_spread(hashes, doc, buckets), ids, hashes, doc, runs, True))
        return pa.Table.from_batches(out, _SCHEMA)

    def home(table):
        return pa.Table.from_batches([_by_document(*_unpacked(table))])
    # the results go home by document, packed per bucket and home
    return (records.groupBy("bucket").applyInArrow(bucket, _RECORDS)
            .groupBy("bucket").applyInArrow(home, "doc_id bigint, text_hash bigint, runs binary"))


def _shared_anchors(runs, doc, names, _):
    """First pass: the runs whose anchor two documents hold."""
    order = np.argsort(runs["key"], kind="stable")
    runs, doc = runs[order], doc[order]
    group = _groups(runs["key"])
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    keep = (np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads))[group]
    return runs[keep], doc[keep]


def _unpacked(table):
    """(runs, number of each run's document, names of the documents)."""
    runs, doc, seen = [], [], {}
    for ids, hashes, local, raw in zip(*[table.column(c).to_pylist() for c in ("doc_ids", "hashes", "doc", "runs")]):
        numbers = np.array([seen.setdefault(x, len(seen)) for x in zip(ids, hashes)])
        runs.append(np.frombuffer(raw, _RUN))
        doc.append(numbers[np.frombuffer(local, np.int32)])
    return np.concatenate(runs), np.concatenate(doc), list(seen)


def _by_document(runs, doc, names) -> pa.RecordBatch:
    order = np.argsort(doc, kind="stable")
    doc, runs = doc[order], runs[order]
    cuts = np.flatnonzero(np.diff(doc, prepend=-1))
    own = [names[i] for i in doc[cuts]]
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in own], pa.int64()), pa.array([x[1] for x in own], pa.int64()),
         pa.array([r.tobytes() for r in np.split(runs, cuts[1:])] if len(cuts) else [], pa.binary())],
        ["doc_id", "text_hash", "runs"])


def _with_bodies(texts: DataFrame, depth: int, buckets: int) -> DataFrame:
    """Rows (doc_id, text_hash, text, runs) -> the runs with their bytes for
    the second pass; settled are those whose bytes a smaller document of the
    batch holds: all their windows go."""
    def run(batches):
        for batch in in_pieces(batches, "text", PIECE):
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            raw = [(t or "").encode() for t in batch.column("text").to_pylist()]
            runs, doc = [], []
            for i, own in enumerate(batch.column("runs").to_pylist()):
                own = np.unique(np.frombuffer(own, _RUN))
                runs.append(own)
                doc.append(np.full(len(own), i))
            runs, doc = np.concatenate(runs), np.concatenate(doc)
            if not len(runs):
                continue
            bodies = [raw[i][a:a + n + depth - 1] for i, a, n in zip(doc.tolist(), runs["at"].tolist(), runs["n"].tolist())]
            # the same bytes under the same anchor: the smallest doc_id goes out
            first: dict[bytes, int] = {}
            for i, body in zip(doc.tolist(), bodies):
                other = first.get(body)
                if other is None or ids[i] < other:
                    first[body] = ids[i]
            settled = np.array([ids[i] > first[body] for i, body in zip(doc.tolist(), bodies)])
            yield from _packed(_spread(hashes, doc[settled], buckets), ids, hashes, doc[settled], runs[settled], True)
            out = np.flatnonzero(~settled)
            yield from _packed(_bucket_of(runs["key"][out], buckets), ids, hashes, doc[out], runs[out], False,
                               [bodies[i] for i in out.tolist()])
    return texts.select("doc_id", "text_hash", "text", "runs").mapInArrow(run, _RECORDS)


def _repeated(depth: int):
    def judge(runs, doc, names, bodies):
        """Second pass: the windows that a smaller document holds, as runs."""
        data = np.frombuffer(b"".join(bodies.to_pylist()), np.uint8)
        # documents by doc_id, equal ids having equal ranks
        ids = np.array([x[0] for x in names], np.int64)
        rank = np.unique(ids, return_inverse=True)[1][doc]
        size = runs["n"].astype(np.int64) + depth - 1
        base = np.cumsum(size) - size
        # equal windows have equal anchors: the bucket is gone through in
        # slices of whole anchors, of about SLICE windows
        order = np.argsort(runs["key"], kind="stable")
        done = np.cumsum(runs["n"][order].astype(np.int64))
        heads = np.flatnonzero(np.diff(_groups(runs["key"][order]), prepend=-1))
        begin = np.where(heads > 0, done[heads - 1], 0)
        cuts = heads[np.flatnonzero(np.diff(begin // SLICE, prepend=-1))]
        found = [_repeated_in(part, runs, rank, doc, data, base, size, depth) for part in np.split(order, cuts[1:])]
        return _merged_windows(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))
    return judge


def _repeated_in(part, runs, rank, doc, data, base, size, depth):
    """Single windows (as runs, with their documents) of some runs."""
    runs, rank, doc, size = runs[part], rank[part], doc[part], size[part]
    start = np.cumsum(size) - size
    data = data[np.repeat(base[part] - start, size) + np.arange(size.sum())]
    prefix = _prefix(data)
    n = runs["n"].astype(np.int64)
    owner = np.repeat(np.arange(len(runs)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    digest = mixed(_hash_at(prefix, start[owner] + step, depth) ^ mixed(runs["key"])[owner])
    at, group = _equal_windows(data, start[owner] + step, digest, depth)
    if not len(at):
        return np.empty(0, _RUN), doc[:0]
    ranks = rank[owner[at]]
    gone = at[ranks > np.minimum.reduceat(ranks, np.flatnonzero(np.diff(group, prepend=-1)))[group]]
    out = np.empty(len(gone), _RUN)
    out["key"], out["at"], out["n"] = 0, runs["at"][owner[gone]] + step[gone], 1
    return out, doc[owner[gone]]


def _shared_only(at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the members that are alone in their group."""
    many = np.bincount(group)[group] > 1
    return at[many], _groups(group[many])


def _equal_windows(data: np.ndarray, start: np.ndarray, digest: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows (numbers of them) that equal another one byte by byte,
    group by group, and the groups."""
    at = np.argsort(digest, kind="stable")
    at, group = _shared_only(at, _groups(digest[at]))
    width = 8 if depth >= 8 else 1
    digits = np.ndarray((len(data) - width + 1,), f">u{width}", data.tobytes(), 0, (1,)).astype(np.uint64)
    for k in [*range(0, depth - width, width), depth - width]:
        digit = digits[start[at] + k]
        new = group[1:] != group[:-1]
        if ((digit[1:] != digit[:-1]) & ~new).any():    # one hash for different windows
            order = np.lexsort((digit, group))
            at, group, digit = at[order], group[order], digit[order]
            apart = np.ones(len(at), bool)
            apart[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
            at, group = _shared_only(at, np.cumsum(apart) - 1)
    return at, group


def _merged_windows(runs: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single windows -> runs of adjacent windows (at most 65,535 each)."""
    if not len(runs):
        return runs, doc
    order = np.lexsort((runs["at"], doc))
    at, doc = runs["at"][order].astype(np.int64), doc[order]
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)
    heads = np.flatnonzero(new)
    size = at[np.append(heads[1:], len(at)) - 1] - at[heads] + 1
    pieces = (size + 65534) // 65535
    which = np.repeat(np.arange(len(heads)), pieces)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    out = np.empty(len(which), _RUN)
    out["key"] = 0
    out["at"] = at[heads][which] + nth * 65535
    out["n"] = np.minimum(size[which] - nth * 65535, 65535)
    return out, doc[heads][which]


def repeated_windows(docs: DataFrame, depth: int = DEPTH, buckets: int | None = None) -> DataFrame:
    """(doc_id, text_hash, runs, whole) per document that holds a window which
    also starts in a document with a smaller doc_id.  ``runs`` packs the runs
    of such windows (see ``_RUN``); ``whole`` marks copies of the whole text
    of a smaller document, whose windows are all repeated.  Rows with a null
    doc_id have no place in the order and take no part."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = (docs.where("doc_id is not null")
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                     text.alias("text")))
    if buckets is None:
        size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
    # a copy is a suffix equal to another in all its length: it needs no
    # passes, and nothing that it could show is missing from the first copy;
    # a text shorter than a window has nothing to lose
    digests = texts.where(F.octet_length("text") >= depth).select("doc_id", "text_hash", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"))
    firsts = digests.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = written(digests.join(firsts, "sha").where("doc_id > first").select("doc_id", "text_hash").distinct(), "copies")

    shared = written(_in_buckets(_anchor_records(texts, depth, buckets), _shared_anchors, buckets), "shared_runs")
    some = texts.join(shared.join(copies, ["doc_id", "text_hash"], "left_anti"), ["doc_id", "text_hash"])
    gone = written(_in_buckets(_with_bodies(some, depth, buckets), _repeated(depth), buckets), "repeated_windows")
    discard(shared)
    return (gone.withColumn("whole", F.lit(False))
            .unionByName(copies.withColumn("whole", F.lit(True)), allowMissingColumns=True))


def remove_repeats(docs: DataFrame, depth: int = DEPTH, keep_bytes: bool = False,
                   buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 (and kept, the remaining bytes, with ``keep_bytes``).

    A byte is removed if a window of ``depth`` bytes that covers it also
    starts in a document with a smaller doc_id; overlaps count, and windows
    are judged on the input.  n_spans counts maximal removed runs.  A null
    text is empty.  A row with a null doc_id loses nothing and counts for
    nobody.  Rows that share a doc_id do not remove each other's bytes, and
    repeated rows come out alike.  Other columns are not read; an empty
    table gives no rows.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    gone = repeated_windows(docs, depth, buckets).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"), "runs", "whole")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"))
    both = (rows.join(gone, (rows["doc_id"].cast("long") == gone["_id"]) & (rows["text_hash"] == gone["_th"]), "left")
            .select("doc_id", "text", "runs", "whole"))

    def run(batches):
        for b in in_pieces(batches):
            cols: list[list] = [[], [], [], [], []]
            for t, runs, whole in zip(*[b.column(c).to_pylist() for c in ("text", "runs", "whole")]):
                raw = t.encode()
                left, removed, spans = raw, 0, 0
                if whole and len(raw) >= depth:
                    left, removed, spans = b"", len(raw), 1
                elif runs:
                    runs = np.frombuffer(runs, _RUN)
                    cover = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(cover, runs["at"], 1)
                    np.add.at(cover, runs["at"].astype(np.int64) + runs["n"] + depth - 1, -1)
                    out = np.cumsum(cover[:-1]) > 0
                    removed = int(out.sum())
                    spans = int((out & ~np.concatenate([[False], out[:-1]])).sum())
                    left = np.frombuffer(raw, np.uint8)[~out].tobytes()
                for c, v in zip(cols, (len(raw), removed, spans, hashlib.sha256(left).hexdigest(), left)):
                    c.append(v)
            arrays = [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_bytes:
                arrays.append(pa.array(cols[4], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names)
    return both.mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                "kept_sha256 string" + (", kept binary" if keep_bytes else ""))
