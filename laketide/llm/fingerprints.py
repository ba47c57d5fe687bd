"""One-permutation MinHash fingerprints with optimal densification.

Every shingle is hashed once; the top bits pick one of ``BINS`` bins and
the smallest hash of a bin is its value.  An empty bin takes the value of
the first filled bin on its own fixed random probe sequence, the same for
all texts (optimal densification).  Of each value ``BITS`` low bits are
stored.  Two unrelated bins agree by chance with probability 2**-BITS, so
the likeness is (agreement - 2**-BITS) / (1 - 2**-BITS), not below 0.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import SMALL_PIECE, in_pieces, let, mixed, utf8, written
from laketide.llm.shingles import shingle_hashes
from laketide.llm.words import forget

BINS = 256
BITS = 4
WORDS = 5


def fingerprints(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> np.ndarray:
    """(texts, BINS) array of BITS-bit values; texts without a word get zeros."""
    n = len(offsets) - 1
    hashes, ends = shingle_hashes(data, offsets, words)
    out = np.zeros((n, BINS), np.uint8)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    full = np.uint64(1 << 40)
    values = np.full((n, BINS), full, np.uint64)
    # sort by (text, bin, value): the first of each bin is its minimum
    step = 4096
    for a in range(0, n, step):
        b = min(n, a + step)
        h = hashes[ends[a]:ends[b]]
        if not len(h):
            continue
        owner = np.repeat(np.arange(b - a, dtype=np.uint64), np.diff(ends[a:b + 1]))
        cell = owner * np.uint64(BINS) + (h >> shift)
        key = np.sort((cell << np.uint64(40)) | (h & np.uint64((1 << 40) - 1)))
        cell = key >> np.uint64(40)
        first = np.ones(len(key), bool)
        first[1:] = cell[1:] != cell[:-1]
        values[a:b].reshape(-1)[cell[first].astype(np.int64)] = key[first] & np.uint64((1 << 40) - 1)
    filled = values != full
    some = filled.any(axis=1)
    doc, at = np.nonzero(~filled & some[:, None])
    probe = 1
    while len(doc):
        target = (mixed((at * 65536 + probe).astype(np.uint64)) % np.uint64(BINS)).astype(np.int64)
        if probe > 16 * BINS:           # not reached in practice; ends the search for certain
            target = (at + probe) % BINS
        hit = filled[doc, target]
        values[doc[hit], at[hit]] = values[doc[hit], target[hit]]
        doc, at = doc[~hit], at[~hit]
        probe += 1
    # each bin mixes the value before it is cut to its low bits: otherwise the
    # bins of a text with few shingles, copies of few values, agree by chance
    # all together
    turned = mixed(values[some] + mixed(np.arange(1, BINS + 1, dtype=np.uint64)))
    out[some] = (turned & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return out


def packed(prints: np.ndarray) -> pa.Array:
    """Fingerprints as hex text, one digit for each bin."""
    pairs = (prints[:, ::2] << 4) | prints[:, 1::2]
    return pa.array([p.tobytes().hex() for p in pairs], pa.string())


def likeness(a: np.ndarray, b: np.ndarray, a_empty, b_empty) -> np.ndarray:
    """Row-wise estimates of the Jaccard similarity, corrected for chance."""
    chance = 2.0 ** -BITS
    est = np.clip(((a == b).mean(axis=-1) - chance) / (1 - chance), 0.0, 1.0)
    return np.where(a_empty | b_empty, (a_empty & b_empty).astype(float), est)


def _texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pa.array(texts, pa.large_string()))


def _marks(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    data, offs = _texts(texts)
    prints = fingerprints(data, offs, words)
    empty = np.array([not t or t.isspace() and not t.strip(" \t\n\x0b\x0c\r") for t in texts])
    return prints, empty


def fingerprint(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex).

    A null text is empty; a text without words has the fingerprint of zeros.
    Equal texts have equal fingerprints.  Other columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in in_pieces(batches, max_bytes=SMALL_PIECE):
            prints = fingerprints(*utf8(b.column("text")), words)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), packed(prints)],
                                             ["doc_id", "fingerprint"])
        forget()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, fingerprint string")


_OUT = ("doc_id {id}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
# distinct ids sampled, about, for the bounds of the ranges (the only thing
# they decide is how even the ranges are)
BOUND_SAMPLE = 20_000


def compare_neighbours(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and the likeness
    of its fingerprint to the edited text's and to the next document's.

    The next document is the one with the next doc_id (ties by text; nulls
    last; after the last row comes the first).  The edited text has its last
    floor(n/2) code points replaced by the next text's first as many.  One
    row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  Null counts as empty; two
    texts without words have likeness 1, one without and one with 0.  A
    single row is its own next.  Other columns are not read; an empty table
    gives no rows.

    Rows are dealt by ranges of doc_id with fixed bounds, sorted and
    streamed.  The first row of every range is found beforehand, by a
    map-side minimum, and stands at the end of the range before it, so that
    every row meets its next in its own task; texts move once.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.select("doc_id").where("doc_id is not null")
    # a threshold on the ids' hashes: about as many reach the driver at any size
    share = min(1.0, BOUND_SAMPLE / max(1, ids.count()))
    limit = min(2 ** 63 - 1, int((share * 2 - 1) * 2 ** 63))
    some = ids.where(F.xxhash64("doc_id") <= F.lit(limit)).distinct()
    some = sorted(r.doc_id for r in some.collect())
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted({some[i * len(some) // ranges] for i in range(1, ranges)}) if some else []
    table = spark.createDataFrame([(bounds,)], f"bounds array<{id_type}>")
    part = _rank(F.col("doc_id"), F.col("bounds"), len(bounds)) if bounds else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(part)
    rows = docs.select("doc_id", "text", table.scalar().alias("bounds"))
    rows = rows.select(part.cast("int").alias("part"), F.col("doc_id").isNull().alias("z"), "doc_id",
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    heads = written(rows.groupBy("part").agg(F.min(F.struct("z", "doc_id", "text")).alias("h"))
                    .select("part", "h.z", "h.doc_id", "h.text"), "range_heads")
    parts = sorted(r.part for r in heads.select("part").collect())      # one number a range
    before = spark.createDataFrame(list(zip(parts, parts[-1:] + parts[:-1])), "part int, previous int")
    heads = heads.join(before, "part").select(F.col("previous").alias("part"), "z", "doc_id", "text")
    both = (rows.withColumn("ghost", F.lit(False)).unionByName(heads.withColumn("ghost", F.lit(True)))
            .repartition("part").sortWithinPartitions("part", "ghost", "z", "doc_id", "text")
            .select("doc_id", "text", "ghost"))

    def run(batches):
        held_id, held = None, None          # the last row, still without its next
        for b in in_pieces(batches, max_bytes=SMALL_PIECE):
            texts, ghost = b.column("text").to_pylist(), b.column("ghost").to_pylist()
            ids = b.column("doc_id").to_pylist()
            if held is not None:
                ids, texts, ghost = [held_id, *ids], [held, *texts], [False, *ghost]
            at = [i for i in range(len(texts) - 1) if not ghost[i]]
            if at:
                yield _compared(ids, texts, at, words, b.schema.field("doc_id").type)
            held_id, held = (ids[-1], texts[-1]) if not ghost[-1] else (None, None)
        forget()
    return both.mapInArrow(run, _OUT.format(id=id_type))


def _rank(c: Column, bounds: Column, n: int) -> Column:
    """Number of the ``n`` elements of the sorted array ``bounds`` that are
    not above ``c``: a binary search in halving steps, an expression of the
    same size whatever ``n``."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    return let(F.struct(bounds.alias("b"), c.alias("c")), lambda v: F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(v["b"], at + step - 1) <= v["c"], at + step).otherwise(at)))


def _compared(ids, texts, at, words, id_type) -> pa.RecordBatch:
    """The rows at the positions ``at``, each with the row after it."""
    edited = []
    for i in at:
        half = len(texts[i]) // 2
        edited.append(texts[i][:len(texts[i]) - half] + texts[i + 1][:half])
    prints, empty = _marks(texts, words)
    theirs, theirs_empty = _marks(edited, words)
    at = np.array(at)
    mine, mine_empty = prints[at], empty[at]
    return pa.RecordBatch.from_arrays(
        [pa.array([ids[i] for i in at], id_type), pa.array([len(texts[i]) for i in at], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), packed(mine), packed(theirs),
         pa.array(likeness(mine, theirs, mine_empty, theirs_empty)),
         pa.array(likeness(mine, prints[at + 1], mine_empty, empty[at + 1]))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def likeness_of(a: Column, b: Column) -> Column:
    """Likeness of two hex fingerprints as a Spark expression (for joins on
    stored fingerprints of texts with words)."""
    chance = 2.0 ** -BITS
    width = BITS // 4
    same = F.aggregate(F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0),
                       lambda acc, i: acc + (F.substr(a, i * width + 1, F.lit(width))
                                             == F.substr(b, i * width + 1, F.lit(width))).cast("int"))
    return F.greatest(F.lit(0.0), (same / F.lit(BINS) - chance) / (1 - chance))
