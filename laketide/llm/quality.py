"""Quality by nearest-neighbour voting in a latent semantic space.

Terms are shape trigrams of a text: every character is read as its class
(upper-case, lower-case, digit, space, line feed, each punctuation sign by
itself), and three classes in a row are a term; a few terms count repeated
words.  A bounded sample of labelled texts gives term weights and a
truncated singular value decomposition.  Its vectors, at most
``SAMPLE * DIMS`` numbers, are broadcast.  Every document is projected, its
cosine to every labelled vector is computed exactly in blocks of documents,
and its ``NEIGHBOURS`` nearest vote, weighted by similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laketide.llm.common import in_pieces, utf8
from laketide.llm.shingles import word_hashes
from laketide.llm.words import forget

SAMPLE = 3000        # labelled rows learned from, at most half of each label
DIMS = 48
NEIGHBOURS = 15
BLOCK = 512          # documents of one cosine product
STRETCH = 2000       # words among which repeats are counted

# classes: 0 upper, 1 lower or beyond ASCII, 2 digit, 3 blank, 4 line feed,
# 5 control, 6 and up a punctuation sign each
_CLASS = np.ones(256, np.int32)
_CLASS[:32] = 5
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[10] = 4
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_SIGNS] = 6 + np.arange(len(_SIGNS))
_CLASS[48:58] = 2
_CLASS[65:91] = 0
_CLASS[97:123] = 1
_CLASS[127] = 5
_N_CLASSES = 6 + len(_SIGNS)
_TERMS = 4096
EXTRA = 4
WIDTH = _TERMS + EXTRA


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, WIDTH) float32: log of the term rates per 1,000 characters.
    Any text, also an empty one, has a row."""
    n = len(offsets) - 1
    out = np.zeros((n, WIDTH), np.float32)
    kind = _CLASS[data]
    if len(data) >= 3:
        code = (kind[:-2] * _N_CLASSES + kind[1:-1]) * _N_CLASSES + kind[2:]
        term = ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype(np.int64)
    words, counts = word_hashes(data, offsets)
    begin = np.concatenate([[0], np.cumsum(counts)])
    for i in range(n):
        a, b = offsets[i], offsets[i + 1]
        if b - a >= 3:
            seen = np.bincount(term[a:b - 2], minlength=_TERMS)
            out[i, :_TERMS] = np.log1p(seen * np.float32(1000.0 / (b - a)))
        own = words[begin[i]:begin[i + 1]]
        w = len(own)
        if w:
            same = np.count_nonzero(own[1:] == own[:-1])
            # distinct words of every stretch, so that length alone is no repetition
            distinct = sum(len(np.unique(own[x:x + STRETCH])) for x in range(0, w, STRETCH))
            out[i, _TERMS:] = (4 * same / w, 2 * (1 - distinct / w),
                               0.5 * np.log1p((b - a) / w), 0.1 * np.log1p(w))
    return out


class Model:
    """Projection and labelled vectors; sizes are bounded by SAMPLE."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, dims: int = DIMS, k: int = NEIGHBOURS):
        n = len(labels)
        self.labels = labels.astype(np.float64)
        self.k = min(k, n)
        if n == 0:
            return
        there = (counts > 0).sum(axis=0)
        self.idf = (np.log((1 + n) / (1 + there)) + 0.1).astype(np.float32)
        self.idf[_TERMS:] = 1.0
        x = counts * self.idf
        dims = min(dims, n, WIDTH)
        # randomised range finder with power steps, seeded
        q = np.random.default_rng(7).standard_normal((x.shape[1], dims + 16)).astype(np.float32)
        for _ in range(4):
            q, _ = np.linalg.qr(x.T @ (x @ q))
        _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
        self.base = (q @ vt[:dims].T).astype(np.float32)
        self.vectors = _unit(x @ self.base)
        bare = ~counts.any(axis=1)
        self.bare = float(self.labels[bare].mean() if bare.any() else self.labels.mean())

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by similarity; 0.5
        without any labelled row.  A text without terms is near to none: it
        takes the share among the labelled texts without terms, or among all
        if there are none."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        out = np.empty(len(counts))
        for a in range(0, len(counts), BLOCK):
            v = _unit((counts[a:a + BLOCK] * self.idf) @ self.base)
            cos = v @ self.vectors.T
            near = np.argpartition(-cos, self.k - 1, axis=1)[:, :self.k]
            w = np.maximum(np.take_along_axis(cos, near, axis=1).astype(np.float64), 0) ** 8 + 1e-9
            vote = (w * self.labels[near]).sum(axis=1) / w.sum(axis=1)
            out[a:a + BLOCK] = np.where(counts[a:a + BLOCK].any(axis=1), vote, self.bare)
        return out


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return (v / np.where(norm > 0, norm, 1)).astype(np.float32)


def _features_frame(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in in_pieces(batches):
            f = features(*utf8(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), pa.array([r.tobytes() for r in f], pa.binary())], ["label", "counts"])
        forget()
    return docs.select("label", "text").mapInArrow(run, "label int, counts binary")


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from: crc32(doc_id as text) mod 3
    is 1.  A null doc_id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of at most ``sample`` labelled rows outside the held-out
    third, half of each label at most, taken in the order of a hash of the
    doc_id.  Null labels and null ids are ignored; a doc_id with several
    labels takes the largest."""
    usable = (labels.where("quality in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")))
    # labelled rows without a document are no use: the join goes first, on ids
    known = usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = F.xxhash64("doc_id")
    picked = [known.where(F.col("label") == x).orderBy(order, "doc_id").limit(sample // 2) for x in (0, 1)]
    # at most ``sample`` rows of two numbers: a proven bound for a broadcast
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"])
    rows = _features_frame(texts.orderBy(order, "doc_id")).limit(sample).collect()
    counts = (np.stack([np.frombuffer(r.counts, np.float32) for r in rows])
              if rows else np.zeros((0, WIDTH), np.float32))
    return Model(counts, np.array([r.label for r in rows]))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with one more column, the score (0 to 1, higher: label 1 is
    likelier; a column of its name is replaced).  Only ``text`` is read for
    it; null counts as empty; repeated rows score alike; an empty table
    gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.drop(column)

    def run(batches):
        m = shared.value
        for b in in_pieces(batches):
            s = m.score(features(*utf8(b.column("text"))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*b.schema.names, column])
        forget()
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField(column, T.DoubleType())]))
