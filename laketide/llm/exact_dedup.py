"""Exact dedup by content-defined chunk recipes.

The normalised text (white space deleted) is cut where a rolling hash of
the last 16 bytes hits a mask, so equal texts are cut alike.  Each chunk
gets a 64-bit provisional identifier.  The chunks themselves move once:
``distinct`` over (identifier, bytes) is combined map-side, and an
identifier that turns out to stand for two byte strings is told apart by
the rank of its bytes (verified identifiers).  Documents are then compared
by their ordered identifier lists, about 8 bytes for a kilobyte of text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laketide.llm.common import WHITE_BYTES, odd_constants, written

CHUNK_BYTES = 1024      # mean distance of cuts
MAX_CHUNK = 64 * 1024   # text without a natural cut is cut here, from the chunk's start

_GEAR = odd_constants(11, 256)


def cut_points(data: bytes, mean: int = CHUNK_BYTES, most: int = MAX_CHUNK) -> list[int]:
    """Ends of the chunks of ``data`` (the last is its length)."""
    n = len(data)
    if n == 0:
        return []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for w in (1, 2, 4, 8):              # after the step: hash of the last 2w bytes
        more = h.copy()
        more[w:] += h[:-w] << np.uint64(w)
        h = more
    cuts = np.flatnonzero((h >> np.uint64(20)) % np.uint64(mean) == 0) + 1
    ends, last = [], 0
    for c in [*cuts[(cuts >= 16) & (cuts < n)].tolist(), n]:
        while c - last > most:
            last += most
            ends.append(last)
        if c > last:
            ends.append(c)
            last = c
    return ends


def _chunks(text: str | None, bits: int):
    data = (text or "").encode().translate(None, WHITE_BYTES)
    start, mask = 0, (1 << bits) - 1
    out = []
    for end in cut_points(data):
        piece = data[start:end]
        # signed, as Spark's long
        h = xxhash.xxh64_intdigest(piece) & mask
        out.append((h - (1 << 64) if h >= 1 << 63 else h, piece))
        start = end
    return data, out


def exact_dedup(docs: DataFrame, id_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, n_chunks.

    Texts are equal when they are identical after deleting white space; of
    equal texts the longest original (code points), then the smallest
    doc_id, stays.  A null text is empty; all empty texts are one group.  A
    null doc_id comes after all others and is kept only if its group has no
    other (keep_id is then null).  Rows that repeat a doc_id with the same
    text carry the same flags.  Other columns of ``docs`` are not read.  An
    empty table gives no rows.  ``id_bits`` shortens the provisional
    identifiers (tests force collisions with it).
    """
    plain = docs.select("doc_id", "text")

    def recipes(batches):
        for b in batches:
            rows = {"doc_id": b.column("doc_id"), "n_chars": [], "text_sha256": [], "recipe": []}
            for t in b.column("text").to_pylist():
                data, chunks = _chunks(t, id_bits)
                rows["n_chars"].append(len(t or ""))
                rows["text_sha256"].append(hashlib.sha256(data).hexdigest())
                rows["recipe"].append([h for h, _ in chunks])
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"].cast(id_arrow), pa.array(rows["n_chars"], pa.int64()),
                 pa.array(rows["text_sha256"], pa.string()),
                 pa.array(rows["recipe"], pa.list_(pa.int64()))],
                ["doc_id", "n_chars", "text_sha256", "recipe"])

    def bodies(batches):
        for b in batches:
            seen: set[tuple[int, bytes]] = set()
            for t in b.column("text").to_pylist():
                seen.update(_chunks(t, id_bits)[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in seen], pa.int64()),
                 pa.array([p for _, p in seen], pa.binary())], ["h", "body"])

    id_type = plain.schema["doc_id"].dataType.simpleString()
    id_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    made = written(plain.mapInArrow(
        recipes, f"doc_id {id_type}, n_chars bigint, text_sha256 string, recipe array<bigint>"), "recipes")

    # verified identifiers: the hashes that stand for more than one text
    distinct = plain.mapInArrow(bodies, "h bigint, body binary").distinct()
    clashing = written(distinct.groupBy("h").count().where("count > 1").select("h"), "clashes")
    keys = ["recipe"]
    if not clashing.isEmpty():
        made = made.join(_told_apart(plain.select("text"), clashing, id_bits), "text_sha256", "left")
        keys.append("ranks")

    first = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("z"), "doc_id"))
    groups = made.groupBy(*keys).agg(first.alias("k"), F.count(F.lit(1)).alias("group_size"))
    g = groups.select(*[F.col(k).alias(f"g_{k}") for k in keys], F.col("k.doc_id").alias("keep_id"), "group_size")
    same = F.lit(True)
    for k in keys:
        same = same & (made[k].eqNullSafe(g[f"g_{k}"]) if k == "ranks" else made[k] == g[f"g_{k}"])
    return made.join(g, same).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", F.size("recipe").alias("n_chunks"))


def _places(bits: int):
    def places(batches):
        for b in batches:
            shas, pos, hs, parts = [], [], [], []
            for t in b.column("text").to_pylist():
                data, chunks = _chunks(t, bits)
                sha = hashlib.sha256(data).hexdigest()
                for p, (h, piece) in enumerate(chunks):
                    shas.append(sha)
                    pos.append(p)
                    hs.append(h)
                    parts.append(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shas, pa.string()), pa.array(pos, pa.int32()), pa.array(hs, pa.int64()),
                 pa.array(parts, pa.binary())], ["text_sha256", "pos", "h", "body"])
    return places


def _told_apart(texts: DataFrame, clashing: DataFrame, bits: int) -> DataFrame:
    """For the texts with a chunk whose provisional identifier clashes: the
    rank of the bytes among those with this identifier, in text order."""
    at = (texts.mapInArrow(_places(bits), "text_sha256 string, pos int, h bigint, body binary")
          .join(clashing, "h").distinct())
    ranked = (at.select("h", "body").distinct()
              .withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("body"))))
    return (at.join(ranked, ["h", "body"]).groupBy("text_sha256")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "rank"))).alias("ranks")))
