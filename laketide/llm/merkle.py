"""Merkle manifest of a dataset, by time-forward processing.

Every row is a leaf.  The leaves of a group (a source) form a tree of runs of
``ARITY`` nodes, the groups' roots form one more tree.  A node's label is
(level, index); children have smaller labels than their parent.  Digests
travel forward in label order through a priority queue, from children to
parents, and the same sweep backwards hands every node the proof suffix of
its parent.

The queue is external: a block of ``ARITY ** levels`` consecutive nodes lies in one
task's heap, and between blocks Spark's sorted shuffle delivers the digests
of blocks, as the nodes of the next stage, in label order.  A tree of n
leaves takes one stage for every ``levels`` of its levels.  Nothing depends on the size of a
group: leaves are ranked by ranges of rows, and no node has more than a block
of children at a stage.
"""

from __future__ import annotations

import hashlib
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laketide.llm.common import discard, written

ARITY = 3
LEVELS = 7      # of a block: 2,187 nodes

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: lowercase hex sha256 of its fields."""
    return _digest(F.concat(*[field(v) for v in values]))


def _levels(n: int) -> int:
    """Levels of a tree over n nodes."""
    levels, width = 0, 1
    while width < n:
        levels, width = levels + 1, width * ARITY
    return levels


def sweep(digests: list[str], levels: int) -> tuple[str, list[str]]:
    """(digest of the top node, proof of every digest) of one block, whose
    nodes are combined over ``levels`` levels.

    A proof is the runs from the bottom to the top, joined by ``/``; a run is
    the digests of the siblings with ``.`` at the node's own place.
    """
    queue = [(0, i, d) for i, d in enumerate(digests)]
    heapify(queue)
    runs: list[tuple[int, int, list[str]]] = []
    while queue[0][0] < levels:
        level, i, d = heappop(queue)
        run = [d]
        while queue and queue[0][0] == level and queue[0][1] // ARITY == i // ARITY:
            run.append(heappop(queue)[2])
        runs.append((level + 1, i // ARITY, run))
        heappush(queue, (level + 1, i // ARITY, hashlib.sha256("".join(run).encode()).hexdigest()))
    suffix = {(levels, 0): ""}
    for level, i, run in reversed(runs):
        above = suffix.pop((level, i))
        above = "/" + above if above else ""
        for place in range(len(run)):
            suffix[level - 1, i * ARITY + place] = "".join(run[:place]) + "." + "".join(run[place + 1:]) + above
    return queue[0][2], [suffix[0, i] for i in range(len(digests))]


_STAGE = "grp string, pos bigint, n bigint, digest string, proof string, top string"


def _stage(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (grp, pos, n: nodes of the group, digest) with their proof
    inside their block and the block's digest (top)."""
    size_of = ARITY ** levels

    def run(batches):
        def done():
            top, proofs = sweep(part["digest"], min(levels, _levels(part["n"][0])))
            size = len(proofs)
            return pa.RecordBatch.from_arrays(
                [pa.array(part["grp"]), pa.array(part["pos"], pa.int64()), pa.array(part["n"], pa.int64()),
                 pa.array(part["digest"]), pa.array(proofs, pa.string()), pa.array([top] * size, pa.string())],
                ["grp", "pos", "n", "digest", "proof", "top"])
        part: dict[str, list] = {}
        last = None
        for batch in batches:
            rows = batch.to_pydict()
            for grp, pos, n, digest in zip(*[rows[c] for c in ("grp", "pos", "n", "digest")]):
                key = (grp, pos // size_of)
                if key != last:
                    if last is not None:
                        yield done()
                    part, last = {"grp": [], "pos": [], "n": [], "digest": []}, key
                for c, x in zip(("grp", "pos", "n", "digest"), (grp, pos, n, digest)):
                    part[c].append(x)
        if last is not None:
            yield done()
    block = F.floor(F.col("pos") / size_of)
    return (nodes.select("grp", "pos", "n", "digest").repartition(F.col("grp"), block)
            .sortWithinPartitions("grp", "pos").mapInArrow(run, _STAGE))


def ranked(rows: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with a column grp) with ``pos``, the place in its group by
    the columns ``order``, and ``n``, the rows of the group; and the written
    table below.  Rows are dealt by ranges, so a group may be of any size;
    only the counts of (group, range) are summed up."""
    # ranges are cut by the first column and the start of the second, a
    # digest: what Spark samples of a row to place the cuts stays small
    cut = [F.col(order[0]), *[F.substring(c, 1, 8) for c in order[1:2]]]
    dealt = (rows.repartitionByRange("grp", *cut).sortWithinPartitions("grp", *order)
             .withColumn("_at", F.monotonically_increasing_id()))
    placed = written(dealt, "ranked")
    with_part = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = with_part.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("grp").orderBy("_part")
    before = F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = parts.select("grp", "_part", "_first", before.alias("_before"),
                         F.sum("_c").over(Window.partitionBy("grp")).alias("n"))
    out = (with_part.join(heads, ["grp", "_part"])
           .withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first"))
           .drop("_at", "_part", "_first", "_before"))
    return out, placed


def _tree(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Written stages of the groups' trees, from the leaves up.  The last one
    holds one block a group."""
    block = ARITY ** levels
    stages = [written(_stage(nodes, levels), "merkle_stage")]
    most = stages[0].agg(F.max("n").alias("m")).first()["m"] or 0
    while most > block:
        heads = stages[-1].where(F.col("pos") % block == 0).select(
            "grp", F.floor(F.col("pos") / block).alias("pos"), F.ceil(F.col("n") / block).alias("n"),
            F.col("top").alias("digest"))
        stages.append(written(_stage(heads, levels), "merkle_stage"))
        most = -(-most // block)
    return stages


def _joined(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda p: p != ""), "/")


def _handed_down(stages: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """The reversed sweep: (grp, pos, digest, proof, *rest) of the lowest
    stage, ``tops`` (grp, suffix, *rest) being what stands above the groups.
    A parent hands its suffix to at most a block of children."""
    rest = [c for c in tops.columns if c not in ("grp", "suffix")]
    above = tops.withColumn("_p", F.lit(0).cast("bigint")).withColumnRenamed("grp", "_g")
    for stage in reversed(stages):
        below = stage.withColumn("_block", F.floor(F.col("pos") / ARITY ** levels))
        done = (below.join(above, (below["grp"] == above["_g"]) & (below["_block"] == above["_p"]))
                .select("grp", "pos", "digest", _joined(F.col("proof"), F.col("suffix")).alias("suffix"), *rest))
        above = done.withColumnRenamed("grp", "_g").withColumnRenamed("pos", "_p").drop("digest")
    return done.withColumnRenamed("suffix", "proof")


def group_key(group: Column) -> Column:
    """Text that orders as the group does, null first, then by UTF-8 bytes."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("g"), group.cast("string")))


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "source", order: str = "doc_id",
             also: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: the column ``order``, ``leaf``, ``subroot``
    (of its group), ``root``, ``proof``, and the columns ``also``
    (expressions over ``docs``, such as the leaf of a received copy).

    The digest of a leaf covers ``columns`` in this order; null and empty
    values differ.  The leaves of a group ascend by ``order``, nulls first,
    equal ones by digest and then by ``also``; so repeated rows have each
    their place.  A lone leaf is its group's root, a lone group's root is
    ``root``; ``proof`` then has fewer runs or is empty.  :func:`fold` and
    :func:`siblings` read a proof.  Texts of any length are hashed by Spark
    and go no further.  Other columns are not read, whatever their names; an
    empty table gives no rows.
    """
    also = also or {}
    leaves = docs.select(
        group_key(docs[group]).alias("grp"), docs[order].alias("_order"),
        leaf_digest(*[docs[c] for c in columns]).alias("digest"),
        *[c.alias(f"_also_{name}") for name, c in also.items()])
    kept = [f"_also_{name}" for name in also]
    hashed = written(leaves, "merkle_hashes")       # placing the ranges reads it twice
    nodes, placed = ranked(hashed, "_order", "digest", *kept)
    nodes = written(nodes, "merkle_leaves")
    discard(hashed, placed)
    stages = _tree(nodes, levels)
    subroots = stages[-1].where("pos = 0").select(F.lit("all").alias("grp"), F.col("grp").alias("_source"),
                                                  F.col("top").alias("digest"))
    sources, placed = ranked(subroots, "_source")
    sources = written(sources, "merkle_sources")
    discard(placed)
    upper = _tree(sources, levels)
    root = upper[-1].where("pos = 0").select("grp", F.lit("").alias("suffix"), F.col("top").alias("root"))
    of_sources = _handed_down(upper, root, levels)
    tops = (sources.select("grp", "pos", "_source").join(of_sources, ["grp", "pos"])
            .select(F.col("_source").alias("grp"), F.col("proof").alias("suffix"), F.col("digest").alias("subroot"),
                    "root"))
    proofs = _handed_down(stages, tops, levels)
    done = (nodes.select("grp", "pos", "_order", *kept).join(proofs, ["grp", "pos"])
            .select(F.col("_order").alias(order), F.col("digest").alias("leaf"), "subroot", "root", "proof",
                    *[F.col(f"_also_{name}").alias(name) for name in also]))
    return done


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof, from the bottom up, left to right."""
    return F.translate(proof, "./", "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    def step(acc, run):
        return F.when(run == "", acc).otherwise(_digest(F.replace(run, F.lit("."), acc)))
    return F.aggregate(F.split(proof, "/"), leaf, step)
