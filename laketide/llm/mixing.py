"""Temperature mixing of sources to target weights, in DataFrame operations.

1. Tokens (words) are counted per source; a source's share is its part.
2. Weights are shares to the power ``alpha``, normalised.  ``alpha`` is
   bisected: it meets an entropy between that of the shares (alpha 1) and
   that of equal weights (alpha 0), and rises further until no source is
   repeated more often than allowed.
3. The weights are realised by block permutations: a document's key (a hash
   of its id) puts it into one of ``BLOCKS`` blocks of its source, a
   source's blocks have a permuted order, whole epochs take all blocks, and
   the last epoch takes blocks in this order until the budget is met.  Of
   the block in which the budget ends, a million parts are gone through by
   their sums, and only the part in which it ends document by document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laketide.llm.common import discard, written

BLOCKS = 256
PART_SHIFT = 32     # a block's keys fall into 2 ** 20 parts
STEPS = 40
FAN = 32        # exponents tried in one pass: five halvings
_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """``entropy``: position between the entropy of the shares (0) and of
    equal weights (1).  ``max_epochs``: repetition limit.  ``cover``: take
    the smallest budget that holds every source at least once; otherwise
    ``budget`` (tokens; None: all tokens of the input) is spent."""

    entropy: float = 0.5
    max_epochs: float = 4.0
    cover: bool = False
    budget: int | None = None


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("long")


def block_key(doc_id: Column) -> Column:
    """60 bits of the md5 of the id; a null id counts as empty."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def block_of(key: Column) -> Column:
    return F.shiftright(key, 52).cast("int")


def block_rank(source: Column, block: Column) -> Column:
    """Sort key of a block in its source's permutation."""
    return F.md5(F.concat_ws(":", source, block.cast("string")).cast("binary"))


def _at(shares: DataFrame, alphas: list[float]) -> dict[float, dict]:
    """Entropy and most epochs for several exponents, in one pass over the
    sources.  Sums are taken over logarithms moved by the largest share, so
    no power underflows for all sources."""
    # p = e^x with x <= 0; weight = e^(alpha x) / z
    grid = shares.select("x", "p", F.explode(F.array(*[F.lit(float(a)) for a in alphas])).alias("alpha"))
    e = F.exp(F.col("alpha") * F.col("x"))
    rows = (grid.groupBy("alpha").agg(
        F.sum(e).alias("z"), F.sum(e * F.col("alpha") * F.col("x")).alias("zx"),
        F.max(e / F.col("p")).alias("most"), F.min(e / F.col("p")).alias("least")).collect())
    return {r.alpha: {"entropy": _entropy(r.z, r.zx), "epochs": r.most / r.z, "spread": r.most / r.least}
            for r in rows}


def _entropy(z: float, zx: float) -> float:
    import math
    return math.log(z) - zx / z


def bisect(shares: DataFrame, good, lo: float = 0.0, hi: float = 1.0) -> float:
    """Smallest exponent in [lo, hi] (to 2**-STEPS) for which ``good`` holds,
    which it does from some exponent on; ``hi`` if for none below."""
    if good(_at(shares, [lo])[lo]):
        return lo
    for _ in range(STEPS // 5):
        grid = [lo + (hi - lo) * i / FAN for i in range(1, FAN)]
        facts = _at(shares, grid)
        ok = [a for a in grid if good(facts[a])]
        first = min(ok, default=hi)
        lo, hi = max([a for a in grid if a < first], default=lo), first
    return hi


def weights(per_source: DataFrame, target: Target) -> DataFrame:
    """(source, tokens, weight, quota) of every source with tokens; quota is
    the source's tokens in the mixture.  The exponent is rounded up to six
    decimals, so that it does not hang on the order of a sum."""
    import math
    facts = per_source.agg(F.sum("tokens").alias("t"), F.max("tokens").alias("m"), F.count(F.lit(1)).alias("n")).first()
    if not facts.n:
        return per_source.select("source", "tokens", F.lit(0.0).alias("weight"), F.lit(0.0).alias("quota"))
    total = float(facts.t)
    shares = per_source.select("source", "tokens", (F.col("tokens") / F.lit(total)).alias("p"),
                               F.log(F.col("tokens") / F.lit(float(facts.m))).alias("x"))
    shares = written(shares, "shares")
    ends = _at(shares, [0.0, 1.0])
    wanted = ends[1.0]["entropy"] + target.entropy * (ends[0.0]["entropy"] - ends[1.0]["entropy"])
    budget = target.budget or facts.t

    def allowed(f: dict) -> bool:
        most = f["spread"] if target.cover else f["epochs"] * budget / total
        return f["entropy"] <= wanted + 1e-12 and most <= max(target.max_epochs, 1.0, budget / total)
    alpha = math.ceil(bisect(shares, allowed) * 1e6 - 1e-3) / 1e6
    e = F.exp(F.lit(alpha) * F.col("x"))
    sums = shares.agg(F.sum(e).alias("z"), F.max(F.col("tokens") / e).alias("r")).first()
    scale = sums.r if target.cover else budget / sums.z
    return shares.select("source", "tokens", (e / F.lit(sums.z)).alias("weight"),
                         F.round(e * F.lit(float(scale)), 3).alias("quota"))


def copies(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, n_tokens, source_weight,
    copies (how often the document stands in the mixture, 0 or more).

    A null source is a source of its own, equal to no text; a source without
    tokens has weight 0 and keeps one copy of its rows.  A null doc_id and
    repeated ids get equal keys and so stand in one block.  Every source's
    tokens are within one document of its quota.  An empty table gives no
    rows; other columns are not read.
    """
    source = F.coalesce(F.concat(F.lit("s:"), F.col("source").cast("string")), F.lit("null"))
    made = written(docs.select("doc_id", F.col("source").alias("given"), source.alias("source"),
                               token_count(F.col("text")).alias("n_tokens"), block_key(F.col("doc_id")).alias("key")),
                   "tokens").withColumn("block", block_of(F.col("key")))
    plan = _plan(made, target)
    return _placed(made, plan).select("doc_id", F.col("given").alias("source"), "n_tokens", "source_weight", "copies")


def _plan(made: DataFrame, target: Target) -> DataFrame:
    """(source, source_weight, epochs, edge_rank, edge_key): blocks ranked
    before edge_rank are in the last epoch, and of the block at edge_rank the
    documents up to edge_key."""
    blocks = written(made.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "blocks")
    per_source = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    quotas = weights(per_source, target)
    epochs = F.floor(F.col("quota") / F.col("total")).cast("long")
    q = written(quotas.select("source", F.col("tokens").alias("total"), F.col("weight").alias("source_weight"), "quota")
                .withColumn("epochs", epochs)
                .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("total")), "quotas")
    # at most BLOCKS rows a source
    run = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (blocks.join(q.select("source", "rest"), "source")
              .withColumn("rank", block_rank(F.col("source"), F.col("block")))
              .withColumn("before", F.coalesce(F.sum("tokens").over(run), F.lit(0))))
    edge = (ranked.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("tokens") > F.col("rest")))
            .select("source", "block", F.col("rank").alias("edge_rank"), (F.col("rest") - F.col("before")).alias("room")))
    # the block in which the budget ends: by parts of its keys, then by the
    # keys of one part, so that no window grows with the documents of a block
    part = F.shiftright("key", PART_SHIFT)
    parts = (made.join(edge.select("source", "block", "room"), ["source", "block"])
             .groupBy("source", part.alias("part"))
             .agg(F.sum("n_tokens").alias("tokens"), F.first("room").alias("room")))
    in_order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = (parts.withColumn("before", F.coalesce(F.sum("tokens").over(in_order), F.lit(0)))
            .where((F.col("before") <= F.col("room")) & (F.col("before") + F.col("tokens") > F.col("room")))
            .select("source", "part", (F.col("room") - F.col("before")).alias("room")))
    inside = Window.partitionBy("source", "part").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    upto = (made.withColumn("part", part).join(ends, ["source", "part"])
            # documents of one key go together
            .groupBy("source", "part", "key").agg(F.sum("n_tokens").alias("n_tokens"), F.first("room").alias("room"))
            .withColumn("through", F.sum("n_tokens").over(inside)))
    # without a key that fits, all keys before the part are taken
    before_part = F.shiftleft(F.col("part"), PART_SHIFT) - 1
    edge_key = (upto.withColumn("fits", F.when(F.col("through") <= F.col("room"), F.col("key")))
                .groupBy("source", "part").agg(F.max("fits").alias("fits"))
                .select("source", F.coalesce("fits", before_part).alias("edge_key")))
    return (q.select("source", "source_weight", "epochs")
            .join(edge.select("source", "edge_rank"), "source", "left").join(edge_key, "source", "left"))


def _placed(made: DataFrame, plan: DataFrame) -> DataFrame:
    rank = block_rank(F.col("source"), F.col("block"))
    last = (rank < F.col("edge_rank")) | ((rank == F.col("edge_rank"))
                                          & (F.col("key") <= F.coalesce("edge_key", F.lit(-1))))
    joined = made.join(written(plan, "plan"), "source", "left")
    return (joined.withColumn("source_weight", F.coalesce("source_weight", F.lit(0.0)))
            .withColumn("copies", F.when(F.col("epochs").isNull(), F.lit(1).cast("long"))
                        .otherwise(F.col("epochs") + F.coalesce(last, F.lit(False)).cast("long"))))


def mix(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """The mixture: rows of ``docs`` with all their columns, each as often as
    :func:`copies` says.  Clashing column names do not matter: the plan is
    joined under names of its own."""
    source = F.coalesce(F.concat(F.lit("s:"), F.col("source").cast("string")), F.lit("null"))
    slim = written(docs.select(source.alias("source"), token_count(F.col("text")).alias("n_tokens"),
                               block_key(F.col("doc_id")).alias("key")), "tokens")
    plan = written(_plan(slim.withColumn("block", block_of(F.col("key"))), target), "plan")
    discard(slim)
    p = plan.select(*[F.col(c).alias(f"_plan_{c}") for c in plan.columns])
    both = docs.withColumn("_plan_key", block_key(F.col("doc_id"))).join(p, source == F.col("_plan_source"), "left")
    rank = block_rank(F.col("_plan_source"), block_of(F.col("_plan_key")))
    last = (rank < F.col("_plan_edge_rank")) | ((rank == F.col("_plan_edge_rank"))
                                                & (F.col("_plan_key") <= F.coalesce("_plan_edge_key", F.lit(-1))))
    n = F.coalesce(F.col("_plan_epochs") + F.coalesce(last, F.lit(False)).cast("long"), F.lit(1).cast("long"))
    again = F.explode(F.array_repeat(F.lit(0), n.cast("int")))
    return both.withColumn("_plan_again", again).select(*[F.col(c) for c in docs.columns])
