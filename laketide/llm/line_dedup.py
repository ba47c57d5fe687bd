"""Line dedup by range-partitioned hashes, in DataFrame operations.

1. Every line gives (128-bit hash of its key, document, position); the text
   stays behind.
2. These rows are range-partitioned by (hash, salt), sorted by document and
   position, and streamed: a row knows whether it is the first of its
   document and the first of all.  The salt is a hash of the document, so a
   line that every document holds is spread over all its salts; per (hash,
   salt) one row goes on, the rows of a hash are added up, and the result
   meets the lines again by (hash, salt).
3. The lines to drop come back as a compressed bitmap per document (words of
   32 lines; words without a dropped line are left out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laketide.llm.common import discard, lower_ascii, stripped, written

SALTS = 64      # a bit each in a long
WORD = 32


def line_key(line: Column) -> Column:
    return lower_ascii(stripped(line))


def line_drops(docs: DataFrame, min_docs: int = 10, keep_first: bool = False,
               min_chars: int = 1) -> DataFrame:
    """One row per document that loses lines: doc_id, text_hash, n_dropped,
    drop_bits (array<struct<word:int, bits:bigint>>, sorted; bit j of word w
    is line 32 w + j, set if it is dropped).

    A line's key is the line without white space at both ends, A-Z
    lower-cased.  Keys of at least ``min_chars`` code points that occur in
    at least ``min_docs`` documents lose all their lines, or all but the
    first by (doc_id, position) with ``keep_first``.  A null or empty text
    is one empty line.  A document is a (doc_id, text) pair: rows that
    repeat one count once, and rows with a null doc_id are told apart by
    their text (they come last).  Other columns are not read.  An empty
    table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = (docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("t"))
             .select("doc_id", "text_hash", F.posexplode(F.split("t", "\n", -1)).alias("pos", "line"))
             .withColumn("key", line_key(F.col("line")))
             .where(F.length("key") >= min_chars))
    marks = written(lines.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"),
        F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int").alias("salt"),
        "doc_id", "text_hash", "pos"), "line_marks")

    order = [F.col("doc_id").asc_nulls_last(), "text_hash", "pos"]
    stream = Window.partitionBy("h1", "h2", "salt").orderBy(*order)
    doc = F.struct("doc_id", "text_hash")
    seen = (marks.repartitionByRange("h1", "h2", "salt").sortWithinPartitions("h1", "h2", "salt", *order)
            .withColumn("new_doc", (~F.lag(doc).over(stream).eqNullSafe(doc)).cast("long")))
    place = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"),
                     F.col("text_hash").alias("t"), F.col("pos").alias("p"))
    per_salt, least = [F.sum("new_doc").alias("docs")], []
    if keep_first:
        seen = seen.withColumn("nth", F.row_number().over(stream))
        per_salt.append(F.min(F.when(F.col("nth") == 1, place)).alias("first"))
        least.append(F.min("first").alias("first"))
    # at most SALTS rows a hash; what is found goes back to the lines salt by
    # salt, so that a line of many documents is not joined in one task
    salt_bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("salt"))
    common = (seen.groupBy("h1", "h2", "salt").agg(*per_salt)
              .groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.bit_or(salt_bit).alias("salts"), *least)
              .where(F.col("docs") >= min_docs)
              .withColumn("salt", F.explode(F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)),
                                                     lambda x: F.getbit(F.col("salts"), x) == 1)))
              .drop("docs", "salts"))
    hit = marks.join(common, ["h1", "h2", "salt"])
    if keep_first:
        hit = hit.where(~place.eqNullSafe(F.col("first")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % WORD)
    # distinct positions: a repeated row must not count its lines twice
    words = (hit.groupBy("doc_id", "text_hash", F.floor(F.col("pos") / WORD).cast("int").alias("word"))
             .agg(F.bit_or(bit).alias("bits")))
    bitmaps = words.groupBy("doc_id", "text_hash").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drop_bits"))
    out = written(bitmaps, "line_drops")
    discard(marks)
    return out


def drop_lines(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """``docs`` with text without the dropped lines, and the columns
    n_lines (before) and n_dropped.  Columns of ``docs`` of these names are
    replaced; ``drops`` is the result of :func:`line_drops` on ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = drops.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"),
                     F.col("n_dropped").alias("_n"), F.col("drop_bits").alias("_bits"))
    left = docs.withColumn("_hash", F.xxhash64(text))
    both = left.join(d, left["doc_id"].eqNullSafe(d["_id"]) & (left["_hash"] == d["_th"]), "left")
    lines = F.split(text, "\n", -1)
    # dense words, so that a line finds its bit in one step
    by_word = F.map_from_entries("_bits")
    dense = F.transform(F.sequence(F.lit(0), F.element_at("_bits", -1)["word"]),
                        lambda w: F.coalesce(F.try_element_at(by_word, w), F.lit(0).cast("long")))

    def stays(_, i: Column) -> Column:
        word = F.coalesce(F.get(F.col("_dense"), F.floor(i / WORD).cast("int")), F.lit(0).cast("long"))
        return F.getbit(word, i % WORD) == 0
    kept = F.when(F.col("_n").isNull(), text).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    return (both.withColumn("_dense", F.when(F.col("_n").isNotNull(), dense))
            .withColumn("n_lines", F.size(lines).cast("long"))
            .withColumn("n_dropped", F.coalesce("_n", F.lit(0).cast("long")))
            .withColumn("text", kept)
            .drop("_hash", "_id", "_th", "_n", "_bits", "_dense"))
