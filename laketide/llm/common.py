"""Helpers shared by the training-data operators.

Everything that is written in between goes to the shared folder of
``spark.checkpoint.dir`` (see ``laketide.session.scratch_path``), so a lost
executor costs a re-read and never a wrong or failed result.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.session import scratch_path

# The six characters the contracts call white space.
WHITE = " \t\n\x0b\x0c\r"
WHITE_BYTES = WHITE.encode()

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """What every query of this package needs of a session: Arrow batches
    that stay small whatever the text length, and the package itself on the
    executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="laketide-")) / "laketide_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))   # Spark hands it to every executor
        _shipped.add(app)


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files of a finished write are of no more use: let Spark drop
    them at the end of the write instead of at some later garbage run."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that no later plan reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def stripped(c: Column) -> Column:
    """``c`` without the six white-space characters at both ends."""
    return F.btrim(c, F.lit(WHITE))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII text takes the built-in ``lower``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, upper, upper.lower())))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.  Spark computes what a
    lambda function takes from outside again for every element, unless it is
    a column or a variable; here it is a variable."""
    return F.get(F.transform(F.array(value), body), 0)


def running_sums(arr: Column, block: int = 64) -> Column:
    """For an array of longs: the sum of all elements before each element.

    Two levels (sums inside blocks of ``block``, then sums of blocks), so a
    row with a million elements does not copy a growing array a million
    times.  An empty array gives an empty array.
    """
    def scan(a: Column) -> Column:
        # [0, a0, a0+a1, ...]: one element more than ``a``
        return F.aggregate(a, F.array(F.lit(0).cast("long")),
                           lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))

    def sums(a: Column) -> Column:
        last = F.floor((F.size(a) - 1) / F.lit(block)).cast("int")
        return let(F.transform(F.sequence(F.lit(0), last), lambda b: scan(F.slice(a, b * block + 1, block))), joined)

    def joined(blocks: Column) -> Column:
        return let(scan(F.transform(blocks, lambda b: F.element_at(b, -1))), lambda offsets: F.flatten(
            F.transform(blocks, lambda b, i: let(F.get(offsets, i), lambda before: F.transform(
                F.slice(b, F.lit(1), F.size(b) - 1), lambda x: x + before)))))
    return F.when(F.size(arr) > 0, let(arr, sums)).otherwise(F.array().cast("array<bigint>"))


def utf8(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow text column; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr, "").cast(pa.large_string())
    _, off, data = arr.buffers()
    offs = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1] if off else np.zeros(1, np.int64)
    if data is None or len(offs) < 2:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


SMALL_PIECE = 512 << 10     # of text, where every byte of it takes many of working memory


def in_pieces(batches, column: str = "text", max_bytes: int = 2 << 20):
    """Arrow batches cut so that a piece holds at most ``max_bytes`` of
    ``column``, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def memory_returned() -> None:
    """Give freed memory back to the system.  A worker lives as long as its
    executor, and what pieces of changing sizes leave between their blocks
    would add up to more with every task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator, on uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_constants(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit constants, the same in every process."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                 + np.uint64(seed)) | np.uint64(1)
