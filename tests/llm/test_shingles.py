"""Word and shingle identity, and long inputs in linear time."""

import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from laketide.llm import chat, near_dedup, shingles
from laketide.llm.common import running_sums
from laketide.llm.words import _known, words_of


def pieces(texts):
    data = [t.encode() for t in texts]
    return (np.frombuffer(b"".join(data), np.uint8),
            np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64))


def test_words_of_a_piece(monkeypatch):
    rng = random.Random(3)
    texts = ["", "one", " \t", "End", "edge", *("".join(rng.choice("aBé \n\x0b\x1f") for _ in range(rng.randrange(60)))
                                               for _ in range(200)), "x" * 90, ""]
    for size in (4, 64, 4 << 20):
        monkeypatch.setattr(shingles, "STRETCH", size)
        hashes, counts = shingles.word_hashes(*pieces(texts))
        want = [words_of(t) for t in texts]
        assert counts.tolist() == [len(w) for w in want]
        assert hashes.tolist() == [_known[w] for ws in want for w in ws]
    hashes, ends = shingles.shingle_hashes(*pieces([]), 3)
    assert len(hashes) == 0 and ends.tolist() == [0]


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_complementary_words_stay_apart(spark):
    """These two words have equal polynomial hashes modulo 2^64, whatever the
    base."""
    a, b = thue_morse(2048, "ab"), thue_morse(2048, "ba")
    assert len(set(shingles.word_hashes(*pieces([a, b]))[0].tolist())) == 2
    docs = spark.createDataFrame([(1, a), (2, b), (3, a), (4, f"x y {a}"), (5, f"x y {b}")], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_running_sums_of_a_long_array(spark):
    for n in (0, 1, 63, 64, 65, 20_000):
        values = [(i * 7) % 11 for i in range(n)]
        got = spark.createDataFrame([(values,)], "a array<bigint>").select(running_sums(F.col("a"))).first()[0]
        assert got == [0, *np.cumsum(values).tolist()][:n]


def test_a_long_conversation_in_linear_time(spark):
    n = 20_000
    turns = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 4 < 2, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("# <and>"), F.repeat(F.lit("é"), 490), F.col("id").cast("string")).alias("text"))
    begin = time.time()
    r = chat.format_chats(turns).select(
        F.size(chat.read_back(F.col("formatted"))).alias("n"),
        chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert time.time() - begin < 60
    assert r.n == n
    assert r.loss == "".join("# <and>" + "é" * 490 + str(i) for i in range(n) if i % 4 > 1)


class Rows:
    """Stands for a frame whose only batch is ``batch``; its tasks run here."""

    def __init__(self, batch):
        self.batch = batch
        self.schema = type("S", (), {"fields": [], "__getitem__": lambda _, c: LongField})()
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        return type("B", (), {"value": value})

    def select(self, *_):
        return self

    drop = select

    def mapInArrow(self, run, _):
        return list(run([self.batch]))


class LongField:
    class dataType:
        @staticmethod
        def simpleString():
            return "bigint"


def test_tasks_leave_no_words_behind():
    """A worker that has ended its task holds no words; fingerprints are made
    of small pieces of a batch."""
    from laketide.llm import fingerprints, quality
    texts = [f"{'one two ' * 200}{i}" for i in range(999)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(999)), pa.array(texts)], ["doc_id", "text"])
    model = quality.Model(np.zeros((0, quality.WIDTH), np.float32), np.zeros(0))
    out = quality.score(Rows(batch), model)
    assert sum(b.num_rows for b in out) == 999 and not _known
    out = fingerprints.fingerprint(Rows(batch))
    assert sum(b.num_rows for b in out) == 999 and not _known
    assert max(b.num_rows for b in out) * len(texts[0]) <= 1 << 20
