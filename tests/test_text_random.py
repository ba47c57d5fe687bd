"""Random strings through the Spark text functions versus a plain-Python
statement of the same rules (one Spark job for all cases)."""

import random
import re

from pyspark.sql import functions as F

from laketide import functions as LF

POOL = (list("abcxyzABCXYZ0123456789") + list(" \t\n\x0b\f\r") + list(",.'\";:!?()_&%$#@-—/\\*+=[]{}<>|~`^")
        + list("éèçüßñøÅÉ") + ["中", "文", "😀", " ", " "])

KEEP = re.compile(r"[A-Za-z0-9 \t\n\x0b\f\r,.'\";:!?()_&%$#@]")


def py_clean(s):
    if s is None:
        return None
    return "".join(ch for ch in s if KEEP.fullmatch(ch)).lstrip(" ")


def py_title(s):
    if s is None:
        return None
    low = s.lower()
    out, prev_word = [], False
    for ch in low:
        is_word = ch.isascii() and (ch.isalnum() or ch == "_")
        if "a" <= ch <= "z" and not prev_word:
            ch = ch.upper()
        out.append(ch)
        prev_word = is_word
    return "".join(out)


def test_random_strings(spark):
    rnd = random.Random(7)
    cases = [None, ""] + ["".join(rnd.choice(POOL) for _ in range(rnd.randint(1, 40))) for _ in range(3000)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    got = {r.i: (r.c, r.t) for r in df.select("i", LF.clean_string("s").alias("c"),
                                              LF.title_case("s").alias("t")).collect()}
    for i, s in enumerate(cases):
        assert got[i][0] == py_clean(s), (s, got[i][0])
        if s is None or all(ord(ch) < 128 for ch in s):
            assert got[i][1] == py_title(s), (s, got[i][1])
    assert df.where(F.col("s").isNull()).count() == 1
