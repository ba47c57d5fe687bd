"""Personal data: pattern spans, checksum confirmation, context scores.

All in Spark expressions, one pass, no shuffle.  A pattern splits the text
into the parts between its matches; the lengths of parts and matches give
the code-point positions.  Possessive quantifiers and look-behinds keep
every pattern linear on very long runs and leave its matches as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import running_sums


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _n_digits(m: Column, least: int, most: int) -> Column:
    return F.length(_digits(m)).between(least, most)


def _ip_ok(m: Column) -> Column:
    # leading zeros aside, a part has at most three digits
    return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                    & (F.ltrim(p, F.lit("0")).try_cast("int").isNull() | (F.ltrim(p, F.lit("0")).try_cast("int") <= 255)))


def _card_ok(m: Column) -> Column:
    return F.when(_n_digits(m, 13, 19), F.call_function("luhn_check", _digits(m))).otherwise(False)


def _iban_ok(m: Column) -> Column:
    """ISO 7064 mod 97: country and check digits moved to the end, letters
    read as 10 to 35, the number leaves 1."""
    flat = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(flat, 5, 99), F.substring(flat, 1, 4))
    signs = F.split(turned, "")

    def step(acc: Column, c: Column) -> Column:
        v = F.ascii(c)
        return F.when(v < 65, (acc * 10 + v - 48) % 97).otherwise((acc * 100 + v - 55) % 97)
    return F.length(flat).between(15, 34) & (
        F.aggregate(F.filter(signs, lambda c: c != ""), F.lit(0), step) == 1)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str                 # Java pattern, linear
    hint: str                    # cheap test that a text may hold a match
    ok: object                   # match -> boolean, or None
    cues: str                    # words nearby that raise the score
    base_score: float


# The contract's patterns (first four) in possessive form.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", None, r"mail|contact|write|reply|adresse|correo", 0.9),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", _ip_ok, r"\bip\b|host|server|address|login", 0.6),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         r"[0-9](?:[\x20-]?[0-9]){12}", _card_ok, r"card|visa|credit|payment|karte|carte|tarjeta", 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         r"\+[0-9]", lambda m: _n_digits(m, 9, 15), r"phone|call|\btel|mobile|fax", 0.7),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]", _iban_ok, r"iban|bank|account|konto|compte|cuenta", 0.8),
)
N_BASE = 4
CONTEXT_CHARS = 48


def spans_of(text: Column, kind: Kind) -> Column:
    """array<struct<kind, start, end, score>> of the confirmed matches, in
    order; positions are code points, end exclusive."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    parts = F.split(text, kind.pattern, -1)
    # ``i`` counts matches: a match starts after parts 0..i and matches 0..i-1
    lengths = F.transform(hits, lambda m, i: (F.length(F.get(parts, i)) + F.length(m)).cast("long"))
    # the sums refer to the array twice: named once through a one-element transform
    row = F.struct(hits.alias("m"), parts.alias("p"), lengths.alias("n"))

    def found(r: Column) -> Column:
        before = running_sums(r["n"])

        def span(m: Column, i: Column) -> Column:
            start = F.get(before, i) + F.length(F.get(r["p"], i))
            near = F.concat(F.right(F.get(r["p"], i), F.lit(CONTEXT_CHARS)), F.lit(" "),
                            F.left(F.get(r["p"], i + 1), F.lit(CONTEXT_CHARS)))
            cue = F.lower(near).rlike(kind.cues)
            return F.struct(
                F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"),
                F.when(cue, F.lit(min(1.0, kind.base_score + 0.2))).otherwise(F.lit(kind.base_score)).alias("score"),
                (kind.ok(m) if kind.ok else F.lit(True)).alias("ok"))
        return F.transform(r["m"], span)
    rows = F.element_at(F.transform(F.array(row), found), 1)
    kept = F.transform(F.filter(rows, lambda s: s["ok"]),
                       lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"]))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return F.when(text.rlike(kind.hint), kept).otherwise(none)


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column ``pii``: array<struct<kind, start, end,
    score>>, by kind (email, ip, card, phone, iban) and then by start.

    Base matches are leftmost and not overlapping within a kind; an IP part
    above 255, a card failing Luhn or length, a phone number of the wrong
    length and an IBAN failing mod 97 are dropped without a retry.  The
    score is the kind's base score, 0.2 higher if a cue word stands within
    48 characters.  Null and empty texts give an empty array; other columns
    pass through untouched (a column called ``pii`` is replaced); repeated
    rows are treated alike; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("pii", F.concat(*[spans_of(text, k) for k in KINDS]))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
