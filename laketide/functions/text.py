"""Text cleaning (STR1-STR7).

The original helpers built SQL text; here each helper returns a Column, so
patterns are plain Java regex strings with no SQL-literal escaping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laketide.functions._util import as_col

# Fixed value: what clean_string drops, that is all but ASCII letters, digits,
# white space and the listed punctuation (the apostrophe is kept).
CLEAN_DROP_PATTERN = "[^A-Za-z0-9 \\t\\n\\x0B\\f\\r,.'\";:!?()_&%$#@]"

# A word is a run of letters (of any script, with their marks), digits and
# underscore; everything else separates words.  Title case upper-cases the
# first letter of each word: the text is split (zero-width) just before every
# letter that starts a word.
_WORD_START = r"(?<![\p{L}\p{M}\p{N}_])(?=\p{L})"


def clean_string(c) -> Column:
    """Drop characters outside the whitelist, then trim leading blanks."""
    return F.ltrim(F.regexp_replace(as_col(c), CLEAN_DROP_PATTERN, ""))


def title_case(c) -> Column:
    """Lower-case, then capitalise the first letter of every word.

    ``o'brien mary-ann renée`` -> ``O'Brien Mary-Ann Renée``.  Words are split
    on any character that is not a letter, digit or underscore, so the rule
    works for names joined by apostrophes and hyphens (``initcap`` only
    splits on blanks).  A letter whose upper case is several letters stays.
    """
    tokens = F.split(F.lower(as_col(c)), _WORD_START)

    def capital(t: Column) -> Column:
        first = F.substring(t, 1, 1)
        big = F.upper(first)
        return F.concat(F.when(F.length(big) == 1, big).otherwise(first), F.substring(t, 2, 1 << 30))
    cap = F.transform(tokens, capital)
    return F.when(as_col(c).isNotNull(), F.array_join(cap, ""))


def upper_case(c) -> Column:
    return F.upper(as_col(c))


def lower_case(c) -> Column:
    return F.lower(as_col(c))


def full_name(first, last, sep: str = " ") -> Column:
    """Join name parts with a separator, skipping NULL parts.

    NULL only when every part is NULL (a plain ``||`` would be NULL as soon
    as one part is).
    """
    parts = [as_col(first), as_col(last)]
    joined = F.concat_ws(sep, *parts)
    return F.when(F.coalesce(*parts).isNotNull(), joined)
