"""String helpers that fill gaps between warehouse SQL and Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions._util import as_col

# Word delimiters of warehouse-style INITCAP (whitespace plus these
# punctuation characters). Spark's own initcap only splits on spaces (trap G7).
INITCAP_DELIMITERS = " \t\n\r\f\v[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"


def trim_ws(c: Column | str) -> Column:
    """Strip leading and trailing whitespace of any kind (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


def title_case(c: Column | str, delimiters: str = INITCAP_DELIMITERS) -> Column:
    """Upper-case the first character of every word, lower-case the rest.

    A word starts at position 1 or after any character in ``delimiters``.
    Implemented with the ``transform`` higher-order function over the character
    array, so it runs JVM-side and handles any text length.
    """
    chars = F.split(F.lower(as_col(c)), "")
    delim = F.array(*[F.lit(ch) for ch in delimiters])

    def fix(x: Column, i: Column) -> Column:
        prev = F.get(chars, i - 1)
        starts_word = (i == 0) | F.array_contains(delim, prev)
        return F.when(starts_word, F.upper(x)).otherwise(x)

    return F.when(as_col(c).isNull(), F.lit(None)).otherwise(F.array_join(F.transform(chars, fix), ""))


def regex_first(c: Column | str, pattern: str) -> Column:
    """First match of ``pattern`` or NULL when nothing matches (``regexp_extract`` gives '')."""
    return F.regexp_substr(as_col(c), F.lit(pattern))
