"""Trigram sets and similarity of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from joblattice.functions.text import let


# Every triple of letters and blanks but those that run over the end of a word: a letter before two blanks.
_TRIPLES = r"(?=(  [^ ]| [^ ].|[^ ]{2}.))"


def distinct_words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the lower-case words, each padded with two blanks before and one after."""
    padded = F.concat(F.lit("  "), F.array_join(distinct_words(c), "  "), F.lit(" "))
    return F.array_distinct(F.regexp_extract_all(padded, F.lit(_TRIPLES), F.lit(1)))


def shared_share(a: Column, b: Column) -> Column:
    """Size of the intersection over the size of the union of two distinct arrays; 0 for two empty ones."""

    def ratio(common: Column) -> Column:
        either = F.size(a) + F.size(b) - common
        return F.when(either == 0, 0.0).otherwise(common / either)

    return let(F.size(F.array_intersect(a, b)), ratio)


def similarity(a: Column, b: Column) -> Column:
    return let(F.struct(trigrams(a).alias("a"), trigrams(b).alias("b")), lambda p: shared_share(p["a"], p["b"]))
