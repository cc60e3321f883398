"""Text, location and title expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from joblattice.constants import ROLE_SYNONYMS, SENIORITY_LEVELS

# Word characters and blanks as class bodies. Java's own \w and \s differ from these by combining
# marks, fraction signs and the four separator controls, so they are always written out.
WORD = r"\p{L}\p{N}_"
BLANK = r"\s\x1c-\x1f"
BOUNDARY = rf"(?:(?<![{WORD}])(?=[{WORD}])|(?<=[{WORD}])(?![{WORD}]))"

_BLANK_RUN = rf"(?U)[{BLANK}]+"
_EDGE_BLANKS = rf"(?U)^[{BLANK}]+|[{BLANK}]+$"
_MARKUP = r"<[^>]+>"
# The mail branch is tied to the start of its blank-free run and takes the run's first @ that is
# not its first character: a hit anywhere in a run always extends to the whole run, and without
# the tie every character of a long run would be tried again.
_LINKS = rf"(?U)https?://[^{BLANK}]+|www\.[^{BLANK}]+|(?<![^{BLANK}])[^{BLANK}][^{BLANK}@]*+@[^{BLANK}]+"


def java_literal(text: str) -> str:
    """Escape a plain string for a Java pattern."""
    return re.sub(r"([\\.\[\]{}()*+\-?^$|#&~ /])", r"\\\1", text)


def whole_word(text: str) -> str:
    r"""Pattern equal to ``\b`` + text + ``\b``, with the word characters above.

    A text edge that is no word character asks for a word character on its other side.
    """
    head = rf"(?<![{WORD}])" if re.match(r"\w", text[0]) else rf"(?<=[{WORD}])"
    tail = rf"(?![{WORD}])" if re.match(r"\w", text[-1]) else rf"(?=[{WORD}])"
    return head + java_literal(text) + tail


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it many times in ``body``.

    Without it the optimizer may copy a costly regex into every place that reads it.
    """
    return F.transform(F.array(value), body).getItem(0)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_BLANKS, "")


def collapse_blanks(c: Column) -> Column:
    return F.regexp_replace(c, _BLANK_RUN, " ")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    """Drop markup (leaving nothing in its place), collapse blanks, blank becomes null."""
    bare = F.regexp_replace(c.cast("string"), _MARKUP, "")
    return blank_to_null(F.trim(collapse_blanks(bare)))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every letter run, so ``ile-de-france`` gives ``Ile-De-France``."""
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    runs = F.regexp_extract_all(c, F.lit(f"([{cased}]+|[^{cased}]+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substr(r, F.lit(2))))), ""
    )


def standardize_location(c: Column) -> Column:
    """Drop bracketed parts and district numbers, title-case, blank becomes null."""
    plain = strip(F.regexp_replace(strip(c.cast("string")), r"\([^)]*\)", ""))
    no_district = strip(F.regexp_replace(plain, rf"(?U)[{BLANK}]+\d+(er|e|ème)?[{BLANK}]*", " "))
    return blank_to_null(title_case(no_district))


def without_links(c: Column) -> Column:
    """Lower-case text with links and mail addresses blanked out.

    The pattern only runs on texts that hold one of the pieces every hit must have.
    """

    def blanked(text: Column) -> Column:
        may_hit = F.contains(text, F.lit("@")) | F.contains(text, F.lit("://")) | F.contains(text, F.lit("www."))
        return F.when(may_hit, F.regexp_replace(text, _LINKS, " ")).otherwise(text)

    return let(F.lower(c), blanked)


def word_tokens(c: Column) -> Column:
    """Runs of two or more letters a-z of the link-free lower-case text; null gives none.

    Equal to blanking every other character first and then splitting, in one pass less.
    """
    return F.regexp_extract_all(without_links(F.coalesce(c, F.lit(""))), F.lit("[a-z]{2,}"), F.lit(0))


def preprocess_text(c: Column, tokens_only: bool = True) -> Column:
    """Text ready for a term model. ``tokens_only=False`` keeps one-letter words too."""
    if tokens_only:
        return F.array_join(word_tokens(c), " ")
    letters = F.regexp_replace(without_links(F.coalesce(c, F.lit(""))), "[^a-z]+", " ")
    return F.trim(letters)


def ngrams(tokens: Column, low: int = 1, high: int = 1) -> Column:
    """All n-grams for n in low..high of a token array, linear in its length."""

    def build(words: Column) -> Column:
        grown = words
        parts = [words] if low == 1 else []
        for n in range(2, high + 1):
            shifted = F.slice(words, n, F.size(words))
            grown = F.array_compact(F.zip_with(grown, shifted, lambda a, b: F.concat(a, F.lit(" "), b)))
            if n >= low:
                parts.append(grown)
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    return let(tokens, build)


def counted(items: Column) -> Column:
    """Array of ``(term, tf)``: the distinct items with their numbers of occurrences, sorted.

    The sorted array is cut where its value changes, so the work is that of one sort and no table
    of all rows' items is built.
    """

    def runs(s: Column) -> Column:
        n = F.size(s)
        places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        changes = F.filter(places, lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)))
        ends = lambda first: F.concat(F.slice(first, 2, n), F.array(n + 1))
        run = lambda a, b: F.struct(F.get(s, a - 1).alias("term"), (b - a).cast("bigint").alias("tf"))
        return let(changes, lambda first: F.when(n > 0, F.zip_with(first, ends(first), run)))

    return let(F.sort_array(items), runs)


# --- titles ------------------------------------------------------------------------------------


def clean_title(c: Column) -> Column:
    """Lower, strip, collapse blanks, drop punctuation; null gives an empty text."""
    lowered = collapse_blanks(strip(F.lower(F.coalesce(c, F.lit("")))))
    return F.regexp_replace(lowered, rf"(?U)[^{WORD}{BLANK}]", "")


def normalize_role(c: Column, synonyms: dict[str, str] | None = None) -> Column:
    """Role of the longest synonym the title contains (ties in dictionary order), else the lower title."""
    synonyms = ROLE_SYNONYMS if synonyms is None else synonyms
    by_length = sorted(synonyms, key=len, reverse=True)

    def role(title: Column) -> Column:
        hits = [F.when(F.contains(title, F.lit(key)), F.lit(synonyms[key])) for key in by_length]
        return F.coalesce(*hits, title)

    return let(strip(F.lower(c)), role)


def normalize_seniority(c: Column, levels: dict[str, str] | None = None) -> Column:
    """Cut the whole-word hits of the first level word the title contains.

    The first word found inside the title decides, even when it is only part of a longer word and
    so nothing is cut.
    """
    levels = SENIORITY_LEVELS if levels is None else levels

    def without_level(title: Column) -> Column:
        cut = title
        for key in reversed(list(levels)):
            removed = strip(F.regexp_replace(title, "(?i)" + whole_word(key), ""))
            cut = F.when(F.contains(title, F.lit(key)), removed).otherwise(cut)
        return cut

    return let(strip(F.lower(c)), without_level)


def normalize_job_title(
    c: Column,
    synonyms: dict[str, str] | None = None,
    levels: dict[str, str] | None = None,
) -> Column:
    """Cleaned title, mapped to a role where one is known, without its level word."""
    return strip(normalize_seniority(normalize_role(clean_title(c), synonyms), levels))
