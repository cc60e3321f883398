"""Skill extraction expressions: whole-word keywords, vocabulary tokens, multi-word phrases."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from joblattice.constants import SKILL_ALIASES, SKILL_KEYWORDS, SKILL_VOCAB
from joblattice.functions.text import BOUNDARY, WORD, java_literal, let

_TOKEN = rf"{BOUNDARY}[a-z0-9+\-.#]{{2,}}{BOUNDARY}"


def _is_word(char: str) -> bool:
    return re.match(r"\w", char) is not None


def _both_fit(word: str, longer: str) -> bool:
    """Whether both can match at one place: ``longer`` goes on after a word boundary behind ``word``."""
    return longer.startswith(word) and len(longer) > len(word) and _is_word(word[-1]) != _is_word(longer[len(word)])


def _layers(keywords: Iterable[str]) -> list[list[str]]:
    """Split keywords so that at any place of a text at most one of a layer can match.

    One look-ahead alternation then finds every keyword of a layer, overlapping ones included.
    """
    layers: list[list[str]] = []
    for word in sorted(set(keywords), key=lambda w: (-len(w), w)):
        for layer in layers:
            if not any(_both_fit(word, longer) for longer in layer):
                layer.append(word)
                break
        else:
            layers.append([word])
    return layers


def _alternation(words: Iterable[str]) -> str:
    """Alternatives sharing their first characters, so that a mismatch is decided once for all of them."""
    by_head: dict[str, list[str]] = {}
    for word in sorted(words):
        by_head.setdefault(word[:1], []).append(word[1:])
    branches = []
    for head, tails in by_head.items():
        branches.append(java_literal(head) + (_alternation(tails) if tails != [""] else "") if head else "")
    return "(?:" + "|".join(sorted(branches, key=lambda x: x == "")) + ")"


def _layer_pattern(layer: list[str]) -> str:
    """Look-ahead capturing the keyword that starts here, if any.

    An edge of a keyword that is a word character needs none beyond it; any other edge needs one.
    """
    starts = []
    for word_start, before in ((True, rf"(?<![{WORD}])"), (False, rf"(?<=[{WORD}])")):
        ends = []
        for word_end, after in ((True, rf"(?![{WORD}])"), (False, rf"(?=[{WORD}])")):
            group = [w for w in layer if (_is_word(w[0]), _is_word(w[-1])) == (word_start, word_end)]
            if group:
                ends.append(_alternation(group) + after)
        if ends:
            starts.append(before + "(?:" + "|".join(ends) + ")")
    # With one kind of start its check comes first and passes over the middles of words.
    return "(?=(" + "|".join(starts) + "))"


def _string_array(words: Iterable[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _string_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def keyword_skills(c: Column, keywords: Iterable[str] | None = None) -> Column:
    """Sorted array of the keywords found as whole words, ignoring case; spelled as in the list.

    Keywords of word characters alone are looked up among the words of the text; the others are patterns,
    which only run on texts that hold one of them anywhere.
    """
    keywords = list(SKILL_KEYWORDS if keywords is None else keywords)
    spelling: dict[str, list[str]] = {}
    for word in keywords:
        spelling.setdefault(word.lower(), []).append(word)
    words = [low for low in spelling if re.fullmatch(r"\w+", low)]

    def met(lowered: Column) -> Column:
        found = [F.array_intersect(F.regexp_extract_all(lowered, F.lit(f"[{WORD}]+"), F.lit(0)), _string_array(words))]
        for layer in _layers(set(spelling) - set(words)):
            may_hit = reduce(or_, [F.contains(lowered, F.lit(w)) for w in layer])
            matched = F.regexp_extract_all(lowered, F.lit(_layer_pattern(layer)), F.lit(1))
            found.append(F.when(may_hit, matched).otherwise(_string_array([])))
        return F.array_distinct(F.concat(*found))

    hits = let(F.lower(c), met)
    names = F.create_map(*[x for low, as_listed in spelling.items() for x in (F.lit(low), _string_array(as_listed))])
    return F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda h: F.element_at(names, h)))))


def extract_skills(c: Column, keywords: Iterable[str] | None = None) -> Column:
    """The keyword skills as one comma-joined text; null when there are none."""
    return F.nullif(F.array_join(keyword_skills(c, keywords), ", "), F.lit(""))


def skill_tokens(c: Column) -> Column:
    """Lower-case tokens of two or more of a-z 0-9 + - . # between word boundaries."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(_TOKEN), F.lit(0))


def normalize_skill(token: Column, aliases: dict[str, str] | None = None) -> Column:
    """Lower, trim, replace an alias by its skill."""
    aliases = SKILL_ALIASES if aliases is None else aliases
    if not aliases:
        return F.trim(F.lower(token))
    return let(
        F.trim(F.lower(token)), lambda t: F.coalesce(F.try_element_at(_string_map(aliases), t), t)
    )


def surface_forms(vocab: Iterable[str], aliases: dict[str, str]) -> dict[str, str]:
    """Every token that normalises into the vocabulary, with the skill it stands for."""
    wanted = set(vocab)
    forms = {v: aliases.get(v, v) for v in wanted} | dict(aliases)
    return {form: skill for form, skill in sorted(forms.items()) if skill in wanted}


def _named(hits: Column, forms: dict[str, str]) -> Column:
    names = _string_map(forms)
    return F.array_sort(F.array_distinct(F.transform(hits, lambda h: F.element_at(names, h))))


def vocab_skills(
    c: Column,
    vocab: Iterable[str] | None = None,
    aliases: dict[str, str] | None = None,
) -> Column:
    """Sorted distinct skills whose token occurs in the text; an empty vocabulary means the default one."""
    aliases = SKILL_ALIASES if aliases is None else aliases
    forms = surface_forms(list(vocab or []) or SKILL_VOCAB, aliases)
    return _named(F.array_intersect(skill_tokens(c), _string_array(forms)), forms)


def phrase_skills(
    c: Column,
    vocab: Iterable[str],
    aliases: dict[str, str] | None = None,
) -> Column:
    """As ``vocab_skills``, with vocabulary entries of several words matched as word sequences.

    For vocabularies of up to some hundred entries; ``skills_by_join`` takes larger ones.
    """
    aliases = SKILL_ALIASES if aliases is None else aliases
    forms = surface_forms(vocab, aliases)
    plain = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9\-+.# ]", " ")
    spaced = F.concat(F.lit(" "), F.regexp_replace(plain, "  +", " "), F.lit(" "))

    def held(line: Column) -> Column:
        return F.array_compact(F.array(*[F.when(F.contains(line, F.lit(f" {form} ")), F.lit(form)) for form in forms]))

    tokens = F.array_intersect(skill_tokens(c), _string_array(forms))
    return _named(F.array_union(let(spaced, held), tokens), forms)
