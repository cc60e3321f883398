"""Dictionary lookups for dictionaries too large to be literals.

Every row's array of words is rewritten where it lies, from a sorted list of the forms the dictionary knows.
A dictionary within the broadcast bounds is one list for all rows, and nothing is shuffled. A larger one is
first cut to the forms that occur; if these are still too many, each document gets the entries of its own
distinct forms. No shuffle has a row for each word of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblattice.functions.skills import skill_tokens
from joblattice.functions.text import let, ngrams, word_tokens
from joblattice.session import is_small, spread, written

ITEMS, ENTRIES = "_items", "_entries"


def with_entries(docs: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """``docs(key, _items)`` with ``_entries``: sorted ``(form, values)`` of every item that ``table(form, value)`` knows.

    The list may hold forms the row lacks, and is null where it has none.
    """
    known = table.filter(F.col("form").isNotNull())
    if not is_small(known):
        occurring = docs.select(F.explode(ITEMS).alias("form")).distinct()
        known = written(known.join(occurring, "form", "left_semi"), "forms")
    by_form = known.groupBy("form").agg(F.array_sort(F.collect_list("value")).alias("values"))
    if is_small(known):
        return docs.withColumn(ENTRIES, by_form.agg(F.array_sort(F.collect_list(F.struct("form", "values")))).scalar())
    wanted = docs.select(F.col(key).alias("_key"), F.explode(F.array_distinct(ITEMS)).alias("form"))
    own = wanted.join(by_form, "form").groupBy("_key").agg(F.array_sort(F.collect_set(F.struct("form", "values"))).alias(ENTRIES))
    return docs.join(own, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def _replaced(unknown) -> Column:
    """The values of all items in their order; ``unknown(item)`` stands for an item without an entry.

    The place of an item among the sorted forms is found by steps of falling powers of two.
    """
    entries = F.col(ENTRIES)
    highest = F.floor(F.log2(F.greatest(F.size(entries), F.lit(1)))).cast("int")
    steps = F.transform(F.sequence(highest, F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int"))

    def values(item: Column, powers: Column) -> Column:
        def further(at: Column, step: Column) -> Column:
            return F.when(F.get(entries, at + step - 1)["form"] < item, at + step).otherwise(at)

        hit = F.aggregate(powers, F.lit(0), further)
        return let(F.get(entries, hit), lambda e: F.when(e["form"] == item, e["values"]).otherwise(unknown(item)))

    return F.flatten(let(steps, lambda powers: F.transform(ITEMS, lambda item: values(item, powers))))


def skills_by_join(docs: DataFrame, key: str, text: str, forms: DataFrame, longest: int = 1) -> DataFrame:
    """Sorted distinct skills per row from a table ``forms(form, skill)``.

    ``longest`` is the number of words of the longest form. Rows without a hit have an empty array.
    """
    candidates = skill_tokens(F.col(text))
    if longest > 1:
        plain = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^a-z0-9\-+.# ]", " ")
        words = F.regexp_extract_all(plain, F.lit("[^ ]+"), F.lit(0))
        candidates = F.array_union(candidates, ngrams(words, 1, longest))
    items = spread(docs.select(key, text)).select(key, F.array_distinct(candidates).alias(ITEMS))
    found = with_entries(items, key, forms.select("form", F.col("skill").alias("value")))
    skills = _replaced(lambda _: F.array().cast("array<string>"))
    return found.select(key, F.array_sort(F.array_distinct(skills)).alias("skills"))


def lemmatized_tokens(docs: DataFrame, key: str, text: str, lemmas: DataFrame) -> DataFrame:
    """Word tokens in text order with a table ``lemmas(form, lemma)`` applied; unknown forms stay.

    A lemma may be a single letter; such tokens are dropped, as the term model does.
    """
    items = spread(docs.select(key, text)).select(key, word_tokens(F.col(text)).alias(ITEMS))
    found = with_entries(items, key, lemmas.select("form", F.coalesce("lemma", "form").alias("value")))
    return found.select(key, F.filter(_replaced(lambda item: F.array(item)), lambda t: F.length(t) >= 2).alias("tokens"))
