"""Queries of the text, salary, date and identity expressions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joblattice.constants import ROLE_SYNONYMS, SENIORITY_LEVELS, SKILL_KEYWORDS
from joblattice.functions import skills, text, values
from joblattice.operators import clean, dictionary, tfidf
from joblattice.plans.catalog import (
    SQL_BLANK,
    Tables,
    query,
    sql_clean_text,
    sql_skill_tokens,
    sql_text,
    sql_word_tokens,
)
from joblattice.session import broadcast_if_small, spread

# Words that the supplied texts really hold, beside the default skills they hardly do.
KEYWORDS = [*SKILL_KEYWORDS, "The", "Of the", "The of", "De la", "La", "Que", "Und", "Der", "With", "Für", "À la"]
VOCAB = ["the", "of", "que", "und", "der", "with", "article", "r", "para"]
ALIASES = {"des": "der", "le": "article", "la": "article", "unused": "missing"}
PHRASES = ["of the", "the of", "de la", "que", "und der", "article", "in the of"]


def _sql_list(words) -> str:
    return "[" + ", ".join(sql_text(w) for w in words) + "]"


def _word(char: str) -> bool:
    return re.match(r"\w", char) is not None


def _sql_keyword(word: str, column: str) -> str:
    edge_in, edge_out = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
    head = f"(^|{edge_out})" if _word(word[0]) else edge_in
    tail = f"({edge_out}|$)" if _word(word[-1]) else edge_in
    pattern = head + re.escape(word.lower()).replace(r"\ ", " ") + tail
    return f"CASE WHEN regexp_matches({column}, {sql_text(pattern)}) THEN {sql_text(word)} END"


def sql_keyword_skills(column: str, keywords) -> str:
    """Comma-joined keywords found in a lower-case column."""
    cases = ", ".join(_sql_keyword(w, column) for w in keywords)
    return f"nullif(array_to_string(list_sort(list_filter([{cases}], lambda k: k IS NOT NULL)), ', '), '')"


@query(f"SELECT page_id, {sql_clean_text('html')} AS cleaned FROM pages")
def clean_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.clean_text(F.col("html")).alias("cleaned"))


@query(f"""
SELECT doc_id, {sql_keyword_skills('low', KEYWORDS)} AS skills
FROM (SELECT doc_id, lower(text) AS low FROM documents)
""")
def skills_keywords(t: Tables) -> DataFrame:
    docs = spread(t.documents.select("doc_id", "text"))
    return docs.select("doc_id", skills.extract_skills(F.col("text"), KEYWORDS).alias("skills"))


@query(f"""
SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(tokens,
    lambda w: CASE w {' '.join(f"WHEN '{a}' THEN '{s}'" for a, s in ALIASES.items())} ELSE w END),
    lambda w: list_contains({_sql_list(VOCAB)}, w)))), ', ') AS skills
FROM (SELECT doc_id, {sql_skill_tokens('text')} AS tokens FROM documents)
""")
def skills_tokens(t: Tables) -> DataFrame:
    found = clean.add_skills(t.documents, "text", "skills", VOCAB, ALIASES)
    return found.select("doc_id", F.array_join("skills", ", ").alias("skills"))


@query(f"""
WITH forms AS (SELECT DISTINCT unnest({sql_skill_tokens('text')}) AS form FROM benchmark),
tokens AS (SELECT DISTINCT doc_id, unnest({sql_skill_tokens('text')}) AS form FROM documents),
hits AS (SELECT doc_id, list(DISTINCT upper(form)) AS found FROM tokens JOIN forms USING (form) GROUP BY doc_id)
SELECT d.doc_id, coalesce(array_to_string(list_sort(found), ', '), '') AS skills
FROM documents d LEFT JOIN hits USING (doc_id)
""")
def skills_explode(t: Tables) -> DataFrame:
    forms = t.benchmark.select(F.explode(skills.skill_tokens(F.col("text"))).alias("form")).distinct()
    found = dictionary.skills_by_join(t.documents, "doc_id", "text", forms.withColumn("skill", F.upper("form")))
    return found.select("doc_id", F.array_join("skills", ", ").alias("skills"))


@query(f"""
WITH words AS (
    SELECT doc_id, {sql_skill_tokens('text')} AS tokens,
        regexp_extract_all(regexp_replace(lower(text), '[^a-z0-9\\-+.# ]', ' ', 'g'), '[^ ]+') AS w
    FROM documents),
grams AS (
    SELECT doc_id, tokens, w,
        list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS two,
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS three
    FROM words)
SELECT doc_id, array_to_string(list_sort(list_filter([{', '.join(
    f"CASE WHEN list_contains(w, '{p}') OR list_contains(two, '{p}') OR list_contains(three, '{p}') OR list_contains(tokens, '{p}') "
    + ("OR list_contains(w, 'le') OR list_contains(w, 'la') OR list_contains(tokens, 'le') OR list_contains(tokens, 'la') " if p == "article" else "")
    + f"THEN '{p}' END" for p in PHRASES)}], lambda p: p IS NOT NULL)), ', ') AS skills
FROM grams
""")
def skills_phrases(t: Tables) -> DataFrame:
    found = skills.phrase_skills(F.col("text"), PHRASES, {"le": "article", "la": "article"})
    return t.documents.select("doc_id", F.array_join(found, ", ").alias("skills"))


_PLACE_SQL = """'  ' || lower(replace(n_name, '_', '-sur ')) || ' ' || (c_custkey % 20) ||
    CASE c_mktsegment WHEN 'BUILDING' THEN 'er' WHEN 'MACHINERY' THEN 'ème' WHEN 'HOUSEHOLD' THEN 'eme ' ELSE '' END ||
    ' (' || c_mktsegment || ') l''ÉTÉ'"""


@query(f"""
WITH placed AS (SELECT c_custkey, {_PLACE_SQL} AS place FROM customer JOIN nation ON c_nationkey = n_nationkey),
bare AS (SELECT c_custkey, trim(regexp_replace(trim(place), '\\([^)]*\\)', '', 'g')) AS place FROM placed),
short AS (SELECT c_custkey, trim(regexp_replace(place, '\\s+\\d+(er|e|ème)?\\s*', ' ', 'g')) AS place FROM bare)
SELECT c_custkey, nullif(array_to_string(list_transform(
    regexp_extract_all(place, '([\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)'),
    lambda r: upper(r[1]) || lower(r[2:])), ''), '') AS location
FROM short
""")
def location_standardize(t: Tables) -> DataFrame:
    suffix = (
        F.when(F.col("c_mktsegment") == "BUILDING", "er")
        .when(F.col("c_mktsegment") == "MACHINERY", "ème")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "eme ")
        .otherwise("")
    )
    name = F.lower(F.replace(F.col("n_name"), F.lit("_"), F.lit("-sur ")))
    place = F.concat(
        F.lit("  "), name, F.lit(" "), (F.col("c_custkey") % 20).cast("string"), suffix,
        F.lit(" ("), F.col("c_mktsegment"), F.lit(") l'ÉTÉ"),
    )
    named = t.customer.join(broadcast_if_small(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("c_custkey", text.standardize_location(place).alias("location"))


_LOW = "CASE WHEN o_orderstatus = 'P' AND o_totalprice < 250000 THEN 0.0 ELSE o_totalprice END"
_RANGE_SQL = f"""CASE WHEN {_LOW} <> 0 THEN
    replace(format('{{:,}}', CAST(trunc({_LOW}) AS BIGINT)), ',', ' ') || ' - ' ||
    replace(format('{{:,}}', CAST(trunc(o_totalprice * 1.25) AS BIGINT)), ',', ' ') ||
    CASE WHEN o_orderstatus = 'O' THEN ' USD' ELSE ' EUR' END END"""


def _salary_text():
    low = F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 250000), 0.0).otherwise(F.col("o_totalprice"))
    currency = F.when(F.col("o_orderstatus") == "O", "USD").otherwise("")
    return values.format_salary(low, F.col("o_totalprice") * 1.25, currency)


@query(f"SELECT o_orderkey, {_RANGE_SQL} AS salary_range FROM orders")
def salary_format(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", _salary_text().alias("salary_range"))


_VARIED_SQL = f"""CASE o_orderpriority
    WHEN '1-URGENT' THEN replace({_RANGE_SQL}, ' - ', ' to ')
    WHEN '2-HIGH' THEN CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) || '.50 EUR'
    WHEN '3-MEDIUM' THEN 'Competitive'
    WHEN '4-NOT SPECIFIED' THEN 'from ' || format('{{:,}}', CAST(trunc(o_totalprice) AS BIGINT))
    ELSE {_RANGE_SQL} END"""


def _parsed_sql(source: str) -> str:
    return f"""
WITH varied AS (SELECT o_orderkey, {_VARIED_SQL} AS salary_range FROM orders),
numbered AS (SELECT o_orderkey, list_transform(
    list_filter(regexp_extract_all({source}, '[\\d\\s]+'), lambda r: trim(r) <> ''),
    lambda r: TRY_CAST(replace(r, ' ', '') AS BIGINT)) AS n FROM varied)
"""


def _varied_salary():
    whole = F.col("o_totalprice").cast("bigint")
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.replace(_salary_text(), F.lit(" - "), F.lit(" to ")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(whole.cast("string"), F.lit(".50 EUR")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Competitive")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(F.lit("from "), F.format_number(whole, 0)))
        .otherwise(_salary_text())
    )


@query(_parsed_sql("salary_range") + """
SELECT o_orderkey, list_min(n) AS salary_min, list_max(n) AS salary_max FROM numbered""")
def salary_parse(t: Tables) -> DataFrame:
    parsed = t.orders.select("o_orderkey", values.parse_salary(_varied_salary()).alias("salary"))
    return parsed.select("o_orderkey", "salary.salary_min", "salary.salary_max")


@query(_parsed_sql("replace(salary_range, ',', ' ')") + """
SELECT o_orderkey, CASE WHEN list_min(n) > 0 THEN list_min(n) END AS salary_min,
    CASE WHEN list_min(n) > 0 THEN list_max(n) END AS salary_max FROM numbered""")
def salary_checked(t: Tables) -> DataFrame:
    salary = values.parse_salary(_varied_salary(), thousands=",", checked=True)
    parsed = t.orders.select("o_orderkey", salary.alias("salary"))
    return parsed.select("o_orderkey", "salary.salary_min", "salary.salary_max")


@query("""
WITH digests AS (
    SELECT page_id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') ||
        encode(concat_ws('||', 'adzuna', CAST(page_id AS VARCHAR), nullif(url, '')))) AS x FROM pages)
SELECT page_id, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' ||
    lower(to_hex((CAST('0x' || substr(x, 17, 2) AS INTEGER) & 63) | 128)) || substr(x, 19, 2) || '-' || substr(x, 21, 12) AS job_id
FROM digests
""")
def job_uuid(t: Tables) -> DataFrame:
    key = values.uuid5_of(F.lit("adzuna"), F.col("page_id").cast("string"), F.col("url"), F.lit(""))
    return t.pages.select("page_id", key.alias("job_id"))


TITLES = [
    "Senior Data Scientist", "Lead ML Engineer!", "Junior  Backend Developer", "Data Science Engineer",
    "Sr. Full-Stack Developer", "Internal Auditor", "Senior Lead Architect", "Data Engineering Internship",
    "Mid Business Analyst (m/f)", "STAFF Machine Learning Ops", "Principal Gärtner", "Senior",
]
_TITLE_SQL = f"p_name || ' ' || ({_sql_list(TITLES)})[(p_size % {len(TITLES)}) + 1]"


def _part_title():
    return F.concat_ws(" ", F.col("p_name"), F.element_at(F.array(*[F.lit(x) for x in TITLES]), F.col("p_size") % len(TITLES) + 1))


def _role_case(column: str) -> str:
    keys = sorted(ROLE_SYNONYMS, key=len, reverse=True)
    return "CASE " + " ".join(f"WHEN contains({column}, '{k}') THEN '{ROLE_SYNONYMS[k]}'" for k in keys) + f" ELSE {column} END"


def _level_case(column: str) -> str:
    # The titles hold ASCII around the level words, where an ASCII \b is enough.
    whens = " ".join(
        f"WHEN contains({column}, '{k}') THEN trim(regexp_replace({column}, '\\b{re.escape(k)}\\b', '', 'g'))" for k in SENIORITY_LEVELS
    )
    return f"CASE {whens} ELSE {column} END"


@query(f"""
WITH cleaned AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(trim(lower({_TITLE_SQL})), '\\s+', ' ', 'g'),
    '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')) AS title FROM part),
roles AS (SELECT p_partkey, {_role_case('title')} AS title FROM cleaned)
SELECT p_partkey, trim({_level_case('title')}) AS title_normalized FROM roles
""")
def title_normalize(t: Tables) -> DataFrame:
    titled = t.part.select("p_partkey", _part_title().alias("title"))
    return clean.add_normalized_title(titled, "title", "title_normalized").drop("title")


@query(f"SELECT doc_id, array_to_string({sql_word_tokens('text')}, ' ') AS words FROM documents")
def preprocess_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.preprocess_text(F.col("text")).alias("words"))


@query("SELECT doc_id, array_to_string(regexp_extract_all(regexp_replace(lower(text), "
       rf"'https?://[^{SQL_BLANK}]+|www\.[^{SQL_BLANK}]+|[^{SQL_BLANK}]+@[^{SQL_BLANK}]+', ' ', 'g'), '[a-z]+'), ' ') AS words FROM documents")
def preprocess_text_letters(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.preprocess_text(F.col("text"), tokens_only=False).alias("words"))


@query(f"""
WITH words AS (SELECT doc_id, {sql_word_tokens('text')} AS w FROM documents),
grams AS (
    SELECT doc_id, unnest(w) AS term FROM words
    UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words)
SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term
""")
def ngram_counts(t: Tables) -> DataFrame:
    return tfidf.term_counts(t.documents, "doc_id", "text")


@query(f"""
WITH lemmas AS (
    SELECT DISTINCT form, left(form, len(form) - 2) AS lemma
    FROM (SELECT unnest({sql_word_tokens('text')}) AS form FROM benchmark) WHERE form LIKE '%es'),
words AS (SELECT doc_id, unnest({sql_word_tokens('text')}) AS form, generate_subscripts({sql_word_tokens('text')}, 1) AS pos FROM documents),
found AS (SELECT doc_id, pos, coalesce(lemma, words.form) AS token FROM words LEFT JOIN lemmas ON words.form = lemmas.form)
SELECT d.doc_id, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS lemmas
FROM documents d LEFT JOIN (SELECT * FROM found WHERE len(token) >= 2) f USING (doc_id) GROUP BY d.doc_id
""")
def lemmatize(t: Tables) -> DataFrame:
    forms = t.benchmark.select(F.explode(text.word_tokens(F.col("text"))).alias("form")).distinct()
    lemmas = forms.filter(F.col("form").like("%es")).withColumn("lemma", F.expr("left(form, length(form) - 2)"))
    found = dictionary.lemmatized_tokens(t.documents, "doc_id", "text", lemmas)
    return found.select("doc_id", F.array_join("tokens", " ").alias("lemmas"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS posted_date,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS INTEGER) END AS days_since_posted
FROM orders
""")
def days_since(t: Tables) -> DataFrame:
    shown = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm"))
        .otherwise("some day")
    )
    dated = t.orders.select("o_orderkey", values.parse_posted_date(shown, ["dd/MM/yyyy"]).alias("posted_date"))
    return dated.withColumn("days_since_posted", values.days_since(F.col("posted_date"), F.lit("2000-01-01").cast("date")))


@query("SELECT event_id, 'tfidf_v' || strftime(ts, '%Y%m%d_%H%M%S') AS model_version FROM events")
def model_version_names(t: Tables) -> DataFrame:
    return t.events.select("event_id", values.model_version_name(F.col("ts")).alias("model_version"))
