from __future__ import annotations

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from joblattice.functions import skills, text, trigram, values

ODD = list("aZé 1_<>b(\t\n\x1c\x85\xa0)²½.,@/+#-&|") + ["www.", "http://", "er", "ème", "C++", "R", "ß", "é", "中"]


def odd_texts(n=400, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 24))) for _ in range(n)]


def test_clean_text(apply):
    given = ["<p>a<br>b</p>", "  ", None, " x \n\t y ", "&amp; <script>v</script>"]
    assert apply(given, text.clean_text) == ["ab", None, None, "x y", "&amp; v"]


def test_clean_text_odd_characters(apply):
    texts = odd_texts()
    expected = [" ".join(re.sub("<[^>]+>", "", t).split()) or None for t in texts]
    assert apply(texts, text.clean_text) == expected


def test_locations(apply):
    given = ["Paris 1er", "Lyon (69)", "ile-de-france", "Paris 5eme", " ", None, "l'haÿ 3 ème x", "()"]
    assert apply(given, text.standardize_location) == [
        "Paris", "Lyon", "Ile-De-France", "Paris Me", None, None, "L'Haÿ Ème X", None,
    ]


def test_title_case_like_python(apply):
    texts = [t for t in odd_texts(300, 3) if "ß" not in t]
    assert apply(texts, text.title_case) == [t.title() for t in texts]


def test_preprocess(apply):
    given = ["See http://x.y/z?q me@mail.org données A b cd www.z", None, "", "x@ @y a@b", "foo@bar@"]
    assert apply(given, text.preprocess_text) == ["see donn es cd", "", "", "", ""]
    assert apply(given[:1], lambda c: text.preprocess_text(c, tokens_only=False)) == ["see donn es a b cd"]


def test_links_like_the_plain_pattern(apply):
    texts = [t.lower() for t in odd_texts(600, 11)]
    plain = re.compile(r"https?://\S+|www\.\S+|\S+@\S+")
    expected = [" ".join(re.findall("[a-z]{2,}", plain.sub(" ", t))) for t in texts]
    assert apply(texts, text.preprocess_text) == expected


def test_long_runs_stay_linear(apply):
    run = "a" * 200_000
    assert apply([run + "@ " + run], lambda c: F.length(text.preprocess_text(c))) == [400_001]


def test_ngrams_and_counts(apply):
    words = lambda c: F.split(c, " ")
    assert apply(["a b c"], lambda c: text.ngrams(words(c), 1, 3)) == [["a", "b", "c", "a b", "b c", "a b c"]]
    assert apply(["a b c", "a"], lambda c: text.ngrams(words(c), 2, 2)) == [["a b", "b c"], []]
    runs = apply(["b a b", "x"], lambda c: text.counted(words(c)))
    assert [[tuple(p) for p in r] for r in runs] == [[("a", 1), ("b", 2)], [("x", 1)]]
    assert apply([""], lambda c: text.counted(F.array().cast("array<string>"))) == [None]


TITLES = {
    "Senior Data Scientist": "data scientist",
    "Lead ML Engineer": "ml engineer",
    "Junior Backend Developer": "backend engineer",
    "Data Science Engineer": "data scientist",
    "Sr. Full-Stack Developer": "fullstack developer",
    "Internal Auditor": "internal auditor",
    "Senior Lead Architect": "lead architect",
    # "data engineering" holds "data engineer", so the role is found inside the longer word.
    "Data Engineering Internship": "data engineer",
    "Internship in  Sales": "internship in sales",
    "": "",
}


def test_titles(apply):
    assert apply(list(TITLES) + [None], text.normalize_job_title) == list(TITLES.values()) + [""]


def test_longest_role_wins(apply):
    assert apply(["big data analyst", "business analyst x"], text.normalize_role) == ["data analyst", "business analyst"]


def test_keyword_skills(apply):
    given = [
        "We seek experienced Python and SQL developer with AWS and Docker experience",
        "C++ and C# dev, R&D", "c++11 big data lake", "Javascript, not the island", None, "éR r_", "ci/cd/CI/CD",
    ]
    assert apply(given, skills.extract_skills) == [
        "AWS, Docker, Python, SQL", "R", "Big Data, C++, Data Lake", "JavaScript", None, None, "CI/CD",
    ]


def test_keyword_skills_like_single_searches(apply):
    words = ["R", "C++", "C", "er", "a", "1", "é", "+", "R R", "a.", ".a", "A", "R-", "er a"]
    texts = odd_texts(500, 5)

    def one_by_one(t):
        low = t.lower()
        found = {w for w in words if re.search(r"\b" + re.escape(w.lower()) + r"\b", low)}
        return ", ".join(sorted(found)) or None

    assert apply(texts, lambda c: skills.extract_skills(c, words)) == [one_by_one(t) for t in texts]


def test_vocab_skills(apply):
    given = [
        "Python, SQL, AWS, Docker and TensorFlow experience required",
        "Looking for senior data scientist with Python, SQL, AWS and experience with TensorFlow or PyTorch.",
        "py sklearn tf. python-based r", None, " ",
    ]
    assert apply(given, skills.vocab_skills) == [
        ["aws", "docker", "python", "sql", "tensorflow"],
        ["aws", "python", "pytorch", "sql", "tensorflow"],
        ["python", "scikit-learn", "tensorflow"], [], [],
    ]
    assert apply(given[:1], lambda c: skills.vocab_skills(c, [])) == [["aws", "docker", "python", "sql", "tensorflow"]]


def test_skill_tokens_like_python(apply):
    texts = odd_texts(500, 9)
    assert apply(texts, skills.skill_tokens) == [re.findall(r"\b[a-z0-9\+\-\.\#]{2,}\b", t.lower()) for t in texts]


def test_phrases(apply):
    vocab = ["machine learning", "python", "deep machine learning", "c++"]
    given = ["Deep  Machine\nLearning, py c++", "machine, learning", None]
    assert apply(given, lambda c: skills.phrase_skills(c, vocab)) == [
        ["c++", "deep machine learning", "machine learning", "python"], ["machine learning"], [],
    ]


def test_salaries(apply):
    given = ["45 000 - 60 000 EUR", "60,000 - 80,000 EUR", "Competitive", "50000", "1 2 3", "45000.50", "1\t2", None]
    assert [tuple(r) for r in apply(given, values.parse_salary)] == [
        (45000, 60000), (0, 80), (None, None), (50000, 50000), (123, 123), (50, 45000), (None, None), (None, None),
    ]
    assert [tuple(r) for r in apply(["60,000 - 80,000 EUR"], lambda c: values.parse_salary(c, ","))] == [(60000, 80000)]
    assert [tuple(r) for r in apply(["0 - 10", "5 - 9"], lambda c: values.parse_salary(c, checked=True))] == [(None, None), (5, 9)]


def test_salary_text(spark):
    cases = [(45000.7, 60000.0, None), (0.0, 5.0, None), (None, 5.0, None), (1234567.0, 2.0, ""), (900.0, 1000.0, "USD")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a double, b double, c string")
    out = [r[0] for r in df.orderBy("i").select(values.format_salary(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert out == ["45 000 - 60 000 EUR", None, None, "1 234 567 - 2 EUR", "900 - 1 000 USD"]


def test_dates(apply):
    given = ["2026-01-08T10:00:00Z", "2026-01-08", "08/01/2026", "junk", None, "12:30", "2026-13-01"]
    out = apply(given, lambda c: values.parse_posted_date(c).cast("string"))
    assert out == ["2026-01-08", "2026-01-08", None, None, None, None, None]
    assert apply(given[2:3], lambda c: values.parse_posted_date(c, ["dd/MM/yyyy"]).cast("string")) == ["2026-01-08"]
    assert apply(["2026-01-20"], lambda c: values.days_since(c.cast("date"), F.lit("2026-01-08").cast("date"))) == [-12]


def test_uuid_like_python(apply):
    names = odd_texts(100, 1)
    expected = [str(uuid.uuid5(uuid.NAMESPACE_URL, "||".join(p for p in ["src", t, "end"] if p))) for t in names]
    assert apply(names, lambda c: values.uuid5_of(F.lit("src"), c, F.lit(None).cast("string"), F.lit("end"))) == expected


def test_model_version_name(apply):
    assert apply(["2026-01-08 00:30:00"], lambda c: values.model_version_name(c.cast("timestamp"))) == ["tfidf_v20260108_003000"]


@pytest.mark.parametrize("a,b,score", [("word", "two words", 0.363636), ("same", "SAME", 1.0), ("", "x", 0.0), ("", "", 0.0)])
def test_trigram_similarity(apply, a, b, score):
    assert apply([a], lambda c: F.round(trigram.similarity(c, F.lit(b)), 6)) == [score]


def test_offsets_keep_the_written_day(apply):
    given = ["2026-01-08T01:00:00+05:00", "2026-01-08T23:30:00-08:00", "2026-1-8", "2026-13-01"]
    assert apply(given, lambda c: values.parse_posted_date(c).cast("string")) == ["2026-01-08"] * 3 + [None]
