"""Keyed surrogates for personal data and secrets, in DataFrame expressions alone.

One alternation finds all entities. Each distinct entity has a canonical form (digits, lower case),
from which a keyed hash makes a surrogate of the same kind, letter by letter and digit by digit; the
written form then follows the surface, so one person or number gets one surrogate in whatever layout
it appears. Surrogates that meet each other, or a real entity, are drawn again until none does. After
``NARROW_DRAWS`` draws each further one is longer by ``WIDER`` letters or digits, so that no kind runs
out of surrogates, however many entities have the shape of one letter or of four digits.

Addresses of one real domain share a keyed subdomain. Cards that pass the Luhn check get surrogates that
do, others such that do not; IBANs keep their country and get right check digits; IPv6 addresses come
from the range for documentation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblattice.llm.shared import free_name, staged

KEY = "joblattice-surrogates"
#: Draws that keep the length of an entity, and the places each later draw adds.
NARROW_DRAWS = 3
WIDER = 4
#: Copies of the map from surfaces to surrogates that a frequent surface is dealt over.
SALTS = 16

# Honorifics by gender, names by gender and script.
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Mme|Madame|Mlle|Señora|Sra|Doña|Г-жа|Госпожа"
MALE_TITLES = "Mr|Herr|Monsieur|Señor|Sr|Don|Г-н|Господин"
FEMALE = "Anna Clara Elena Emma Julia Laura Lena Maria Marta Nina Nora Olivia Paula Rosa Sofia Vera".split()
MALE = "Adam Bruno Carlos David Emil Felix Hugo Ivan Jonas Leo Marco Max Oscar Paul Simon Victor".split()
FEMALE_CYRILLIC = "Анна Вера Дарья Елена Ирина Лидия Мария Нина Ольга София".split()
MALE_CYRILLIC = "Антон Борис Виктор Иван Егор Лев Олег Павел Роман Юрий".split()

_NAME = r"\p{Lu}\p{Ll}+(?:[ ]\p{Lu}\p{Ll}+)?"
#: Kind and pattern, tried in this order at each place.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "aws_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "password": r"(?<=[Pp]assword[=:])[^\s\"',;]{4,}",
    "token": r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*\d)[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])(?=[A-Z]{2}\d{2}(?:[A-Z ]{0,6}\d){8})[A-Z]{2}\d{2}"
    r"(?:[0-9A-Z]{11,30}|(?:[ ][0-9A-Z]{4}){2,7}(?:[ ][0-9A-Z]{1,3})?)(?![0-9A-Za-z])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:]|\.\d)",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "card": r"(?<![\d-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)",
    "name_f": rf"(?<![\p{{L}}])(?:{FEMALE_TITLES})\.?[ ]{_NAME}",
    "name_m": rf"(?<![\p{{L}}])(?:{MALE_TITLES})\.?[ ]{_NAME}",
}
#: All kinds. Only digits, ``+`` and ``(`` begin an entity right behind a letter, so other places inside a word are
#: passed over before any kind is tried.
PATTERN = r"(?:(?<![A-Za-z])(?=\S)|(?=[\d+(]))(?:" + "|".join(f"(?:{p})" for p in KINDS.values()) + ")"
_TITLE = rf"^(?:{FEMALE_TITLES}|{MALE_TITLES})\.?[ ]"


def kind_of(surface: Column) -> Column:
    """The first kind whose pattern takes the whole surface; what only its surroundings gave away is a password."""
    out = F.lit("password")
    for kind, pattern in reversed(KINDS.items()):
        if kind != "password":
            out = F.when(F.regexp_like(surface, F.lit(f"^(?:{pattern})$")), kind).otherwise(out)
    return out


def _canonical(surface: Column, kind: Column) -> Column:
    """Equal for all layouts of one entity: digits, lower case, or the name without its title."""
    digits = F.regexp_replace(surface, r"\D", "")
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.right(digits, F.lit(10)))
        .when(kind.isin("name_f", "name_m"), F.regexp_replace(surface, _TITLE, ""))
        .when(kind.isin("email", "token"), F.lower(surface))
        .when(kind == "iban", F.replace(surface, F.lit(" "), F.lit("")))
        .when(kind == "ipv6", _groups_of(F.lower(surface)))
        .otherwise(surface)
    )


def _groups_of(address: Column) -> Column:
    """All eight groups of an IPv6 address, of four digits each."""
    halves = F.split(address, "::")
    groups = lambda half: F.array_remove(F.split(half, ":"), "")
    left, right = groups(halves[0]), groups(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
    gap = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.transform(F.concat(left, gap, right), lambda g: F.lpad(g, 4, "0")), ":")


def _luhn(digits: Column) -> Column:
    """The check digit that makes ``digits`` and it pass the Luhn check."""

    def worth(ch: Column, i: Column) -> Column:
        d = ch.try_cast("int")
        return F.when(i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, x: a + x)
    return F.pmod(-total, F.lit(10))


def _iban_check(country: Column, account: Column) -> Column:
    """The two check digits of an IBAN: 98 less the remainder by 97, letters read as 10 to 35."""
    chars = F.split(F.concat(account, country, F.lit("00")), "")

    def step(acc: Column, ch: Column) -> Column:
        letter = F.ascii(ch) - 55
        return F.when(letter >= 10, F.pmod(acc * 100 + letter, F.lit(97))).otherwise(F.pmod(acc * 10 + ch.try_cast("int"), F.lit(97)))

    return F.lpad((F.lit(98) - F.aggregate(chars, F.lit(0), step)).cast("string"), 2, "0")


def _noise(kind: Column, canonical: Column, draw: Column, key: str) -> Column:
    """64 keyed numbers from 0 to 65535 for an entity and a draw."""
    bits = F.lit("")
    for part in range(4):
        bits = F.concat(bits, F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, draw.cast("string"), F.lit(str(part))), 256))
    return F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.conv(F.substring(bits, i * 4 + 1, F.lit(4)), 16, 10).cast("int")
    )


def _pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(n, F.lit(len(letters))) + 1, F.lit(1))


def _shaped(text: Column, noise: Column) -> Column:
    """Each digit by a digit, each letter by one of its case and script, the rest as it stands."""
    letters = F.split(text, "")

    def one(ch: Column, i: Column) -> Column:
        n = F.element_at(noise, F.pmod(i, F.lit(64)) + 1)
        return (
            F.when(F.regexp_like(ch, F.lit("[0-9]")), _pick("0123456789", n))
            .when(F.regexp_like(ch, F.lit("[A-Z]")), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
            .when(F.regexp_like(ch, F.lit(r"\p{IsCyrillic}")), _pick("абвгдежзиклмнопрстуфхцчшэюя", n))
            .when(F.regexp_like(ch, F.lit(r"\p{L}")), _pick("abcdefghijklmnopqrstuvwxyz", n))
            .otherwise(ch)
        )

    return F.array_join(F.transform(letters, one), "")


def _hex_shaped(text: Column, noise: Column) -> Column:
    return F.array_join(
        F.transform(F.split(text, ""), lambda ch, i: _pick("0123456789abcdef", F.element_at(noise, F.pmod(i, F.lit(64)) + 1))), ""
    )


def _syllables(noise: Column, cyrillic: Column, n: Column) -> Column:
    def of(a: str, b: str) -> Column:
        letter = lambda j: F.when(j % 2 == 0, _pick(a, at(j))).otherwise(_pick(b, at(j)))
        at = lambda j: F.element_at(noise, F.pmod(j + 1, F.lit(64)) + 1)
        return F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), n - 1), letter), ""))

    return F.when(cyrillic, of("бвгдзклмнпрст", "аеиоу")).otherwise(of("bdfgklmnprstv", "aeiou"))


def _name(noise: Column, canonical: Column, female: Column, draw: Column, more: Column) -> Column:
    """A first name of the gender and script, and a family name that all bearers of the real one share.

    A lone family name is drawn again itself; of a full name only the first name is, from syllables
    once the lists are used up.
    """
    cyrillic = F.regexp_like(canonical, F.lit(r"\p{IsCyrillic}"))
    at = lambda names: F.element_at(F.array(*map(F.lit, names)), F.pmod(noise[0], F.lit(len(names))) + 1)
    listed = F.when(cyrillic & female, at(FEMALE_CYRILLIC)).when(cyrillic, at(MALE_CYRILLIC))
    listed = listed.when(female, at(FEMALE)).otherwise(at(MALE))
    ending = F.when(cyrillic & female, "а").when(cyrillic, "").when(female, "a").otherwise("o")
    first = F.when(draw < NARROW_DRAWS, listed).otherwise(F.concat(_syllables(noise, cyrillic, more + 3), ending))
    family = _syllables(F.col("family"), cyrillic, F.when(F.instr(canonical, " ") > 0, 8).otherwise(more + 8))
    return F.when(F.instr(canonical, " ") > 0, F.concat_ws(" ", first, family)).otherwise(family)


def with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Adds ``drawn``, the canonical surrogate of (kind, canonical) for its draw; the noise is made once a row."""
    kind, canonical, draw = F.col("kind"), F.col("canonical"), F.col("draw")
    full = F.instr(canonical, " ") > 0
    last = F.substring_index(canonical, " ", -1)
    named = kind.isin("name_f", "name_m")
    noisy = entities.withColumn("noise", _noise(kind, canonical, draw, key)).withColumn(
        "family", F.when(named, _noise(F.lit("family"), last, F.when(full, 0).otherwise(draw), key))
    )
    domain = F.substring_index(canonical, "@", -1)
    noisy = noisy.withColumn("domain", F.when(kind == "email", _noise(F.lit("domain"), domain, F.lit(0), key)))
    return noisy.withColumn("drawn", _surrogate(kind, canonical, draw, F.col("noise"))).drop("noise", "family", "domain")


def _surrogate(kind: Column, canonical: Column, draw: Column, noise: Column) -> Column:
    more = F.greatest(draw - (NARROW_DRAWS - 1), F.lit(0)) * WIDER
    letters, zeros = F.repeat(F.lit("a"), more), F.repeat(F.lit("0"), more)
    behind = lambda n: F.substring(canonical, F.lit(n + 1), F.length(canonical))
    local, shared = F.substring_index(canonical, "@", 1), F.col("domain")
    ending = F.element_at(F.array(*map(F.lit, ("example.com", "example.net", "example.org"))), F.pmod(shared[63], F.lit(3)) + 1)
    email = F.concat(_shaped(F.concat(local, letters), noise), F.lit("@"), _shaped(F.lit("a" * 10), shared), F.lit("."), ending)
    octets = F.concat_ws(".", *[(F.pmod(noise[j], F.lit(254)) + 1).cast("string") for j in range(4)])
    octets = F.when(more > 0, F.concat_ws(".", octets, _shaped(zeros, noise))).otherwise(octets)
    groups = F.concat_ws(":", F.lit("2001:0db8"), *[F.lower(F.lpad(F.hex(noise[j]), 4, "0")) for j in range(6)])
    # the first digit of a card names its issuer, the last one checks the others
    body = F.concat(F.substring(canonical, 1, 1), _shaped(F.concat(F.substring(canonical, F.lit(2), F.length(canonical) - 2), zeros), noise))
    right = F.right(canonical, F.lit(1)).try_cast("int") == _luhn(F.substring(canonical, F.lit(1), F.length(canonical) - 1))
    check = F.when(right, _luhn(body)).otherwise(F.pmod(_luhn(body) + 1 + F.pmod(noise[63], F.lit(9)), F.lit(10)))
    country, account = F.substring(canonical, 1, 2), _shaped(F.concat(behind(4), zeros), noise)
    return (
        F.when(kind == "email", email)
        .when(kind == "ipv4", octets)
        .when(kind == "ipv6", groups)
        .when(kind == "card", F.concat(body, check.cast("string")))
        .when(kind == "iban", F.concat(country, _iban_check(country, account), account))
        .when(kind == "token", _hex_shaped(F.concat(canonical, zeros), noise))
        .when(kind == "aws_key", F.concat(F.substring(canonical, 1, 4), _shaped(F.concat(behind(4), F.upper(letters)), noise)))
        .when(kind.isin("name_f", "name_m"), _name(noise, canonical, kind == "name_f", draw, more))
        .when(kind.isin("ssn", "phone"), _shaped(F.concat(canonical, zeros), noise))
        .otherwise(_shaped(F.concat(canonical, letters), noise))
    )


def _written(surface: Column, kind: Column, real: Column, canonical: Column) -> Column:
    """The surrogate in the layout of the surface: as many digits as the real form ``real`` has fill its
    digit places from the right, those that a later draw has added follow.
    """
    chars = F.split(surface, "")
    n = F.length(real)
    after = lambda i: F.length(F.regexp_replace(F.substring(surface, i + 2, F.length(surface)), r"\D", ""))
    place = lambda i: n - after(i)
    laid = F.array_join(
        F.transform(
            chars,
            lambda ch, i: F.when(
                F.regexp_like(ch, F.lit("[0-9]")) & (place(i) >= 1), F.substring(canonical, place(i), F.lit(1))
            ).otherwise(ch),
        ),
        "",
    )
    laid = F.concat(laid, F.substring(canonical, n + 1, F.length(canonical)))
    spaced = F.when(F.instr(surface, " ") > 0, F.regexp_replace(canonical, "(.{4})(?=.)", "$1 ")).otherwise(canonical)
    title = F.regexp_extract(surface, _TITLE, 0)
    # a token in capitals stays so, one of both cases has capitals where its surface has them
    cased = F.array_join(
        F.transform(
            F.split(canonical, ""),
            lambda ch, i: F.when(F.regexp_like(F.get(chars, i), F.lit("[A-F]")), F.upper(ch)).otherwise(ch),
        ),
        "",
    )
    cased = F.when(surface == F.lower(surface), canonical).when(surface == F.upper(surface), F.upper(canonical)).otherwise(cased)
    return (
        F.when(kind.isin("card", "ssn", "phone"), laid)
        .when(kind.isin("name_f", "name_m"), F.concat(title, canonical))
        .when(kind == "token", cased)
        .when(kind == "iban", spaced)
        .when(kind == "ipv6", F.regexp_replace(canonical, r"(?<![0-9a-f])0{1,3}(?=[0-9a-f])", ""))
        .otherwise(canonical)
    )


def surrogate_map(surfaces: DataFrame, key: str = KEY) -> DataFrame:
    """(surface, kind, replacement) for distinct surfaces; no two entities of a kind share a surrogate.

    Every draw settles the entities whose surrogate nobody holds. Spaces of surrogates grow with the draws,
    so a few rounds settle any number of entities.
    """
    kind = kind_of(F.col("surface"))
    known = surfaces.select("surface", kind.alias("kind")).withColumn("canonical", _canonical(F.col("surface"), F.col("kind")))
    known = staged(known, "pii-surfaces")
    entities = staged(known.select("kind", "canonical").distinct(), "pii-entities")
    # a surrogate may be no real entity and none that an earlier draw has given away
    held = entities.select("kind", F.col("canonical").alias("drawn"))
    settled, open_rows, draw = None, entities, 0
    while True:
        drawn = with_surrogates(open_rows.withColumn("draw", F.lit(draw)), key).join(held, ["kind", "drawn"], "left_anti")
        # of several entities that drew one surrogate the first by canonical form keeps it
        good = staged(drawn.groupBy("kind", "drawn").agg(F.min("canonical").alias("canonical")), "pii-drawn")
        settled = good if settled is None else settled.unionByName(good)
        open_rows = staged(open_rows.join(good, ["kind", "canonical"], "left_anti"), "pii-open")
        if open_rows.isEmpty():
            written = _written(F.col("surface"), F.col("kind"), F.col("canonical"), F.col("drawn"))
            return known.join(settled, ["kind", "canonical"]).select("surface", "kind", written.alias("replacement"))
        held, draw = held.unionByName(good.select("kind", "drawn")), draw + 1


def replace_entities(docs: DataFrame, key: str = KEY, count_col: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with every entity in ``text_col`` replaced; ``count_col`` adds the number of them per row.

    Texts without entities, null and empty ones pass unchanged with count 0. Repeated rows and texts
    are replaced alike. Other columns may have any names. An empty table gives an empty result.
    """
    text, pattern = F.col(text_col), F.lit(PATTERN)
    found, mark, key_col, new = (free_name(docs.columns, n) for n in ("_found", "_mark", "_key", "_new"))
    # one pass of the pattern over all texts; what it found is written beside them
    read = docs.withColumn(found, F.coalesce(F.regexp_extract_all(text, pattern, F.lit(0)), F.array().cast("array<string>")))
    read = staged(read.withColumn(mark, F.when(F.size(found) > 0, F.md5(text))), "pii-docs")
    tagged = read.where(F.col(mark).isNotNull())
    texts = tagged.groupBy(F.col(mark).alias("mark")).agg(F.min(F.col(found)).alias("found"))
    places = texts.select("mark", F.posexplode("found").alias("pos", "surface"))
    # one surface may stand in most texts, so its places are dealt over copies of its row
    places = places.withColumn("salt", F.pmod(F.xxhash64("mark"), F.lit(SALTS)))
    mapped = surrogate_map(places.select("surface").distinct(), key)
    mapped = mapped.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "replacement")))
    lists = places.join(mapped, ["surface", "salt"]).groupBy(F.col("mark").alias(key_col)).agg(
        F.transform(ordered, lambda s: s["replacement"]).alias(new)
    )
    parts = F.split(text, PATTERN, -1)
    joined = F.array_join(
        F.zip_with(parts, F.col(new), lambda p, r: F.concat(F.coalesce(p, F.lit("")), F.coalesce(r, F.lit("")))), ""
    )
    met = tagged.join(lists, F.col(mark) == F.col(key_col))
    columns = [joined.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    plain = read.where(F.col(mark).isNull())
    if count_col:
        columns.append(F.size(found).cast("bigint").alias(count_col))
        plain = plain.withColumn(count_col, F.lit(0).cast("bigint"))
    return met.select(*columns).unionByName(plain.drop(found, mark))
