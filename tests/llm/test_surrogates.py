"""Surrogates of personal data beside plain Python checks: crowded kinds, check digits, layouts, coreference."""

from __future__ import annotations

import ipaddress
import re

from joblattice.llm import pii

IBANS = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606"]


def _luhn(number: str) -> bool:
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def _iban(number: str) -> bool:
    bare = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def _map(spark, surfaces):
    frame = spark.createDataFrame([(s,) for s in surfaces], "surface string").distinct()
    return {r.surface: (r.kind, r.replacement) for r in pii.surrogate_map(frame).collect()}


def test_crowded_kinds_never_run_out(spark):
    """More entities than surrogates of their own length, in every kind whose length gives few of them."""
    surfaces = [f"{c}@site{i}.org" for i in range(200) for c in "abcdefghijklmnopqrstuvwxyz"][:5000]
    surfaces += [f"{chr(97 + i % 26)}@one.org" for i in range(26)] + ["_@one.org", "a@two.org"]
    surfaces += [f"{i:04d}" for i in range(0, 10_000, 2)] + ["****", "----"]
    surfaces += [f"Mr. {chr(65 + i)}{chr(97 + j)}o Poe" for i in range(26) for j in range(26)]
    found = _map(spark, surfaces)
    assert set(found) == set(surfaces)
    per_kind: dict[str, list[str]] = {}
    for kind, new in found.values():
        per_kind.setdefault(kind, []).append(re.sub(pii._TITLE, "", new))
    assert all(len(set(new)) == len(new) for new in per_kind.values()) and set(per_kind) == {"email", "password", "name_m"}
    assert not {new for _, new in found.values()} & set(surfaces)
    assert all(re.fullmatch(r"\S+@[a-z]{10}\.example\.(com|net|org)", new) for kind, new in found.values() if kind == "email")
    families = {new.split(" ")[2] for kind, new in found.values() if kind == "name_m"}
    assert len(families) == 1


def test_persons_of_one_domain_share_a_domain(spark):
    found = _map(spark, ["ann@corp.com", "bob.hale@corp.com", "Ann@Corp.com", "ann@else.com"])
    domain = {old: new.split("@")[1] for old, (_, new) in found.items()}
    assert domain["ann@corp.com"] == domain["bob.hale@corp.com"] != domain["ann@else.com"]
    assert found["ann@corp.com"] == found["Ann@Corp.com"]


def test_check_digits_and_layouts(spark):
    cards = ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "5500005555555559", "1234567890123456"]
    found = _map(spark, cards + IBANS)
    for card in cards:
        kind, new = found[card]
        assert kind == "card" and _luhn(new) == _luhn(card) and new[0] == card[0]
        assert new != card and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", card)
    assert found[cards[0]][1].replace(" ", "") == found[cards[1]][1]
    for iban in IBANS:
        kind, new = found[iban]
        assert kind == "iban" and _iban(iban) and _iban(new) and new[:2] == iban[:2] and new != iban
        assert re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", new)) == re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", iban))
    assert found[IBANS[0]][1].replace(" ", "") == found[IBANS[1]][1]


def test_ipv6_in_any_writing(spark):
    surfaces = ["2001:db8::1", "2001:0db8:0:0:0:0:0:1", "fe80::1ff:fe23:4567:890a", "1:2:3:4:5:6:7:8"]
    found = _map(spark, surfaces)
    assert {kind for kind, _ in found.values()} == {"ipv6"}
    assert found[surfaces[0]] == found[surfaces[1]] and len({new for _, new in found.values()}) == 3
    assert all(ipaddress.IPv6Address(new) in ipaddress.ip_network("2001:db8::/32") for _, new in found.values())


def test_whole_entities_in_texts(spark):
    texts = [
        "pay DE89 3704 0044 0532 0130 00, card 4111 1111 1111 1111.",
        "from 2001:db8::17 at 12:30:45, std::vector, ratio 3::x, AB12 IS A ROOM",
        "a@x.org b@x.org a@x.org",
        "ünï4111111111111111 x+1 (988) 555-2485 z",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in pii.replace_entities(docs, count_col="n").collect()}
    assert [out[i].n for i in range(4)] == [2, 1, 3, 2]
    assert not re.search(r"0130|0532|3704|4111", out[0].text) and _iban(re.search(r"DE[\d ]+\d", out[0].text)[0])
    assert out[1].text.split(" at ")[1] == texts[1].split(" at ")[1] and "db8::17" not in out[1].text
    first, second, third = out[2].text.split(" ")
    assert first == third != second
    assert "4111111111111111" not in out[3].text and "555-2485" not in out[3].text


def test_one_surface_in_most_texts(spark):
    """A frequent surface keeps one surrogate, and texts that differ only around it stay whole."""
    docs = spark.createDataFrame([(i, f"page {i} by team@corp.com, line {i}") for i in range(2000)], "doc_id long, text string")
    out = [r.text for r in pii.replace_entities(docs).orderBy("doc_id").collect()]
    assert len({t.split(" ")[3] for t in out}) == 1 and [re.sub(r" \S+@\S+ ", " X ", t) for t in out] == [
        f"page {i} by X line {i}" for i in range(2000)
    ]
