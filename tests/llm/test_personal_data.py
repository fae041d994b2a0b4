"""Base spans against the plain expressions on hard and random texts, added kinds, bounds of time."""

import hashlib
import random
import re
import time

import pytest
from conftest import SF
from edge_rows import edge, nothing  # noqa: F401

from arenamart.llm import personal_data as p

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(x) if i % 2 == 0 else (int(x) * 2 - 9 if int(x) > 4 else int(x) * 2) for i, x in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text, out = text or "", []
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def base(text):
    return [s for s in p.find_spans(text) if s[1] < 4]


HARD = [
    "a@b.c@d.e", "a@b@c.d", "@x.y", "a@.b", "a@b.", "a@b..c", "a@b.c.", ".a+%@-.-", "x@y.z_w@q.r", "ä@b.cé", "a@b.c-@d.e.f",
    "1.2.3.4.5", "1.2.3.4.5.6.7.8.9", "1.2.3", "256.1.1.1", "0001.002.3.0255", "1.2.3.4 5.6.7.8", "..1.2.3.4..", "999999999999999999999.1.1.1.1.1.1.1",
    "4111 1111-1111 1111", "4111  1111 1111 1111", "4111--111111111111", "1-4111111111111111", "0000000000000", "12 34", "3 4 5 6-7",
    "+1 (377) 555-0271", "+49 30 123456", "+12", "+1  2", "+1-------------9", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "+1+23 456 789 01", "++491234567890.", "+1 () 5",
    "", " ", "😀a@b.c😀+1 234 567 890😀 192.168.0.1", "a@b.c" * 3, "+1.2.3.4 5.6.7.8 1111",
]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    assert base(text) == brute(text)


def test_random_texts():
    rng = random.Random(5)
    for letters in ("a1.@-+ ", "0123456789.- +()", "ab@.-_%1é", "4 1-0", "12.5+ "):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
            assert base(text) == brute(text), text


def added(text):
    return [(p.KINDS[k], text[s:e]) for s, k, e in p.find_spans(text) if k > 3]


def test_added_kinds():
    assert added("see ftp://bob:pw@host.example:21/x") == [("url", "ftp://bob:pw@host.example:21")]
    assert added("https://host.example/a@b") == []
    assert added("http://[2001:db8::1]/ and http://[1:2]/") == [("ip6", "2001:db8::1")]
    assert added("IBAN: DE89 3704 0044 0532 0130 00 ok") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("iban GB82WEST12345698765432 iban GB82WEST12345698765433") == [("iban", "GB82WEST12345698765432")]
    assert added("SSN: 123-45-6789, ssn 000-45-6789, SSN no. 123-45-67890") == [("ssn", "123-45-6789")]
    assert added("Account number: 0012 3456 78; account 2019; konto nr. 123456") == [("account", "0012 3456 78"), ("account", "123456")]
    assert added("an account of the Social Security act, iban, compte") == []


@pytest.mark.parametrize("unit", ["a", "a@", "1.", "1 ", "+1", "+1 ", "a.@a.", "://", "a://b", "iban ", "IBAN DE89 ", "account no ", "1-", "@a-", "ssn: "])
def test_long_texts_take_linear_time(unit):
    def seconds(size):
        text = unit * (size // len(unit))
        start = time.process_time()
        p.find_spans(text)
        return time.process_time() - start

    seconds(1000)
    assert seconds(400_000) < 30 * max(0.01, seconds(40_000))


def test_edges(spark, edge, nothing):  # noqa: F811
    got = p.spans_of(edge).collect()
    assert len(got) == edge.count() and not any(r.spans for r in got)
    assert p.spans_of(nothing).count() == 0
    assert sorted(p.redact(edge).collect(), key=str) == sorted(edge.collect(), key=str)
    row = spark.createDataFrame([(None, "mail a@b.co or +1 234 567 8901!", "k"), (7, None, "k")], "doc_id bigint, text string, spans string")
    assert p.redact(row).collect() == [(None, "mail <EMAIL> or <PHONE>!", "k"), (7, None, "k")]


def test_query(spark):
    rows = p.op13_personal_data(spark, SF)
    assert rows.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = {r.doc_id: r for r in rows.collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(got) == set(texts) and any(r.n_card for r in got.values())
    for doc_id, text in texts.items():
        spans, r = brute(text), got[doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        listed = ",".join(f"{p.BASE[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.spans == ",".join(f"{p.KINDS[k]}:{s}:{e}" for s, k, e in p.find_spans(text))
