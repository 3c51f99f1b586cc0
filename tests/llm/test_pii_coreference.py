"""Coreference of names, check digits, long secrets and decoys of personal data."""

import re

from paceline.llm.pii import replace_pii


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_names_are_replaced_word_by_word(spark):
    rows = [(1, "Mr John Smith met Mr Smith, Mrs Smith and Dr Alice Smith. Then Mr JOHN SMITH left; Prof. Alice Brown and Mrs Mary Ann Brown stayed."), (2, "Frau Иванова")]
    out = {r.doc_id: r for r in replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    m = re.fullmatch(r"Mr (\w+) (\w+) met Mr (\w+), Mrs (\w+) and Dr (\w+) (\w+)\. Then Mr (\w+) (\w+) left; Prof\. (\w+) (\w+) and Mrs (\w+) (\w+) (\w+) stayed\.", out[1].text)
    given, family, alone, hers, alice, also, loud, louder, again, brown, mary, ann, last = m.groups()
    assert family == alone == hers == also and louder == family.upper() and loud == given.upper()
    assert alice == again and brown == last != family and given.endswith("n") and mary.endswith("a") and ann.endswith("a")
    assert out[1].n_male == 3 and out[1].n_female == 2 and out[1].n_person == 2 and out[2].text.endswith("а")


def test_check_digits_hold_and_decoys_stay(spark):
    cards = ["4845168114407329", "4539 1488 0343 6467"]
    ibans = ["GB29 NWBK 6016 1331 9268 19", "FR1420041010050500013M02606"]
    secrets = ["sk-" + "aB3" * 50, "f3" * 80, "ghp_" + "Zx9" * 60, "fe80::1ff:fe23:4567:890a", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "x" * 90 + "@mail.example.com"]
    plain = ["9780306406157", "1700000000123", "9807915762804490", "12:30:45", "std::move", "a::b"]
    values = cards + ibans + secrets + plain
    rows = [(i, f"a {v} b") for i, v in enumerate(values)] + [(None, f"99|a {values[0]} b"), (99, f"a {values[0]} b")]
    out = {r.doc_id: r.text for r in replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    new = [out[i][2:-2] for i in range(len(values))]
    for i in range(2):
        assert new[i] != values[i] and luhn(re.sub(r"\D", "", new[i])) == 0 and re.sub(r"\d", "0", new[i]) == re.sub(r"\d", "0", values[i])
        assert new[2 + i] != values[2 + i] and mod97(new[2 + i].replace(" ", "")) == 1
    for i in range(4, 10):
        assert new[i] != values[i] and len(new[i]) == len(values[i]) and values[i][5:15] not in new[i]
    assert new[10:] == plain
    assert out[None] == "99|" + out[99]


def test_very_long_text(spark):
    body = "word " * 200_000
    rows = [(1, body + "a.b@c.com"), (2, body)]
    out = {r.doc_id: r for r in replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert out[1].text.startswith(body) and out[1].n_email == 1 and "a.b@c.com" not in out[1].text and out[2].text == body
