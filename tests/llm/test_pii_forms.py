"""Forms of IBANs and telephone numbers."""

import re

import pytest
from pyspark.sql import functions as F

from paceline.llm import pii
from paceline.llm.pii import replace_pii

IBANS = ["GB29 NWBK 6016 1331 9268 19", "NL91 ABNA 0417 1643 00", "FR14 2004 1010 0505 0001 3M02 606", "DE89 3704 0044 0532 0130 00", "ES91 2100 0418 4502 0005 1332", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "NO93 8601 1117 947", "BE68 5390 0754 7034"]
PHONES = ["01 23 45 67 89", "01.23.45.67.89", "0123456789", "+33 6 12 34 56 78", "+33 (0)6 12 34 56 78", "+49 30 1234567", "+49 (0)30 1234567", "+49 (30) 1234567", "030 1234567", "030/1234567", "(030) 1234567", "0171-1234567", "0171 123 45 67", "030 12345-67", "+34 612 34 56 78", "612 34 56 78", "+34 91 123 45 67", "91 123 45 67", "+44 7911 123456", "07911 123456", "+44 20 7946 0958", "+1 (017) 555-7713", "+41 44 668 18 00", "+4930123456789"]
SHAPE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "A" * 26 + "0" * 10)


def test_every_form_is_replaced_whole(spark):
    values = IBANS + [x.replace(" ", "") for x in IBANS] + PHONES
    plain = ["2024-01-15 10:30:45", "from 1990 to 2024", "3.14159", "12345", "AB12 CDEF GHIJ", "GB29 NWBK", "10 20 30", "1,234,567 words"]
    rows = [(i, f"see {v}, and more. {v}") for i, v in enumerate(values + plain)]
    out = {r.doc_id: r for r in replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    made = {}
    for i, v in enumerate(values):
        m = re.fullmatch(r"see (.+), and more\. (.+)", out[i].text)
        kind = out[i].n_iban if i < 2 * len(IBANS) else out[i].n_phone
        assert m and m[1] == m[2] and kind == out[i].n_entities == 2, (v, out[i])
        assert m[1] != v and m[1].translate(SHAPE) == (v[:2] + v[2:].translate(SHAPE) if v in values[: 2 * len(IBANS)] else v).translate(SHAPE)
        if kind == out[i].n_iban:
            assert m[1][:2] == v[:2]
        made[v] = m[1]
    assert all(made[x].replace(" ", "") == made[x.replace(" ", "")] for x in IBANS)
    assert all(out[len(values) + i].text == rows[len(values) + i][1] for i in range(len(plain)))


KEPT = ["Das kostet 10.000.000 Euro", "12 345 678 Einwohner", "in 2019-2020-2021", "1.234.567,89 EUR", "Zahlen 100 200 300", "pages 120-135-150", "v10.200.3000", "3.141.592.653", "1 000 000 000 F", "99.999.999", "2,500,000.00 dollars", "years 1914-1918, 1939-1945", "ISBN 978 306 406", "10.12.2024", "0.123.456 of it", "size 200.300.400", "12.345.678-9"]
CALLED = ["+1 (017) 555-7713", "(415) 555-2671", "415-555-2671", "415.555.2671", "415 555 2671", "+49 170 123 4567", "0171 555 1234", "+33 123 456 789", "(0171) 555 1234"]


def test_numbers_that_are_no_telephones_stay(spark):
    rows = [(i, f"so {t} it is") for i, t in enumerate(KEPT + CALLED)]
    out = {r.doc_id: r for r in replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    for i, _ in enumerate(KEPT):
        assert out[i].text == rows[i][1] and out[i].n_entities == 0
    for i, v in enumerate(CALLED, len(KEPT)):
        assert out[i].n_phone == 1 and v not in out[i].text, v


def test_a_full_space_of_addresses_grows(spark):
    mails = [f"{a}@{b}.co" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    out = [r.text[2:] for r in replace_pii(spark.createDataFrame([(i, f"x {m}") for i, m in enumerate(mails)], "doc_id long, text string"), "k").collect()]
    assert len(set(out)) == len(mails) and not set(out) & set(mails)
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.co", m) for m in out)


@pytest.mark.parametrize("n", [2, 700])
def test_a_full_space_of_numbers_is_permuted(spark, monkeypatch, n):
    """Every draw fails, as where a corpus has all numbers of a shape: the real ones change places."""
    whole = pii._surrogate
    monkeypatch.setattr(pii, "_surrogate", lambda kind, canonical, digest, grown=0: F.when(kind == "ssn", F.lit("000000000")).otherwise(whole(kind, canonical, digest, grown)))
    monkeypatch.setattr(pii, "MAX_ROUNDS", 3)
    real = [f"{100 + i % 800:03d}-{10 + i % 80:02d}-{1000 + i:04d}" for i in range(n)]
    rows = [(i, f"x {v} y {v}") for i, v in enumerate(real)] + [(n, "x 1.2.3.4")]
    out = {r.doc_id: r.text for r in replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    new = [out[i].split()[1] for i in range(n)]
    assert sorted(new) == sorted(real) and all(a != b for a, b in zip(new, real, strict=True))
    assert all(out[i].split()[1] == out[i].split()[3] for i in range(n)) and "1.2.3.4" not in out[n]


def test_nothing_readable_is_kept_in_the_shared_folder(spark, monkeypatch):
    seen = []
    keep = pii.stored

    def looked_at(df, name):
        out = keep(df, name)
        seen.append((name, " ".join(str(r) for r in out.collect())))
        return out

    monkeypatch.setattr(pii, "stored", looked_at)
    replace_pii(spark.createDataFrame([(1, "Mr John Smith, j.smith@mail.example.com, +1 (017) 555-7713")], "doc_id long, text string"), "k").collect()
    assert {n for n, _ in seen} >= {"pii-found", "pii-map", "pii-masked"}
    assert not any(x in t for _, t in seen for x in ("Smith", "smith", "555-7713", "0175557713"))
