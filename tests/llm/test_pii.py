import re

import pytest

from larderlake.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return sorted(out)


TEXTS = [
    "write to é.a.b@c-d.e.f_g@h.i, a@b.c@d.e and x@y",
    "10.0.0.1 256.1.1.1 1.2.3.4.5 007.8.9.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111111111 5500 0000 0000 0004.",
    "+1 (743) 555-3824 +12345678 +49 30.1234567- \U0001f600 +1 234 567 890 123 456",
    "",
    None,
    "1" * 50_000,
    "a." * 50_000 + "@b.c",
    "IBAN: DE89 3704 0044 0532 0130 00, DE89 3704 0044 0532 0130 01, GB82WEST12345698765432",
    "call 212-555-0123 but not the sum 212-555-0199" + " " * 60 + "my ssn is 123-45-6789",
]


def test_base_spans_equal_plain_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    for r in pii.find_pii(docs).collect():
        base = sorted((s.kind, s.start, s.end) for s in r.pii if s.kind in pii.BASE)
        assert base == brute(TEXTS[r.doc_id])


def test_added_kinds_need_checksum_or_context(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    found = {r.doc_id: [(s.kind, TEXTS[r.doc_id][s.start : s.end]) for s in r.pii] for r in pii.find_pii(docs).collect()}
    assert found[8] == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert ("ssn", "123-45-6789") in found[9] and ("local_phone", "212-555-0123") in found[9]
    alone = spark.createDataFrame([(0, "212-555-0123 and 123-45-6789")], "doc_id int, text string")
    assert pii.find_pii(alone).first().pii == []


def test_account_numbers_before_words_and_numbers(spark):
    numbers = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "DE89370400440532013000"]
    texts = [f"{n}{after}" for n in numbers for after in ("", " Please", " A", " BIC X", " 12", " 2023 was", ".", "\n1")]
    texts += [" ".join(numbers), "AB12" * 20_000, "GB82WEST12345698765432and", "BE68 5390 0754 7035 Danke"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.pii if s.kind == "iban"] for r in pii.find_pii(docs).collect()}
    expected = [[n] for n in numbers for _ in range(8)] + [numbers, [], ["GB82WEST12345698765432"], []]
    assert [found[i] for i in range(len(texts))] == expected
    assert pii.redact(docs.where("doc_id = 1")).first().text == "<IBAN> Please"


@pytest.mark.parametrize("text", TEXTS[:6])
def test_redacted_texts_hold_nothing(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    clean = pii.redact(docs).first().text
    assert brute(clean) == [] and (clean == text or brute(text))


def test_awkward_tables(awkward, nothing):
    clean = pii.redact(awkward)
    assert clean.columns == awkward.columns
    assert clean.exceptAll(awkward).count() == 0 and clean.count() == awkward.count()
    assert pii.redact(nothing).count() == 0
