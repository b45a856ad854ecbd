"""Personal data: linear finders against plain regular expressions."""
import random
import re

import pytest

from fillbook.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def confirm(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in s.split(".")),
            "card": 14 <= len(d) <= 19 and brute_luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def brute(text):
    found = [(m.start(), n, m.end()) for n, (k, p) in enumerate(PLAIN.items())
             for m in re.finditer(p, text) if confirm(k, m.group())]
    return sorted(found)


@pytest.mark.parametrize("seed", range(40))
def test_base_spans_equal_plain_patterns(seed):
    r = random.Random(seed)
    parts = ["a", "Z9", "@", ".", "-", "+", " ", "(", ")", "1", "0", "255", "256", "4111111111111111", "é", "\n",
             "1.2.3.4", "x@y.zz", "+1 (722) 555-8977", "_", "%", "7", "00"]
    text = "".join(r.choice(parts) for _ in range(r.randint(0, 400)))
    got = [(a, k, b) for a, k, b, _ in pii.find_spans(text) if k < pii.BASE_KINDS]
    assert got == brute(text)


def test_long_runs_are_linear():
    for c in ("a", "1", "1.", "@", "a@", "+1", "(", "1 "):
        pii.find_spans(c * 300_000)
    assert pii.find_spans(None) == [] and pii.find_spans("") == []


def test_checksums_and_context():
    assert [k for _, k, _, _ in pii.find_spans("IBAN DE89 3704 0044 0532 0130 00 end")] .count(pii.KINDS.index("iban")) == 1
    assert not any(k == 4 for _, k, _, _ in pii.find_spans("DE88 3704 0044 0532 0130 00"))
    assert any(k == 5 for _, k, _, _ in pii.find_spans("her ssn is 123-45-6789."))
    assert not any(k == 5 for _, k, _, _ in pii.find_spans("code 123-45-6789."))


def test_mask():
    t = "mail a@b.cc or +1 (722) 555-8977."
    assert pii.mask(t, pii.find_spans(t)) == "mail <EMAIL> or <PHONE>."


def test_query_edges(spark):
    df = spark.createDataFrame([(1, None, "s"), (1, "", "s"), (2, "x@y.zz", None), (2, "x@y.zz", None)],
                               "doc_id long, text string, spans string")
    rows = pii.find_pii(df).orderBy("doc_id").collect()
    assert [len(x.spans) for x in rows] == [0, 0, 1, 1]
    assert pii.find_pii(df.limit(0)).count() == 0
    masked = pii.mask_pii(df).collect()
    assert {x.text for x in masked} == {None, "", "<EMAIL>"} and masked[0].spans == "s"
