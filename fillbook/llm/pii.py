"""Operator 2, personal data: patterns propose, checksums confirm, context scores.

Every kind has a linear-time pattern that proposes spans, a validator that
confirms them (octet range, Luhn, digit count, mod-97) and a base score; words
near the span raise or lower the score. The four base kinds (e-mail, IP
address, card, phone) stay whatever their score; the further kinds count only
from ``MIN_SCORE`` on. Whole texts are searched inside ``mapInArrow`` tasks
(no shuffle); positions are code points, end exclusive.

Defined results: a null text counts as empty and has no spans; spans of
different kinds may overlap; matches that fail their validator are dropped and
not retried; repeated rows give repeated results; extra input columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import frugal, register, table

#: Kinds in listing order; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = 4
MIN_SCORE = 0.5
CONTEXT_CHARS = 48
CONTEXT_STEP = 0.35

# Scores of a confirmed span without context, and the words that
# raise or lower it.
BASE_SCORE = {"email": 0.95, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.85, "ssn": 0.3}
RAISES = {
    "email": "email mail contact correo courriel kontakt",
    "ip": "ip host server address adresse",
    "card": "card visa mastercard credit tarjeta carte karte kreditkarte",
    "phone": "phone tel call mobile fax telefon telephone telefono",
    "iban": "iban account bank konto compte cuenta bic swift",
    "ssn": "ssn social security",
}
LOWERS = {
    "email": "example", "ip": "version release", "card": "isbn order serial", "phone": "order serial",
    "iban": "serial", "ssn": "part serial version",
}

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins: the rest of the run
# would have to meet the same text after it. Possessive runs keep it linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_WORD = re.compile("[a-z]+")


def luhn(digits: str) -> bool:
    """Whether the digit string has a valid Luhn check digit."""
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account code has valid ISO 7064 check digits."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str):
    """Spans of e-mail addresses, found from each ``@`` outwards.

    The local part is the run left of the ``@``; it may not reach into the
    match before it. Runs end at any ``@``, so the work is linear.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        i = at
        while i > done and text[i - 1] in _LOCAL_CHARS:
            i -= 1
        m = _DOMAIN.match(text, at + 1) if i < at else None
        if m:
            yield i, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _octets(s: str) -> bool:
    return all(len(p := x.lstrip("0")) < 4 and int(p or 0) < 256 for x in s.split("."))


def _digits(s: str) -> str:
    return _NOT_DIGIT.sub("", s)


def _is_card(s: str) -> bool:
    return 14 <= len(d := _digits(s)) <= 19 and luhn(d)


def _is_phone(s: str) -> bool:
    return 10 <= len(_digits(s)) <= 15


def _is_iban(s: str) -> bool:
    return 15 <= len(c := s.replace(" ", "")) <= 34 and mod97(c)


def _is_ssn(s: str) -> bool:
    a, b, c = s.split("-")
    return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"


_PATTERNS = (("ip", _IP, _octets), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone),
             ("iban", _IBAN, _is_iban), ("ssn", _SSN, _is_ssn))
_RAISE = {k: frozenset(v.split()) for k, v in RAISES.items()}
_LOWER = {k: frozenset(v.split()) for k, v in LOWERS.items()}


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = set(_WORD.findall(f"{text[max(0, start - CONTEXT_CHARS):start]} {text[end:end + CONTEXT_CHARS]}".lower()))
    s = BASE_SCORE[kind] + CONTEXT_STEP * (not near.isdisjoint(_RAISE[kind])) - CONTEXT_STEP * (not near.isdisjoint(_LOWER[kind]))
    return min(1.0, max(0.0, s))


def find_spans(text: str | None) -> list[tuple[int, int, int, float]]:
    """(start, kind number, end, score) of every span of a text, in order."""
    if not text:
        return []
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(k, m.start(), m.end()) for k, p, ok in _PATTERNS
                  if k != "phone" or "+" in text for m in p.finditer(text) if ok(m.group())]
    out = [(a, KINDS.index(k), b, _score(text, k, a, b)) for k, a, b in found]
    return sorted(x for x in out if x[1] < BASE_KINDS or x[3] >= MIN_SCORE)


def mask(text: str | None, spans) -> str | None:
    """The text with every span replaced by its kind in angle brackets.

    Overlapping spans are one replacement, named after the first of them.
    """
    if not text or not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end, _ = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = end
    return "".join([*out, text[at:]])


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("score", pa.float64())])
_DDL = "array<struct<start:bigint,kind:string,end:bigint,score:double>>"


def _span_batch(batches):
    for b in batches:
        spans = [[{"start": a, "kind": KINDS[k], "end": e, "score": s} for a, k, e, s in find_spans(t)]
                 for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(_SPAN))], names=["id", "spans"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and its spans in order of start and kind."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(_span_batch, f"id {kind}, spans {_DDL}")
    return rows.withColumnRenamed("id", id_col)


def _mask_batch(batches):
    for b in batches:
        texts = [mask(t, find_spans(t)) for t in b.column("text").to_pylist()]
        at = b.schema.get_field_index("text")
        yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))


def mask_pii(docs: DataFrame) -> DataFrame:
    """The same rows and columns with the spans of ``text`` masked."""
    return docs.mapInArrow(frugal(_mask_batch), docs.schema)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register("op2_pii")
def op2_pii(spark, sf_dir) -> DataFrame:
    """Personal data in every whole text of ``documents``: counts, digest, spans."""
    found = find_pii(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*KINDS[:BASE_KINDS]))
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:BASE_KINDS]],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
        *[count(k).alias(f"n_{k}") for k in KINDS[BASE_KINDS:]],
        F.array_min(F.transform(spans, lambda s: s["score"])).alias("lowest_score"))
