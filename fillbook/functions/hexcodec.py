"""Hex / integer codecs for raw chain logs, as plain built-in expressions.

uint256 words do not fit any Spark numeric type (DECIMAL tops out at 38
digits, ``conv`` at 64 bits). ``uint256_decimal`` multiplies the 24-bit parts of
a word with the powers of 2^24, cut into limbs of ten decimal digits: every sum
of products stays below 2^63, so BIGINT holds it exactly, and one pass of
carries gives the digits. No lambda, no Python: the expression is compiled into
the query's generated code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of a part (11 parts), decimal digits of a limb, limbs of a word (8 x 10 >= 78 digits of 2^256).
PART, LIMB, LIMBS = 6, 10, 8


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hex_word(data, k: int) -> Column:
    """k-th 32-byte word (64 hex chars) of an ABI payload, with or without
    ``0x``: one substring at a computed offset (no copy of the payload)."""
    d = _c(data)
    start = F.when(F.startswith(d, F.lit("0x")), F.lit(3)).otherwise(F.lit(1)) + F.lit(64 * k)
    return F.substr(d, start, F.lit(64))


def uint256_decimal(word) -> Column:
    """64 hex chars (one uint256) -> exact decimal text. A null word is null;
    any other text than 64 hex digits is an error, as a wrong id would pass unseen."""
    w = F.lower(_c(word))
    strange = (F.length(w) != 64) | (F.translate(w, "0123456789abcdef", "") != "")
    # The check stands inside, not around: what is shared below must not be conditional, or each use would compute it anew.
    w = F.when(strange, F.raise_error(F.concat(F.lit("not a 32-byte word: "), w)).cast("string")).otherwise(w)
    ends = range(64, 0, -PART)
    parts = [F.conv(F.substr(w, F.lit(max(z - PART, 0) + 1), F.lit(min(z, PART))), 16, 10).cast("bigint") for z in ends]
    base = F.lit(10 ** LIMB)
    digits, carry = [], None
    for i in range(LIMBS):
        # Limb i of 2^(24 j), for every part that reaches it.
        factors = [(p, (1 << 4 * PART * j) // 10 ** (LIMB * i) % 10 ** LIMB) for j, p in enumerate(parts)]
        terms = [p * F.lit(f).cast("bigint") for p, f in factors if f] + ([carry] if carry is not None else [])
        total = reduce(lambda a, b: a + b, terms)
        digits.append(F.lpad((total % base).cast("string"), LIMB, "0"))
        carry = F.call_function("div", total, base)
    high = F.concat(*reversed(digits[1:]), F.left(digits[0], F.lit(LIMB - 1)))
    return F.concat(F.ltrim(high, F.lit("0")), F.right(digits[0], F.lit(1)))  # the last digit stays, also a zero


def uint_small(word) -> Column:
    """A 64-hex-char uint256 word that must fit 63 bits -> BIGINT.

    A larger value is an error, as a wrong or missing amount would pass unseen;
    a null word is null.
    """
    w = _c(word)
    fits = F.startswith(w, F.lit("0" * 48)) & (F.substr(w, F.lit(49), F.lit(1)) < F.lit("8"))
    value = F.conv(F.substr(w, F.lit(49), F.lit(16)), 16, 10).cast("bigint")
    too_large = F.raise_error(F.concat(F.lit("amount above 63 bits: 0x"), w)).cast("bigint")
    return F.when(fits, value).when(~fits, too_large)


def hex_or_dec_int(c) -> Column:
    """Block number given as int, ``0x`` hex text or decimal text -> BIGINT."""
    s = _c(c).cast("string")
    return F.when(F.startswith(s, F.lit("0x")),
                  F.conv(F.substr(s, F.lit(3), F.lit(64)), 16, 10).cast("bigint")) \
        .otherwise(s.cast("bigint"))


def topic_address(topic) -> Column:
    """Indexed address topic -> ``0x`` + last 40 hex chars, lower case."""
    return F.concat(F.lit("0x"), F.lower(F.right(_c(topic), F.lit(40))))


def hash_prefix(c) -> Column:
    """Add ``0x`` when absent."""
    s = _c(c)
    return F.when(F.startswith(s, F.lit("0x")), s).otherwise(F.concat(F.lit("0x"), s))


def pack_hex(c) -> Column:
    """Text as bytes for an exchange: lower-case hex, with or without ``0x``, takes
    half its length, any other text its own. One leading byte says which; ``unpack_hex`` restores the text."""
    s = _c(c)
    prefixed = F.startswith(s, F.lit("0x"))
    plain = s.rlike(r"\A(0x)?[0-9a-f]*+\z") & (F.length(s) % 2 == 0)
    return F.when(plain, F.concat(F.when(prefixed, F.lit(b"\x00")).otherwise(F.lit(b"\x01")),
                                  F.unhex(F.when(prefixed, F.substr(s, F.lit(3))).otherwise(s)))) \
        .otherwise(F.concat(F.lit(b"\x02"), s.cast("binary")))


def unpack_hex(c) -> Column:
    """The text that ``pack_hex`` packed."""
    b = _c(c)
    kind, rest = F.substr(b, F.lit(1), F.lit(1)), F.substr(b, F.lit(2))
    return (F.when(kind == F.lit(b"\x00"), F.concat(F.lit("0x"), F.lower(F.hex(rest))))
            .when(kind == F.lit(b"\x01"), F.lower(F.hex(rest)))
            .otherwise(rest.cast("string")))


def _hex_columns(df: DataFrame, kind: str) -> dict[str, str]:
    wide = ("transactionHash", "transaction_hash", "maker", "taker", "topics")
    return {c: t for c, t in df.dtypes if c in wide and t in (kind, f"array<{kind}>")}


def packed(df: DataFrame) -> DataFrame:
    """``df`` with the hashes, topics and addresses of logs, fills and trades as bytes, to cross an exchange."""
    return df.withColumns({c: F.transform(c, pack_hex) if t.startswith("array") else pack_hex(c)
                           for c, t in _hex_columns(df, "string").items()})


def unpacked(df: DataFrame) -> DataFrame:
    """What ``packed`` packed, as text again."""
    return df.withColumns({c: F.transform(c, unpack_hex) if t.startswith("array") else unpack_hex(c)
                           for c, t in _hex_columns(df, "binary").items()})
