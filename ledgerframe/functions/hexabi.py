"""Hex quantities and ABI words as Column expressions; nothing here leaves whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_LIMB = 10**18
_HEX = "^(0[xX])?[0-9a-fA-F]+$"


def hex_to_magnitude(c: Column) -> Column:
    """BIGINT of a hex quantity, its largest value beyond 63 bits; NULL for junk."""
    return F.coalesce(hex_to_long(c), F.when(c.rlike(_HEX), F.lit(2**63 - 1)))


def let(value: Column, then) -> Column:
    """then(value) with value computed once, however often `then` names it; keeps deep expressions small."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _significant(c: Column) -> Column:
    """The digits of a hex quantity without 0x and leading zeros; NULL for anything else."""
    return F.when(c.rlike(_HEX), F.regexp_replace(c, "^(0[xX])?0*", ""))


#: A hex quantity of up to 16 digits after its zeros, and these digits. One pattern is little generated code: the JVM does not compile methods of over 8,000 bytes.
_SHORT = "^(?:0[xX])?0*([0-9a-fA-F]{1,16})$"


def _short(c: Column) -> Column:
    """Decimal text of a hex quantity of up to 64 bits; NULL for anything else."""
    return F.conv(F.nullif(F.regexp_extract(c, _SHORT, 1), F.lit("")), 16, 10)


def hex_to_long(c: Column) -> Column:
    """BIGINT of a hex quantity; NULL for NULL, junk, '' and '0x', and beyond 63 bits."""
    return _short(c).try_cast("bigint")


#: Limbs of 18 decimal digits, least first, of the powers of two that the 60-bit words of a value stand for.
_POWERS = [[(1 << 60 * i) // _LIMB**j % _LIMB for i in range(5)] for j in range(5)]
_WIDE = "decimal(38,0)"


def _wide_decimal(digits: Column) -> Column:
    """Decimal text of up to 64 hex digits: each limb is a sum of words times constants, which fits DECIMAL(38); carries run once."""
    big = lambda x: F.lit(str(x)).cast(_WIDE)
    limbs = F.array(*[F.array(*[big(x) for x in row]) for row in _POWERS])

    def step(a: Column, row: Column, words: Column) -> Column:
        products = F.zip_with(words, row, lambda w, p: (w * p.cast("decimal(18,0)")).cast(_WIDE))
        total = F.aggregate(products, a["carry"], lambda s, x: (s + x).cast(_WIDE))
        text = F.lpad((total % big(_LIMB)).cast("decimal(18,0)").cast("string"), 18, "0")
        return F.struct(F.call_function("div", total, big(_LIMB)).cast(_WIDE).alias("carry"), F.concat(text, a["text"]).alias("text"))

    def of(padded: Column) -> Column:
        words = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.conv(F.substr(padded, 61 - 15 * i, F.lit(15)), 16, 10).cast("decimal(19,0)"))
        start = F.struct(big(0).alias("carry"), F.lit("").alias("text"))
        return F.get(F.transform(F.array(words), lambda w: F.aggregate(limbs, start, lambda a, row: step(a, row, w), lambda a: F.regexp_replace(a["text"], "^0+(?=.)", ""))), F.lit(0))

    return F.get(F.transform(F.array(F.lpad(digits, 75, "0")), of), F.lit(0))


def hex_to_decimal_string(c: Column) -> Column:
    """Decimal text of a hex quantity of up to 256 bits; NULL for junk and beyond.

    Up to 16 digits after zeros convert at once; only longer values take the wide way, whose lambdas keep the generated code small.
    """
    digits = _significant(c)
    return F.coalesce(_short(c), F.when(F.length(digits) <= 64, _wide_decimal(digits)))


def normalize_hex(c: Column) -> Column:
    """Trimmed, lower-cased and with 0x; NULL and blank become '0x'."""
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(low.startswith("0x"), low).otherwise(F.concat(F.lit("0x"), low))


def topic_address(topics: Column, i: Column | int) -> Column:
    """The address in topic i: its last 40 digits with 0x; NULL where the topic is missing or too short."""
    digits = abi_digits(F.get(topics, F.lit(i)))
    return F.when(F.length(digits) >= 40, F.concat(F.lit("0x"), F.substring(digits, -40, 40)))


def abi_digits(data: Column) -> Column:
    """The hex digits of ABI data, without 0x."""
    low = F.lower(F.trim(F.coalesce(data, F.lit(""))))
    return F.substr(low, F.when(low.startswith("0x"), 3).otherwise(1))


def word_at(digits: Column, k: Column | int) -> Column:
    """Word k (64 digits) of ABI digits; NULL where it is not whole."""
    start = F.lit(64 * k + 1) if isinstance(k, int) else (k * 64 + 1).cast("int")
    return F.when(F.length(digits) >= start + 63, F.substr(digits, start, F.lit(64)))


def abi_words(data: Column) -> Column:
    """All whole words of ABI data; a short tail is dropped."""
    none = F.array().cast("array<string>")

    def split(d: Column) -> Column:
        n = F.floor(F.length(d) / 64).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: word_at(d, k))).otherwise(none)

    return let(abi_digits(data), split)


#: The words of 64 digits that a text begins with; one may have 0x for its first two digits.
_WORDS = "^(?:0x[0-9a-f]{62}|[0-9a-f]{64})*+"


def list_place(digits: Column, k: int) -> Column:
    """Where the dynamic array that word k of ABI digits points to begins, in digits; NULL for a bad offset (any in bytes is good, not only whole words)."""
    offset = hex_to_long(word_at(digits, k))
    return F.when((offset >= 0) & (offset <= (F.length(digits) - 64) / 2), (offset * 2).cast("int"))


def list_size(digits: Column, at: Column) -> Column:
    """How many values the dynamic uint256 array at a list_place() has: the length there, clamped to the words there are, up to the first that is no hex; 0 for anything bad."""
    told = hex_to_magnitude(F.substr(digits, at + 1, F.lit(64)))
    n = F.least(told, F.floor((F.length(digits) - at - 64) / 64)).cast("int")
    return F.coalesce(F.floor(F.length(F.regexp_extract(F.substr(digits, at + 65, 64 * n), _WORDS, 0)) / 64).cast("int"), F.lit(0))


def list_value(digits: Column, at: Column, i: Column) -> Column:
    """The digits of value i, from 0, of the array at a list_place()."""
    return F.substr(digits, (at + 65 + 64 * i).cast("int"), F.lit(64))


def abi_uint_array(digits: Column, k: int) -> Column:
    """The dynamic uint256 array that word k of ABI digits points to, as decimal strings; see list_place and list_size. Anything bad gives an empty array."""
    none = F.array().cast("array<string>")

    def values(at: Column) -> Column:
        every = lambda n: F.transform(F.sequence(F.lit(0), n - 1), lambda i: hex_to_decimal_string(list_value(digits, at, i)))
        return let(list_size(digits, at), lambda n: F.when(n > 0, every(n)).otherwise(none))

    return let(list_place(digits, k), values)
