"""Hex quantities (``0x…`` text) as Spark numbers.

All builders are JVM-side expressions. Absent quantities (NULL, ``""``, ``0x``) and text
that is not hex give NULL, as do values too wide for the result type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One 256-bit word is 64 hex digits; a 64-bit limb is 16.
WORD = 64
LIMB = 16


# Patterns of a usable quantity, without and with a bound on its significant digits.
HEX = "^0x[0-9a-fA-F]+$"
UP_TO_128_BITS = "^0x0*[0-9a-fA-F]{1,32}$"


def _digits(c: Column) -> Column:
    """The digits after the prefix, those of one word at most."""
    return F.substring(c, 3, WORD)


def _word(c: Column) -> Column:
    """The digits as one word. Spark's ``lpad`` copies every pad character by itself, which
    takes longer than parsing the payload; ``repeat`` doubles."""
    digits = _digits(c)
    return F.concat(F.repeat(F.lit("0"), WORD - F.length(digits)), digits)


def _part(c: Column, above: int, width: int) -> Column:
    """``width`` digits of the word with ``above`` digits from their first to the word's last, as
    decimal text. They are taken from the end, so that the word needs no padding."""
    return F.conv(F.concat(F.lit("0"), F.substring(_digits(c), -above, width)), 16, 10)


def _limb(c: Column, start: int) -> Column:
    return _part(c, WORD - start + 1, LIMB).cast("decimal(20,0)")


def hex64(c: Column) -> Column:
    """The quantity as 64 lower-case digits: text order equals numeric order for 256 bits."""
    return F.when(c.rlike(HEX), F.lower(_word(c)))


def hex_to_long(c: Column) -> Column:
    """Signed 64-bit value; NULL from 2^63 upwards."""
    significant = F.regexp_extract(c, "^0x0*([0-9a-fA-F]{1,16})$", 1)
    return F.conv(significant, 16, 10).try_cast("bigint")


def hex_to_int(c: Column) -> Column:
    return hex_to_long(c).try_cast("int")


def hex_to_uint64(c: Column) -> Column:
    """Low 64 bits as ``decimal(20,0)``."""
    return F.when(c.rlike(HEX), _limb(c, WORD - LIMB + 1))


def hex_to_uint32(c: Column) -> Column:
    """Low 32 bits as ``bigint``."""
    return F.when(c.rlike(HEX), _part(c, 8, 8).cast("bigint"))


def sum_hex64(c: Column) -> Column:
    """Sum of 64-digit quantities as hex text of 80 digits (sums of up to 2^64 of them).

    Each 64-bit limb is summed by itself, which loses nothing, and what a limb's sum has
    above 64 bits is carried to the next one."""
    wide = "decimal(38,0)"
    base = F.lit("18446744073709551616").cast(wide)
    limbs = [F.sum(F.conv(F.substring(c, start, LIMB), 16, 10).cast("decimal(20,0)")).cast(wide) for start in (49, 33, 17, 1)]

    def add(done: Column, limb: Column) -> Column:
        total = (limb + done["carry"]).cast(wide)
        rest = F.pmod(total, base)
        return F.struct(
            ((total - rest) / base).cast(wide).alias("carry"),
            F.concat(hex_of_limb(rest.cast("decimal(20,0)")), done["digits"]).alias("digits"),
        )

    start = F.struct(F.lit(0).cast(wide).alias("carry"), F.lit("").alias("digits"))
    return F.aggregate(
        F.array(*limbs), start, add, lambda done: F.concat(hex_of_limb(done["carry"].cast("decimal(20,0)")), done["digits"])
    )


def hex_of_limb(limb: Column) -> Column:
    """A number below 2^64 as 16 hex digits."""
    return F.lower(F.lpad(F.conv(limb.cast("string"), 10, 16), LIMB, "0"))


def hex_to_decimal(c: Column) -> Column:
    """Exact ``decimal(38,0)``; NULL above 10^38-1, where the 64-digit text still holds it."""
    high = F.try_multiply(_limb(c, 33), F.lit("18446744073709551616").cast("decimal(20,0)"))
    return F.when(
        c.rlike(UP_TO_128_BITS), F.try_add(high, _limb(c, 49)).cast("decimal(38,0)")
    )


def hex_substr(c: Column, width: int) -> Column:
    """Decode the first ``width`` digits after the prefix, as ``decimal(38,0)``."""
    return hex_to_decimal(F.concat(F.lit("0x"), F.substring(c, 3, width)))


def hex_to_timestamp(c: Column) -> Column:
    """Hex seconds since the epoch."""
    return F.timestamp_seconds(hex_to_long(c))
