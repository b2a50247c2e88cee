"""IPv4 text and number conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOUR_OCTETS = 1 << 32


def ipv4_to_long(ip: Column | str) -> Column:
    """Dotted IPv4 text as a number from 0 to 2**32 - 1; anything else is null.

    The text is split once. Folding begins with one, so the number tells how many octets there were.
    """
    text = F.col(ip) if isinstance(ip, str) else ip

    def add(number: Column, part: Column) -> Column:
        octet = part.try_cast("bigint")
        return F.when((number < FOUR_OCTETS) & octet.between(0, 255), number * 256 + octet)

    whole = lambda number: F.when(number.between(FOUR_OCTETS, 2 * FOUR_OCTETS - 1), number - FOUR_OCTETS)
    return F.aggregate(F.split(text, r"\."), F.lit(1).cast("bigint"), add, whole)


def long_to_ipv4(number: Column | str) -> Column:
    """Dotted text of an IPv4 number; a negative 32-bit integer is read as unsigned."""
    bits = (F.col(number) if isinstance(number, str) else number).cast("bigint")
    return F.concat_ws(".", *[F.shiftright(bits, shift).bitwiseAND(255).cast("string") for shift in (24, 16, 8, 0)])
