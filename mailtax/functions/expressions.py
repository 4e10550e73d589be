"""Small column expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATE_TYPE = "decimal(38,6)"


def uuid_from(*parts: Column | str) -> Column:
    """Repeatable 128-bit id: md5 of the parts written as a UUID. NULL parts count as empty text. The digest is named once: a
    filter or a branch that spells the id repeats all that is named in it."""
    text = F.md5(F.concat_ws("|", *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]))
    for place in (9, 14, 19, 24):
        text = F.overlay(text, F.lit("-"), F.lit(place), F.lit(0))
    return text


def packed_id(text: Column) -> Column:
    """An id as bytes, one to one, half as long to shuffle: 16 for 32 lower-case hex digits, 17 for the same with hyphens."""
    digits = (F.length(text) == 32) & text.rlike("^[0-9a-f]{32}")
    hyphens = (F.length(text) == 36) & text.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}")
    return (
        F.when(digits, F.unhex(text))
        .when(hyphens, F.concat(F.unhex(F.replace(text, F.lit("-"))), F.lit(b"-")))
        .otherwise(F.concat(F.lit(bytes(18)), text.cast("binary")))
    )


def packed_key(text: Column) -> Column:
    """``packed_id`` as a key to join by that is never NULL.

    Before an inner join Spark tests a key that may be NULL where the rows are read, and so spells and packs every id once more, in
    a filter that evaluates each part of it as often as it is named. Here a NULL id has the empty key, which no other id has; it
    must not meet its like, so one side of a join drops rows without an id, by the id itself.
    """
    return F.coalesce(packed_id(text), F.lit(b""))


def packed_number(number: Column) -> Column:
    """A whole number as 8 bytes, which no ``packed_id`` has."""
    return F.unhex(F.lpad(F.hex(number), 16, "0"))


def unpacked_id(packed: Column) -> Column:
    """The text of a ``packed_id``, NULL for a ``packed_number``."""
    digits = F.lower(F.hex(F.substring(packed, 1, 16)))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    size = F.length(packed)
    return (
        F.when(size == 16, digits)
        .when(size == 17, F.concat_ws("-", *[F.substring(digits, start, length) for start, length in cuts]))
        .when(size > 17, F.substring(packed, 19, 2147483647).cast("string"))
    )


def packed_fields(fields: list[tuple[Column, int]]) -> Column:
    """Whole numbers, each with its bits (63 at most together), as one number; NULL if one is NULL or takes more bits."""
    fits, packed = F.lit(True), F.lit(0).cast("bigint")
    for value, bits in fields:
        fits = fits & value.between(0, 2**bits - 1)
        packed = F.shiftleft(packed, bits).bitwiseOR(value.cast("bigint"))
    return F.when(fits, packed)


def unpacked_fields(packed: Column, bits: list[int]) -> list[Column]:
    """The numbers of ``packed_fields``."""
    return [F.shiftright(packed, sum(bits[i + 1:])).bitwiseAND(F.lit(2**n - 1).cast("bigint")) for i, n in enumerate(bits)]


def blank(text: Column) -> Column:
    """True for NULL, empty and all-space text."""
    return F.coalesce(F.rtrim(text) == "", F.lit(True))


def folded(text: Column) -> Column:
    """Upper case without trailing spaces, the form in which addresses are compared."""
    return F.upper(F.rtrim(text))


def concat_null_as_empty(*parts: Column) -> Column:
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def pro_rata_rate(amount: Column, total_quantity: Column) -> Column:
    """Amount per piece, rounded to 8 places (the later rounding to 3 places starts from this value)."""
    return F.round(amount.cast("decimal(25,10)") / total_quantity, 8).cast("decimal(25,8)")


def nonzero(value: Column, message: str, on_zero: str) -> Column:
    """A divisor: zero raises with ``on_zero='raise'`` and becomes NULL with ``on_zero='warn'``."""
    if on_zero not in ("raise", "warn"):
        raise ValueError(f"on_zero must be 'raise' or 'warn', not {on_zero!r}")
    bad = F.raise_error(F.lit(message)) if on_zero == "raise" else F.lit(None)
    return F.when(value == 0, bad.cast("bigint")).otherwise(value)


def _col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)
