"""Big-endian integers and C strings inside a binary column.

Positions are 1-based, like ``substr``. Everything is a built-in
expression, so decoding stays on the JVM and needs no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT32_SPAN = 4294967296  # 2**32


def _c(x) -> Column:
    """A position or length as an int column (substr takes ints)."""
    return (x if isinstance(x, Column) else F.lit(x)).cast("int")


def byte_at(payload: Column, pos) -> Column:
    """Unsigned value of one byte (bigint)."""
    return F.conv(F.hex(payload.substr(_c(pos), F.lit(1))), 16, 10).cast("bigint")


def char_at(payload: Column, pos) -> Column:
    """One byte as a one-letter string (message and tuple kinds)."""
    return F.decode(payload.substr(_c(pos), F.lit(1)), "ISO-8859-1")


def uint_be(payload: Column, pos, width: int) -> Column:
    """Unsigned big-endian integer of ``width`` bytes (bigint)."""
    return F.conv(F.hex(payload.substr(_c(pos), F.lit(width))), 16, 10
                  ).cast("bigint")


def int32_be(payload: Column, pos) -> Column:
    """Signed 32-bit big-endian integer (bigint)."""
    u = uint_be(payload, pos, 4)
    return F.when(u >= F.lit(INT32_SPAN // 2), u - F.lit(INT32_SPAN)).otherwise(u)


def int16_be(payload: Column, pos) -> Column:
    u = uint_be(payload, pos, 2)
    return F.when(u >= F.lit(32768), u - F.lit(65536)).otherwise(u)


def utf8_at(payload: Column, pos, length) -> Column:
    return F.decode(payload.substr(_c(pos), _c(length)), "UTF-8")


def latin1(payload: Column) -> Column:
    """Byte-for-character view of a binary value, for locating bytes:
    character positions equal byte positions."""
    return F.decode(payload, "ISO-8859-1")


def cstring_end(view: Column, pos) -> Column:
    """Position of the NUL that ends the C string starting at ``pos``
    (``view`` is ``latin1(payload)``)."""
    return F.call_function("locate", F.lit("\x00"), view, _c(pos))


# Encoders (used to write message fixtures from tables, and in tests).

def be_bytes(x: Column, width: int) -> Column:
    """Non-negative integer -> ``width`` big-endian bytes."""
    return F.unhex(F.lpad(F.hex(x.cast("bigint")), 2 * width, "0"))


def int32_bytes(x: Column) -> Column:
    """Signed 32-bit integer -> 4 bytes (two's complement)."""
    x = x.cast("bigint")
    return be_bytes(F.when(x < 0, x + F.lit(INT32_SPAN)).otherwise(x), 4)


def ascii_bytes(s: str) -> Column:
    return F.encode(F.lit(s), "UTF-8")


def utf8_bytes(c: Column) -> Column:
    return F.encode(c, "UTF-8")


def cstring_bytes(c: Column) -> Column:
    return F.concat(F.encode(c, "UTF-8"), F.unhex(F.lit("00")))
