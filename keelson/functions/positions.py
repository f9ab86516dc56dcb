"""Feed positions and feed clock.

A position prints as ``X/Y``: the high and low 32 bits of a 64-bit
number in upper-case hex. The feed clock counts microseconds since
2000-01-01 00:00:00 UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LOW_WORD = 4294967296                 # 2**32
CLOCK_EPOCH_MICROS = 946684800000000  # 2000-01-01T00:00:00Z in Unix micros


def parse_position(text: Column) -> Column:
    """``'16/B374D848'`` -> 97500059720 (bigint); NULL stays NULL."""
    parts = F.split(text, "/", 2)
    hi = F.conv(F.get(parts, 0), 16, 10).cast("bigint")
    lo = F.conv(F.get(parts, 1), 16, 10).cast("bigint")
    return hi * F.lit(LOW_WORD) + lo


def format_position(pos: Column) -> Column:
    hi = F.shiftright(pos, 32)
    lo = pos.bitwiseAND(F.lit(LOW_WORD - 1))
    return F.concat(F.hex(hi), F.lit("/"), F.hex(lo))


def clock_to_timestamp(micros: Column) -> Column:
    return F.timestamp_micros(micros + F.lit(CLOCK_EPOCH_MICROS))


def timestamp_to_clock(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) - F.lit(CLOCK_EPOCH_MICROS)
