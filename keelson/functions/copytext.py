"""COPY text format as Column expressions.

A dump line holds delimiter-separated fields; ``\\N`` is NULL; a field
escapes backslash, the delimiter and the control characters
``\\b \\f \\n \\r \\t \\v`` with a backslash.

Decoding uses literal ``replace`` and one ``split`` - no regular
expression runs over a whole line, because dump lines can be megabytes
long. Before the split, the escaped backslash and the escaped delimiter
are swapped for private markers built from two control characters, which
themselves are first escaped, so any input text survives the round trip:

    \\x02 -> \\x02b, \\x01 -> \\x02a, "\\\\" -> \\x01, "\\," -> \\x02c

Each field is then unescaped in the reverse order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TEXT = "\\N"

# The control characters COPY escapes, as (character, escape).
CONTROL_ESCAPES = [("\b", "\\b"), ("\f", "\\f"), ("\n", "\\n"),
                   ("\r", "\\r"), ("\t", "\\t"), ("\v", "\\v")]

_M1, _M2 = "\x01", "\x02"


def _rep(c: Column, a: str, b: str) -> Column:
    return F.replace(c, F.lit(a), F.lit(b))


def encode_field(c: Column, delimiter: str = ",") -> Column:
    """One value as COPY text; NULL becomes ``\\N``."""
    s = _rep(c.cast("string"), "\\", "\\\\")
    for ch, esc in CONTROL_ESCAPES:
        s = _rep(s, ch, esc)
    s = _rep(s, delimiter, "\\" + delimiter)
    return F.coalesce(s, F.lit(NULL_TEXT))


def encode_line(cols: list[Column], delimiter: str = ",") -> Column:
    return F.concat_ws(delimiter, *[encode_field(c, delimiter) for c in cols])


def _pattern(delimiter: str) -> str:
    """split() takes a pattern. A single plain character (or one escaped
    with a backslash) takes the JVM's no-regex fast path; anything longer
    is quoted."""
    if len(delimiter) == 1:
        return ("\\" + delimiter) if delimiter in ".$|()[]{}^?*+\\" else delimiter
    return "\\Q" + delimiter + "\\E"


def split_line(line: Column, delimiter: str = ",") -> Column:
    """A COPY line -> array of still-escaped fields (markers in place)."""
    s = _rep(line, _M2, _M2 + "b")
    s = _rep(s, _M1, _M2 + "a")
    s = _rep(s, "\\\\", _M1)
    s = _rep(s, "\\" + delimiter, _M2 + "c")
    return F.split(s, F.lit(_pattern(delimiter)), -1)


def unescape_field(f: Column, delimiter: str = ",") -> Column:
    """Inverse of ``encode_field`` on one field produced by ``split_line``."""
    s = f
    for ch, esc in CONTROL_ESCAPES:
        s = _rep(s, esc, ch)
    s = _rep(s, _M2 + "c", delimiter)
    s = _rep(s, _M1, "\\")
    s = _rep(s, _M2 + "a", _M1)
    s = _rep(s, _M2 + "b", _M2)
    return F.when(f == F.lit(NULL_TEXT), F.lit(None).cast("string")).otherwise(s)


def decode_fields(line: Column, n: int, delimiter: str = ",") -> list[Column]:
    """The first ``n`` fields of a COPY line as text (NULL for ``\\N``)."""
    arr = split_line(line, delimiter)
    return [unescape_field(F.get(arr, i), delimiter) for i in range(n)]


def field_count(line: Column, delimiter: str = ",") -> Column:
    return F.size(split_line(line, delimiter))
