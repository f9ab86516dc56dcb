"""Pipe-delimited rendering of query results (K7).

Header: column names joined by ``|``. Row: values as text joined by
``|``, NULL as the empty string (plain ``concat_ws`` would drop the NULL
field and shift the rest), one line per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "|"  # fixed value: column separator of rendered rows


def render_row(cols: list[Column], sep: str = SEPARATOR) -> Column:
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit(""))
                              for c in cols])


def render_header(df: DataFrame, sep: str = SEPARATOR) -> str:
    return sep.join(df.columns)


def render(df: DataFrame, sep: str = SEPARATOR, name: str = "line"
           ) -> DataFrame:
    """One string column per row; the header comes from ``render_header``."""
    return df.select(render_row([F.col(c) for c in df.columns], sep).alias(name))


def render_text(df: DataFrame, sep: str = SEPARATOR) -> str:
    """Header plus rows as one string, for a client printing a small result.
    The caller bounds the result (``LIMIT``); this collects it."""
    lines = [r[0] for r in render(df, sep).collect()]
    return "\n".join([render_header(df, sep)] + lines) + "\n"
