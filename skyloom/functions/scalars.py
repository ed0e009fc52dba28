"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\r\x0b\x0c"


def trimmed(c: Column | str) -> Column:
    """Without surrounding blanks of any ASCII kind."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS))


def digest_text(c: Column | str) -> Column:
    """Signatures and hashes compare in lower case without surrounding blanks."""
    return F.lower(trimmed(c))


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 UTC of a timestamp with or without zone, whatever the session's zone is."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{name}`)")
    return F.unix_micros(F.col(name))


def floor_div(c: Column, by: int) -> Column:
    """Integer division that rounds down for negative numbers too."""
    return F.floor(c / F.lit(by)).cast("bigint") if by < 2**20 else ((c - F.pmod(c, F.lit(by).cast("bigint"))) / F.lit(by)).cast("bigint")
