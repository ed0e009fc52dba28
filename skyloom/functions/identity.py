"""Content-addressed identities: SHA-256 over canonical JSON, keys sorted, no blanks, everything beyond plain ASCII escaped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short escapes of JSON text.
ESCAPES = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_text(c: Column | str) -> Column:
    """A text as JSON. Only a text with other than plain signs is taken apart."""
    c = _column(c).cast("string")

    def escaped(x: Column) -> Column:
        code = F.ascii(x)
        beyond = code - 0x10000
        pair = F.concat(F.format_string("\\u%04x", F.lit(0xD800) + F.shiftright(beyond, 10)), F.format_string("\\u%04x", F.lit(0xDC00) + beyond.bitwiseAND(F.lit(0x3FF))))
        out = F.when(code > 0xFFFF, pair).when((code < 32) | (code > 126), F.format_string("\\u%04x", code)).otherwise(x)
        for sign, short in ESCAPES.items():
            out = F.when(x == sign, short).otherwise(out)
        return out

    plain = ~c.rlike(r'[^ -~]|["\\]')
    return F.concat(F.lit('"'), F.when(plain, c).otherwise(F.array_join(F.transform(F.split(c, ""), escaped), "")), F.lit('"'))


def json_whole(c: Column | str) -> Column:
    return _column(c).cast("bigint").cast("string")


def json_truth(c: Column | str) -> Column:
    return _column(c).cast("boolean").cast("string")


def json_real(c: Column | str, digits: int = 10) -> Column:
    """A number rounded to so many decimals in its shortest form; null where it is not finite."""
    c = _column(c).cast("double")
    text = F.regexp_replace(F.format_string(f"%.{digits}f", c), r"(?<=\.\d)0+$|(?<=\.\d{2,20})0+$", "")
    # below 1e-4 the shortest form has an exponent
    steps = F.abs(F.round(c * F.lit(10.0**digits))).cast("bigint").cast("string")
    lead = F.regexp_replace(steps, "0+$", "")
    small = F.concat(F.when(c < 0, "-").otherwise(""), F.substring(lead, 1, 1), F.when(F.length(lead) > 1, F.concat(F.lit("."), F.substring(lead, 2, 30))).otherwise(""), F.format_string("e-%02d", F.lit(digits + 1) - F.length(steps)))
    out = F.when((F.abs(c) < 1e-4) & (steps != "0"), small).otherwise(text)
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")), out)


def canonical_json(fields: dict[str, Column]) -> Column:
    """An object of JSON values (as the functions above make them) under plain ASCII keys; null values stay as null."""
    parts = [F.concat(F.lit(f'"{k}":'), F.coalesce(fields[k], F.lit("null"))) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def stable_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(fields), 256)


def texts(*names: str) -> dict[str, Column]:
    """Text fields under their own names."""
    return {n: json_text(n) for n in names}
