"""Numbers as text, spelt as configuration files spell them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Plain notation from 1e-4 up to 1e16, exponents of two digits beyond.
PLAIN_FROM, PLAIN_TO = 1e-4, 1e16


def number_text(x: Column) -> Column:
    """Shortest text of a double: ``0.0001``, ``10000000.0``, ``1e-05``, ``1e+16``.

    Spark's own text is the shortest too, but turns to ``1.0E-4`` below 1e-3
    and from 1e7; its digits are kept and laid out anew.
    """
    x = x.cast("double")
    text = x.cast("string")
    size = F.abs(x)
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(power < 0, "-").otherwise("+")
    digits = F.abs(power).cast("string")
    short = F.concat(mantissa, F.lit("e"), sign, F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits))
    return (F.when(~F.contains(text, F.lit("E")), text)
            .when((size >= PLAIN_FROM) & (size < PLAIN_TO), plain).otherwise(short))


def value_text(x: Column, kind: str) -> Column:
    """Text of a column of the given type: floating point as ``number_text``, the rest as it is."""
    return number_text(x) if kind in ("double", "float") else x.cast("string")


def reprinted(raw: Column) -> Column:
    """A JSON number's raw text parsed and printed again: ``0.10`` -> ``0.1``, ``1e-4`` -> ``0.0001``, ``12`` as it is."""
    whole = raw.rlike(r"^-?\d+$")
    return F.when(whole, raw).otherwise(F.coalesce(number_text(raw.try_cast("double")), raw))
