"""Numbers as text (F7), rounded half up on millionths, so that any SQL engine writes the same digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on a double has less than three decimals; such numbers are written as whole ones.
WHOLE_FROM = 9e12


def fixed(x: Column, digits: int) -> Column:
    """``x`` with ``digits`` (0 to 6) decimals; null stays null, NaN and infinities are written by name."""
    x = x.cast("double")
    size = F.abs(x)
    small = F.when(size < WHOLE_FROM, size)  # no overflow where the other branch is taken
    millionths = F.floor(small * F.lit(1e6) + F.lit(0.5))
    step, one = 10 ** (6 - digits), 10 ** digits
    units = F.call_function("div", millionths + F.lit(step // 2), F.lit(step))
    text = F.call_function("div", units, F.lit(one)).cast("string")
    zeros = F.lit("")
    if digits:
        text = F.concat(text, F.lit("."), F.lpad((units % one).cast("string"), digits, "0"))
        zeros = F.lit("." + "0" * digits)
    large = F.concat(F.floor(F.when(size < 1e37, size).cast("decimal(38,0)")).cast("string"), zeros)
    signed = F.concat(F.when((x < 0) & (small.isNull() | (units > 0)), F.lit("-")).otherwise(F.lit("")),
                      F.when(small.isNotNull(), text).otherwise(large))
    return F.coalesce(signed, x.cast("string"))


def json_number(x: Column) -> Column:
    """``x`` as a JSON number of one to six decimals, without an exponent; null, NaN and infinities as null."""
    finite = F.abs(x.cast("double")) < 1e37
    return F.when(finite, F.regexp_replace(fixed(x, 6), "0{1,5}$", "")).otherwise(F.lit("null"))


def json_map(m: Column) -> Column:
    """A map of names to doubles as a JSON object, keys in the map's order. Names are not escaped."""
    pairs = F.transform(F.map_entries(m), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), json_number(e["value"])))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
