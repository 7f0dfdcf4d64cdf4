"""Typed access to free-form Spark configuration values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings accepted as booleans, compared after trim + lower-case.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")
# Size units, as powers of 1024.
UNITS = {"": 0, "b": 0, "k": 1, "kb": 1, "m": 2, "mb": 2, "g": 3, "gb": 3, "t": 4, "tb": 4}


def _strip(c: Column) -> Column:
    # Like Python's str.strip(): any leading or trailing whitespace, not only spaces.
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def conf_int(conf: Column, key: str, default: int) -> Column:
    """Integer value of ``conf[key]``, a fraction cut off; missing or unparsable gives ``default``."""
    text = _strip(conf.getItem(key))
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,9)").try_cast("bigint"),
                      F.lit(default).cast("bigint"))


def conf_bool(conf: Column, key: str, default: bool) -> Column:
    """Boolean value of ``conf[key]``; an unrecognised spelling gives ``default``."""
    s = F.lower(_strip(conf.getItem(key)))
    return (F.when(s.isin(*TRUE_WORDS), F.lit(True))
            .when(s.isin(*FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(default)))


def conf_bytes(conf: Column, key: str, default: int) -> Column:
    """Size ``conf[key]`` in bytes (``10m``, ``512kb``, ``-1``); missing or unparsable gives ``default``."""
    text = F.lower(_strip(conf.getItem(key)))
    number = F.regexp_extract(text, r"^(-?\d+)\s*([kmgt]?b?)$", 1).try_cast("bigint")
    unit = F.regexp_extract(text, r"^(-?\d+)\s*([kmgt]?b?)$", 2)
    factor = F.lit(None).cast("bigint")
    for name, power in UNITS.items():
        factor = F.when(unit == name, F.lit(1024 ** power).cast("bigint")).otherwise(factor)
    return F.coalesce(F.try_multiply(number, factor), F.lit(default).cast("bigint"))
