"""Tokenisation and feature hashing of text (X1 default embedder).

A token's bucket is the first 8 hex digits of ``md5('<version>::' || token)`` read
as an unsigned integer, modulo the dimension (feature hashing, Weinberger et al.
2009). It depends only on the version name and the token, so it is stable across
processes and engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace class collapsed before splitting, and the separator.
WHITESPACE = r"\s+"
SEP = "::"


def tokens(text: Column) -> Column:
    """Collapse whitespace runs to one space, trim, split on the space."""
    return F.split(F.trim(F.regexp_replace(text, WHITESPACE, " ")), " ")


def bucket(version: Column, token: Column, dim: Column | int) -> Column:
    """Hash bucket of a token under a version, in ``[0, dim)``."""
    h = F.conv(F.substring(F.md5(F.concat(version, F.lit(SEP), token)), 1, 8), 16, 10).cast("bigint")
    d = dim if isinstance(dim, Column) else F.lit(dim)
    return (h % d.cast("bigint")).cast("int")
