"""Reproducible random choice: a hash of a salt and a row key, never ``rand()``.

The same row gets the same draw on any partitioning and after any retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 15  # 60 bits: fits a bigint and exceeds any count drawn from


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def hash60(salt: str | Column, key: Column) -> Column:
    """Uniform bigint in [0, 2^60) from ``md5(salt:key)``."""
    digest = F.md5(F.concat(_col(salt).cast("string"), F.lit(":"), key.cast("string")))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint")


def pick(salt: str | Column, key: Column, n: int | Column) -> Column:
    """Uniform bigint in [0, n); 0 where n < 1."""
    return hash60(salt, key) % F.greatest(_col(n).cast("bigint"), F.lit(1).cast("bigint"))
