"""Keyed hash used wherever the engine needs a repeatable random order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def keyed_hash(key: str | Column, seed: int = 0) -> Column:
    """A number in [0, 2**32) that depends on the key and the seed only.

    The first eight hex digits of an MD5 digest are used because other SQL
    engines can compute the same value.
    """
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}|"), column.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
