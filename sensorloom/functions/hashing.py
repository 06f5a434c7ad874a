"""Deterministic hashes: the same row gets the same bucket in every run, retry and layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT = 1 << 32


def unit_bucket(key: str | Column, seed: int = 0, method: str = "xxhash64") -> Column:
    """Map a key to an integer spread evenly over ``[0, 2**32)``.

    ``xxhash64`` is the fast choice. ``md5`` costs more but other engines can compute it too.
    """
    key = F.col(key) if isinstance(key, str) else key
    if method == "xxhash64":
        return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(UNIT))
    if method == "md5":
        text = F.concat(key.cast("string"), F.lit(f":{seed}"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method {method!r}")


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Hash of a whole row, used to salt hot keys without random numbers.

    A random salt would move rows when a lost task is run again. Maps have no hash and are left out.
    """
    usable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in (columns or usable)])


def row_salt(df: DataFrame, salt: int) -> Column:
    """Number in ``[0, salt)`` that spreads the rows of a hot key."""
    return F.pmod(row_hash(df), F.lit(salt))


def every_salt(salt: int) -> Column:
    """Generator of all salts, for the side of a join that is repeated."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint")))
