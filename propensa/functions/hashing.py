"""Seeded hashes of a key, equal on every run and in every partition order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_text(key: str, seed: int) -> Column:
    """32 hex characters that order rows at random, reproducibly."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def hash_unit(key: str, seed: int) -> Column:
    """Number in [0, 1) from the leading 32 bits of the hash."""
    bits = F.conv(F.substring(hash_text(key, seed), 1, 8), 16, 10).cast("double")
    return bits / F.lit(float(2**32))
