"""Deterministic pseudo-random numbers from row keys, for splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1_000_000


def hash_bucket(parts: Sequence[Column | str], seed: Column, buckets: int, fn: str) -> Column:
    """A bucket in ``[0, buckets)``; the same key always lands in the same bucket.

    ``xxhash64`` is the fast form. ``md5`` gives the same buckets in any engine.
    """
    text = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    if fn == "xxhash64":
        h = F.xxhash64(*text, seed)
        # abs() of the smallest bigint overflows, so that one value is moved by one
        h = F.abs(F.greatest(h, F.lit(-(2**63) + 1)))
    elif fn == "md5":
        digest = F.md5(F.concat_ws("|", *text, seed.cast("string")))
        h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    else:
        raise ValueError(f"unknown hash function {fn!r}")
    return F.pmod(h, F.lit(buckets))


def hash_fraction(parts: Sequence[Column | str], salt: str, fn: str = "xxhash64") -> Column:
    """A number in ``[0, 1)`` that depends only on the key parts and the salt."""
    return hash_bucket(parts, F.lit(salt), BUCKETS, fn) / F.lit(float(BUCKETS))


def fold_of(key: Column | str, folds: int, seed: int, fn: str = "xxhash64") -> Column:
    return hash_bucket([key], F.lit(seed), folds, fn).cast("int")
