"""Keyed digests: pseudonyms and repeatable random numbers.

Random numbers come from a digest of the row's key, not from ``rand()``: a task that is run again
after a lost executor draws the same numbers, whatever its partition holds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_SALT = 32


def digest(secret: str, *cols: Column | str) -> Column:
    """64 hex digits of SHA-256 over ``secret`` followed by the columns, joined by ``|``."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.sha2(F.concat(F.lit(secret), text), 256)


def pseudonym(col: Column, salt: str) -> Column:
    """First 16 hex digits of SHA-256 over the salt and the id; null stays null."""
    if salt is None or len(salt) < MIN_SALT:
        raise ValueError(f"the salt must have at least {MIN_SALT} characters")
    return F.substring(F.sha2(F.concat(F.lit(salt), col.cast("string")), 256), 1, 16)


def word32(hex_digest: Column, slot: int = 0) -> Column:
    """Unsigned 32-bit integer from the ``slot``-th (0..7) group of eight hex digits."""
    return F.conv(F.substring(hex_digest, 1 + 8 * slot, 8), 16, 10).cast("bigint")


def uniform(hex_digest: Column, slot: int = 0) -> Column:
    """Uniform number in [0, 1) from one slot of a digest."""
    return word32(hex_digest, slot) / F.lit(float(2**32))


def normal(hex_digest: Column, slot: int = 0) -> Column:
    """Standard normal number from two neighbouring slots (Box-Muller)."""
    u1 = F.greatest(uniform(hex_digest, slot), F.lit(1e-12))
    u2 = uniform(hex_digest, slot + 1)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)
