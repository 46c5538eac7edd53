"""Hash expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_mod_100(text: Column) -> Column:
    """SHA-256 of ``text`` as one big integer, modulo 100.

    The digest is folded as eight 32-bit digits; 2**32 leaves 96 modulo 100.
    """
    digest = F.sha2(text, 256)
    acc = F.lit(0).cast("long")
    for i in range(8):
        digit = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
        acc = (acc * 96 + digit) % 100
    return acc.cast("int")


def seeded_order(seed: int, row_id: Column) -> Column:
    """A reproducible random order key, the same under any partitioning."""
    return F.sha2(F.concat(F.lit(f"{seed}|"), row_id.cast("string")), 256)
