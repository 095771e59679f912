"""Seeded uniform numbers that depend only on the seed and position.

A number is taken from a hash of its coordinates, so the same table is drawn
whatever the number of partitions, and again when a task is retried.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits, exact in a double


def uniform_column(low: float, high: float, *parts: Column | int | str) -> Column:
    """Uniform in [low, high) for each row, from the hash of ``parts``."""
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    digits = F.substring(F.md5(F.concat_ws(":", *texts)), 1, _HEX_DIGITS)
    unit = F.conv(digits, 16, 10).cast("double") / F.lit(float(16**_HEX_DIGITS))
    return unit * F.lit(float(high) - float(low)) + F.lit(float(low))


def uniform_value(low: float, high: float, *parts: int | str) -> float:
    """The same number on the driver."""
    digest = hashlib.md5(":".join(map(str, parts)).encode(), usedforsecurity=False).hexdigest()
    unit = int(digest[:_HEX_DIGITS], 16) / float(16**_HEX_DIGITS)
    return unit * (float(high) - float(low)) + float(low)
