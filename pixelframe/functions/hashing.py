"""Key hashes for samples that do not depend on how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_fraction(key: Column | str, salt: str = "") -> Column:
    """A number in [0, 1) that is a function of the key alone."""
    c = F.col(key) if isinstance(key, str) else key
    text = c.cast("string")
    if salt:
        text = F.concat(F.lit(salt), text)
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(float(1 << 32))
