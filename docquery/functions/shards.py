"""Which shard a document belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shard_of(key: Column | str, shards: int) -> Column:
    """Shard of a document: the first eight hex digits of md5(id) modulo the number of shards."""
    digits = F.substring(F.md5((F.col(key) if isinstance(key, str) else key).cast("string")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(shards)).cast("int")
