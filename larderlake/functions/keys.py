"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(prefix: str, *cols: str) -> Column:
    """MD5 over a table prefix and the text of ``cols``.

    NULL parts are skipped, so ``(NULL, x)`` and ``(x, NULL)`` share a key: use these keys to look
    rows up by dimension, not to identify fact lines.
    """
    parts = [F.lit(prefix), *(F.col(c).cast("string") for c in cols)]
    return F.md5(F.concat_ws("||", *parts))


#: Before a key that is no hash; so long that no such key has the length of a hash.
_PLAIN = "000000000000000000000000000000000000"


def packed(key: Column) -> Column:
    """A key as bytes: 16 for an MD5, which as text no shuffle compresses; any other text, marked."""
    raw = F.unhex(key)
    is_hash = (F.length(key) == 32) & (F.lower(F.hex(raw)) == key)
    return F.when(is_hash, raw).otherwise(F.concat(F.unhex(F.lit(_PLAIN)), F.encode(key, "UTF-8")))


def unpacked(key: Column) -> Column:
    """The text of a packed key."""
    plain = F.decode(F.substring(key, len(_PLAIN) // 2 + 1, 2_000_000_000), "UTF-8")
    return F.when(F.length(key) == 16, F.lower(F.hex(key))).otherwise(plain)
