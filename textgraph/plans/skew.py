"""Lookup joins whose big side may have a few keys that own most of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizing import BROADCAST_BYTES, measured_bytes

# A key owning more than 1/HEAD_KEYS of the rows is dealt over several salts; there cannot be more than HEAD_KEYS.
HEAD_KEYS = 10_000


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    key: str | Sequence[str],
    weight: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    head_keys: int = HEAD_KEYS,
) -> DataFrame:
    """Inner join of ``big`` with ``lookup`` (one row a key) on ``key``; a null key joins nothing.

    ``weight`` is the lookup column with the number of rows the key has in ``big``. ``lookup`` is measured first,
    so pass a written or otherwise cheap one. A small lookup is broadcast. Of a larger one, the hashes of the hot
    keys are, 16 bytes each and bounded in number whatever the data is; they say over how many salts a key's rows
    are dealt. Then one join on (key, salt) serves hot and other keys alike, in one pass over ``big``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if measured_bytes(lookup) <= broadcast_bytes:
        return big.join(F.broadcast(lookup), keys)
    total = lookup.agg(F.sum(weight)).first()[0]
    share = F.ceil(F.col(weight) * head_keys / F.lit(total)).cast("int")
    hot = (
        lookup.filter(F.col(weight) * head_keys > total)
        .groupBy(F.xxhash64(*keys).alias("_hash"))
        .agg(F.max(share).alias("_salts"))
    )

    def dealt(side: DataFrame) -> DataFrame:
        hashed = side.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(hot), "_hash", "left")
        return hashed.withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    # A key's salts all hold the same lookup row, so whichever salt a row draws, it finds the same partner.
    drawn = dealt(big).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.col("_salts")).cast("int"))
    copies = dealt(lookup).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    helpers = ("_hash", "_salts", "_salt")
    return drawn.drop("_hash", "_salts").join(copies.drop("_hash", "_salts"), [*keys, "_salt"]).drop(*helpers)
