"""Sharding by a permutation-filled lookup table.

Each shard has an order of preference over the slots of a prime-sized table, given by an offset
and a step. The shards take turns and claim the next free slot of their order until the table is
full. A row is placed by the hash of its key: slot, then shard, in constant time. The table has a
fixed size, whatever the data, so it can be broadcast. When a shard leaves, few other rows move.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE = 65537  # a prime, well above a hundred times the usual number of shards
SHARDS = 64


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str], size: int = TABLE) -> np.ndarray:
    """For each slot the number of the shard that claimed it."""
    if not is_prime(size):
        raise ValueError(f"table size {size} is not a prime")
    if not 0 < len(shards) <= size or len(set(shards)) < len(shards):
        raise ValueError("shards must be different names, one at least and no more than slots")
    place = [_number(s, "offset") % size for s in shards]
    step = [_number(s, "step") % (size - 1) + 1 for s in shards]
    table = np.full(size, -1, np.int32)
    left = size
    while True:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % size
            table[place[i]] = i
            left -= 1
            if not left:
                return table


def slot_column(key: Column, size: int = TABLE) -> Column:
    """Slot of a key: the first 52 bits of its text's MD5, modulo the size; null goes with ''."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") % size


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def lookup(spark: SparkSession, shards: list[str], size: int = TABLE) -> DataFrame:
    """The table as rows (slot, shard): always ``size`` rows of two numbers."""
    table = fill_table(shards, size)
    rows = {"_slot": np.arange(size, dtype=np.int64), "_shard": table}
    import pyarrow as pa

    return spark.createDataFrame(pa.table(rows))


def assign(df: DataFrame, key: str = "doc_id", shards: list[str] | None = None, size: int = TABLE) -> DataFrame:
    """Every row with the columns ``slot`` and ``shard`` (the shard's number); rows that share a key
    share a shard. Columns of these names are replaced."""
    table = lookup(df.sparkSession, shards or shard_names(), size).withColumnsRenamed({"_slot": "slot", "_shard": "shard"})
    kept = df.drop("slot", "shard").withColumn("slot", slot_column(F.col(key), size))
    placed = kept.join(F.broadcast(table), "slot", "left")
    return placed.select(*kept.columns, "shard")
