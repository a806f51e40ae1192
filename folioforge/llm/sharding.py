"""Sharding by a permutation-filled lookup table.

Each shard orders the slots of a prime-sized table by (offset + i * skip) mod size; shards take turns in claiming the next
free slot of their order until the table is full. A row's key picks a slot and the slot names the shard: one broadcast lookup.
The table is filled once, on the driver, from the shards' names alone: `size` slots whatever the data.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(96))


def lookup_table(shards: tuple[str, ...], size: int = SIZE) -> list[int]:
    """slot -> index of its shard. size: a prime, at least as large as the number of shards."""
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, at least one and no more than slots")
    if size < 2 or any(size % p == 0 for p in range(2, int(size**0.5) + 1)):
        raise ValueError(f"{size} is not prime")
    place, skip = [], []
    for s in shards:
        d = hashlib.sha256(s.encode()).digest()
        place.append(int.from_bytes(d[:8]) % size)
        skip.append(int.from_bytes(d[8:16]) % (size - 1) + 1)
    table, left = [-1] * size, size
    while True:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % size
            table[place[i]] = i
            left -= 1
            if not left:
                return table


def slot_of(key: F.Column, size: int = SIZE) -> F.Column:
    """The first 15 hex digits of the key's MD5, modulo size; a null key counts as the empty string."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size)).cast("int")


def place(rows: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """rows with columns slot and shard (replacing any of these names). No shuffle: every row is placed where it is read.

    Repeated rows go to one shard; so do all null keys, with the empty string. An empty table stays empty.
    """
    table = F.split(F.lit(",".join(map(str, lookup_table(shards, size)))), ",")
    slots = rows.sparkSession.range(1).select(F.posexplode(table).alias("__slot", "i"))
    names = F.array(*map(F.lit, shards))
    slots = slots.select("__slot", F.element_at(names, F.col("i").cast("int") + 1).alias("__shard"))
    kept = rows.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), size))
    return kept.join(F.broadcast(slots), F.col("slot") == F.col("__slot"), "left").drop("__slot").withColumnRenamed("__shard", "shard")
