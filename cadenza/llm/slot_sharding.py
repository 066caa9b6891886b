"""Sharding by a permutation-filled lookup table (DataFrame functions only).

Each shard has its own permutation of the slots of a prime-sized table (an offset and a stride from its
name's hash).  Shards take turns; at its turn a shard claims its next free slot.  The finished table gives
every shard the same number of slots up to one, and losing a shard moves few other keys.  Placement is one
hash and one lookup in the broadcast table, whose size is fixed by its prime (65,537 rows at most).

Edge cases: a null key is placed as the text "null"; equal keys always share a shard; an empty table stays
empty; a very long key is hashed whole; added columns are `slot` and `shard`, which replace columns of those
names, the key's own included; `__slot` is reserved.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537


def lookup(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if len(shards) > slots or slots > SLOTS or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table needs a prime size, at least one slot a shard, and 65,537 slots at most")
    seeds = [hashlib.sha256(s.encode()).digest() for s in shards]
    offset = [int.from_bytes(d[:8], "big") % slots for d in seeds]
    stride = [int.from_bytes(d[8:16], "big") % (slots - 1) + 1 for d in seeds]
    owner, at, filled = [-1] * slots, [0] * len(shards), 0
    while filled < slots:
        for i in range(len(shards)):
            while owner[slot := (offset[i] + at[i] * stride[i]) % slots] >= 0:
                at[i] += 1
            owner[slot] = i
            at[i] += 1
            filled += 1
            if filled == slots:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its MD5 modulo the table's size."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, 15)
    return (F.conv(digits, 16, 10).cast("long") % F.lit(slots)).cast("int")


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """`df` with `slot` (int) and `shard` (string)."""
    owner = lookup(shards, slots)
    spark = df.sparkSession
    table = F.split(F.lit(",".join(map(str, owner))), ",")
    names = F.array(*[F.lit(s) for s in shards])
    rows = spark.range(1).select(F.posexplode(table).alias("slot", "__i")).select("slot", names[F.col("__i").cast("int")].alias("shard"))
    return df.withColumn("__slot", slot_of(F.col(key), slots)).drop("slot", "shard").withColumnRenamed("__slot", "slot").join(F.broadcast(rows), "slot")


def sizes(placed: DataFrame, shards: list[str]) -> DataFrame:
    """Rows per shard."""
    return placed.groupBy("shard").agg(F.count("*").alias("n_rows"))
