"""Consistent placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized
table; the shards take turns claiming their best free slot until the table is
full. All shards get an equal number of slots (within one), and when a shard
joins or leaves few slots change hands. A row's key is hashed to a slot, and
the table, broadcast, gives its shard in constant time.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.store import free_name

MAX_SLOTS = 1_000_003  # keeps the broadcast table below about 16 MB


def _number(text: str) -> int:
    """60 bits of the md5 digest."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """The shard number that owns each slot."""
    if not is_prime(slots) or slots > MAX_SLOTS:
        raise ValueError(f"slots must be a prime of at most {MAX_SLOTS}")
    if not shards or len(shards) > slots or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, at least one and at most one a slot")
    # a step that is prime to the table size makes each preference order a permutation of the slots
    at = [_number(f"{s}/start") % slots for s in shards]
    step = [_number(f"{s}/step") % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    for claim in range(slots):
        i = claim % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + step[i]) % slots
        owner[at[i]] = i
    return owner


def slot_of(key: Column, slots: int) -> Column:
    """Slot of a key: 60 bits of its md5, modulo the table size. A null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(slots))


def place(df: DataFrame, shards: list[str], slots: int, key_col: str, to_slot: str = "slot",
          to_shard: str = "shard") -> DataFrame:
    """``df`` with the slot and the shard of every row; names that ``df`` uses get a suffix.

    Equal keys meet on one shard; null keys share the slot of the empty text.
    The table holds one row a slot (``MAX_SLOTS`` at most), so its broadcast
    is bounded whatever the size of ``df``; no row of ``df`` is shuffled.
    """
    spark: SparkSession = df.sparkSession
    to_slot, to_shard, join_slot = free_name(df, to_slot), free_name(df, to_shard), free_name(df, "table_slot")
    owner = [shards[i] for i in lookup_table(shards, slots)]
    table = spark.createDataFrame(pa.table({join_slot: list(range(slots)), to_shard: owner}))
    placed = df.withColumn(to_slot, slot_of(F.col(f"`{key_col}`"), slots))
    return placed.join(F.broadcast(table), F.col(f"`{to_slot}`") == F.col(f"`{join_slot}`"), "left").drop(join_slot)
