"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size (start and step from a
digest of its name). The shards take turns, each claiming its most preferred slot that is still free, until
the table is full. Adding or removing a shard moves few slots, and shares differ by at most one slot. The
table has a fixed size, so it is broadcast, and each row is placed by one hash and one lookup.

Null keys are placed like the text ``\\N``; equal keys always meet in one shard, so a hot key cannot be
spread (give a key that has more values, for example document and part). Empty inputs give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, named

#: Prime number of slots of the production table (a fixed, proven broadcast size).
SLOTS = 65_537
#: Shards of the production table.
SHARDS = 64


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """Shard index of every slot, by turns over each shard's permutation of the slots."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if not _is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots must be a prime not below the number of shards")
    digests = [hashlib.md5(s.encode()).digest() for s in shards]
    start = [int.from_bytes(d[:8], "big") % slots for d in digests]
    step = [int.from_bytes(d[8:], "big") % (slots - 1) + 1 for d in digests]
    table, place, left = np.full(slots, -1, np.int32), list(start), slots
    while left:
        for i in range(len(shards)):
            at = place[i]
            while table[at] >= 0:
                at = (at + step[i]) % slots
            table[at], place[i] = i, (at + step[i]) % slots
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the leading 60 bits of its MD5 digest, modulo the prime size."""
    text = F.coalesce(key.cast("string"), F.lit("\\N"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % F.lit(slots)


def assign_shards(spark: SparkSession, df: DataFrame, key: Column, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with its slot (long) and shard (string) behind; rows keep all their columns and their number.

    The new columns are called slot and shard, with an underscore before for each column of ``df`` that has the name already.
    """
    slot, shard = free_name(df, "slot"), free_name(df, "shard")
    table = fill_table(shards, slots)
    lookup = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table.tolist())], f"`{slot}` long, `{shard}` string")
    return df.withColumn(slot, slot_of(key, slots)).join(F.broadcast(lookup), slot, "left").select(*named(df.columns), slot, shard)


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def oracle(columns: str, source: str = "documents", n: int = SHARDS, slots: int = SLOTS) -> str:
    """DuckDB SQL of the same placement; the filled table comes in as a list."""
    listed = ",".join(map(str, fill_table(shard_names(n), slots).tolist()))
    return f"""
WITH placed AS (
  SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '\\N')), 1, 15) AS BIGINT) % {slots} AS slot FROM {source}
), turns AS (SELECT [{listed}] AS owner)
SELECT {columns}, slot, printf('shard-%05d', owner[slot + 1]) AS shard FROM placed, turns
"""
