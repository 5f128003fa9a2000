"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size.  The shards take turns, each
claiming the next slot of its order that is still free, until the table is full.  A row's key hashes to a slot and
the slot names the shard, so placement costs one hash and one array read per row, needs no shuffle, spreads keys to
within a fraction of a percent, and moves few keys when a shard joins or leaves.

The table is filled once on the driver (its size is a parameter, checked against `MAX_SLOTS`) and reaches the tasks
as the value of a scalar subquery: a broadcast whose size never depends on the data.

Defined results: a null key is placed by the md5 of the `spread` columns (so a table full of null keys does not land
in one shard); equal keys always share a shard; an empty table gives no rows; input columns are never read beyond
`key` and `spread`, and an input column called `slot` or `shard` is replaced by the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SLOTS = 1_000_003


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill_table(shards: Sequence[str], size: int, weights: Sequence[int] | None = None) -> list[int]:
    """The slot -> shard index table.  `weights[i]` slots are claimed by shard i in each of its turns."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if not _is_prime(size) or not len(shards) <= size <= MAX_SLOTS:
        raise ValueError(f"the table size must be a prime between the shard count and {MAX_SLOTS}")
    weights = weights or [1] * len(shards)
    if len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("one weight of at least 1 per shard")
    at = [_hash(f"{s}|offset") % size for s in shards]
    step = [_hash(f"{s}|skip") % (size - 1) + 1 if size > 1 else 0 for s in shards]
    table, free = [-1] * size, size
    while free:
        for i, turns in enumerate(weights):
            for _ in range(min(turns, free)):
                while table[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % size
                table[at[i]] = i
                free -= 1
    return table


def slot_of(key: Column, size: int) -> Column:
    """Slot of a non-null string key: the first 60 bits of its md5, modulo the table size."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint"), F.lit(size))


def place(df: DataFrame, key: str, shards: Sequence[str], size: int, weights: Sequence[int] | None = None,
          spread: Sequence[str] = ()) -> DataFrame:
    """Adds `slot` (bigint) and `shard` (string) to every row of `df`."""
    table = fill_table(shards, size, weights)
    names = F.array(*[F.lit(s) for s in shards])
    lookup = (df.sparkSession.range(1)
              .select(F.from_json(F.lit(str(table)), "array<int>").alias("t")).scalar())
    other = F.md5(F.concat_ws("\x1f", *[F.coalesce(df[c].cast("string"), F.lit("\x00")) for c in spread]))
    text = F.coalesce(df[key].cast("string"), other if spread else F.lit(""))
    return (df.withColumn("slot", slot_of(text, size))
            .withColumn("shard", F.get(names, F.get(lookup, F.col("slot").cast("int")))))
