"""Placement by a lookup table that the shards fill in turns.

Each shard goes through the slots of a table of prime size in an order of its own (a start and a step, both from a hash
of its name); the shards take turns, and at its turn each claims the first slot of its order that is still free.  So
each gets as many slots as any other, give or take one, and few slots move when a shard comes or goes.  A row goes to
the shard of the slot that its key's hash names: one lookup, without regard to the number of shards.

The table is filled on the driver: its size is a parameter and does not depend on the data.  Rows see nothing but
built-in expressions and a broadcast join with the table, whose rows are counted beforehand.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A table beyond this many slots is joined without the broadcast hint.
BROADCAST_SLOTS = 1_000_000


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int) -> list[int]:
    """The shard's number for each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table's size must be a prime, and no less than the number of shards")
    order = [(_hash(f"{s}/start") % size, _hash(f"{s}/step") % (size - 1) + 1) for s in shards]
    owner, tried, free = [-1] * size, [0] * len(shards), size
    while True:
        for k, (start, step) in enumerate(order):
            while owner[slot := (start + tried[k] * step) % size] >= 0:
                tried[k] += 1
            owner[slot] = k
            free -= 1
            if not free:
                return owner


def slot_of(keys: list[Column], size: int) -> Column:
    """The slot of a key: 60 bits of the MD5 of its columns' texts; null counts as empty, the separator as itself."""
    key = F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long") % F.lit(size)).cast("long")


def assign_shards(df: DataFrame, key_cols: list[str], shards: list[str], size: int, prefix: str = "") -> DataFrame:
    """df with slot long and shard string added (under prefix, which must keep them apart from df's own columns).

    A key of nulls or empty texts has a slot as any other; equal keys go to the same shard, so that repeated rows stay
    together.  A hot value of another column does no harm, as only the key counts.
    """
    slot, shard = f"{prefix}slot", f"{prefix}shard"
    if clash := {slot, shard} & set(df.columns):
        raise ValueError(f"choose a prefix: {sorted(clash)} are columns already")
    session, key = df.sparkSession, "_key"
    while key in (*df.columns, slot, shard):
        key += "_"
    owners = ",".join(map(str, lookup_table(shards, size)))
    names = F.array(*[F.lit(s) for s in shards])
    table = session.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias(key, "owner")).select(F.col(key).cast("long").alias(key), F.get(names, F.col("owner").cast("int")).alias(shard))
    if size <= BROADCAST_SLOTS:
        table = F.broadcast(table)
    return df.withColumn(slot, slot_of([F.col(f"`{c}`") for c in key_cols], size)).join(table, F.col(slot) == F.col(key), "left").drop(key)


def write_shards(df: DataFrame, key_cols: list[str], shards: list[str], size: int, path: str, rows_per_file: int = 1_000_000) -> None:
    """Writes one folder for each shard.  Rows of one shard come from many tasks, whose files are bounded by rows_per_file."""
    assign_shards(df, key_cols, shards, size, "_").repartition("_slot").drop("_slot").write.option("maxRecordsPerFile", rows_per_file).partitionBy("_shard").parquet(path)
