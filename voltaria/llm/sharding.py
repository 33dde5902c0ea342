"""Sharding by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own (offset + j * skip, a permutation because
the size is prime). Shards take turns claiming their next free slot until none is left, so every shard owns an equal
share (or one by weight) and losing a shard moves little but its own slots. The table has a fixed number of rows, so
broadcasting it is bounded however large the data are, and placing a row is one hash and one lookup. Rows are placed
by their own key, not by source or content, so a source with a third of all rows spreads like any other.

Edge cases: a null key is placed like the text "null"; equal keys share a shard; no rows give no rows; one shard owns
every slot.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SHARDS, SLOTS = 61, 4099


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], size: int = SLOTS, turns: dict[str, int] | None = None) -> list[int]:
    """The owner (index in ``shards``) of each slot. ``turns``: slots that a shard claims per round, 1 if not named."""
    if size < 2 or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table's size must be a prime, not {size}")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, at least one and at most as many as slots")
    start = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    asked, owner, free = [0] * len(shards), [-1] * size, size
    while free:
        for k, name in enumerate(shards):
            for _ in range((turns or {}).get(name, 1)):
                if not free:
                    return owner
                while owner[slot := (start[k] + asked[k] * skip[k]) % size] >= 0:
                    asked[k] += 1
                owner[slot] = k
                free -= 1
    return owner


def slot_of(key: Column | str, size: int = SLOTS) -> Column:
    """The slot of a key, the same in any engine: 60 bits of MD5 modulo the size."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit("null"))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % size).cast("int")


def place(df: DataFrame, key: str, shards: list[str], size: int = SLOTS, turns: dict[str, int] | None = None) -> DataFrame:
    """Adds slot and shard (its index) to each row by a broadcast of the filled table, ``size`` rows whatever the data.
    Columns of these names that the rows have are replaced, also where one of them is the key."""
    spark = df.sparkSession
    owners = spark.createDataFrame(list(enumerate(fill_table(shards, size, turns))), "slot int, shard int")
    placed = df.withColumn("__slot", slot_of(key, size)).drop("slot", "shard").withColumnRenamed("__slot", "slot")
    return placed.join(F.broadcast(owners), "slot")


def write_shards(df: DataFrame, key: str, shards: list[str], path: str, files: int = 4, size: int = SLOTS) -> None:
    """Writes one folder per shard, each dealt over ``files`` tasks by the key's hash."""
    placed = place(df, key, shards, size)
    part = F.pmod(F.xxhash64(key), F.lit(files))
    placed.repartition(len(shards) * files, "shard", part).write.partitionBy("shard").mode("overwrite").parquet(path)


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:05d}" for k in range(n)]


def op9_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"))
    return place(docs, "doc_id", shard_names()).select("doc_id", "slot", "shard", "n_bytes")


def op9_sql() -> str:
    owners = ", ".join(map(str, fill_table(shard_names())))
    return f"""
    WITH owners AS (SELECT [{owners}] AS o),
    d AS (SELECT doc_id, coalesce(strlen(text), 0)::INTEGER AS n_bytes,
                 (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) % {SLOTS})::INTEGER AS slot FROM documents)
    SELECT doc_id, slot, o[slot + 1]::INTEGER AS shard, n_bytes FROM d, owners"""
