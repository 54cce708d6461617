"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of
prime size; the shards take turns claiming their next free slot until the
table is full.  A key's slot is its hash modulo the table size.  Shards get
equal numbers of slots (they differ by one at most), and removing a shard
moves few keys of the others.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh

MAX_TABLE = 1_000_003  # largest table that is broadcast: 16 MB


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], size: int) -> list[int]:
    """Slot -> index of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct, and there must be one at least")
    if not _is_prime(size) or size > MAX_TABLE or size < len(shards):
        raise ValueError(f"the table size must be a prime of at most {MAX_TABLE}, "
                         "with a slot for each shard")
    start = [_number(f"{s}/start") % size for s in shards]
    step = [_number(f"{s}/step") % (size - 1) + 1 for s in shards]
    owner, at, filled = [-1] * size, list(start), 0
    while True:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            owner[at[i]] = i
            filled += 1
            if filled == size:
                return owner


def slot_of(key: Column, size: int) -> Column:
    """Slot of a key; NULL counts as the empty string."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size).cast("int")


def assign_shards(df: DataFrame, shards: list[str], key_col: str = "doc_id",
                  size: int = 4099) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (the shard's name); the names get
    a leading underscore where ``df`` has them already.

    The table (at most MAX_TABLE rows, checked) is broadcast; no row of
    ``df`` is shuffled.  Rows with the same key go to the same shard; a NULL
    key counts as the empty string.  An empty ``df`` gives no rows.
    """
    slot, shard = fresh(df, "slot", "shard")
    owner = lookup_table(shards, size)
    table = df.sparkSession.createDataFrame(
        [(i, shards[o]) for i, o in enumerate(owner)], f"`{slot}` int, `{shard}` string")
    return (df.withColumn(slot, slot_of(F.col(key_col), size))
            .join(F.broadcast(table), slot)
            .select(*df.columns, slot, shard))


def write_shards(df: DataFrame, path: str, shards: list[str], key_col: str = "doc_id",
                 size: int = 4099, files_per_shard: int = 8) -> None:
    """Write ``df`` as one folder per shard.  Rows are dealt out by shard
    and slot group, so a shard is written by several tasks."""
    placed = assign_shards(df, shards, key_col, size)
    slot, shard = placed.columns[-2:]
    part = fresh(placed, "part")[0]
    (placed.withColumn(part, F.col(slot) % files_per_shard)
     .repartition(len(shards) * files_per_shard, shard, part)
     .drop(part, slot).write.partitionBy(shard).mode("overwrite").parquet(path))


N_SHARDS, TABLE_SIZE = 32, 4099
SHARDS = [f"shard-{i:03d}" for i in range(N_SHARDS)]


def op7_sharding(spark, sf_dir):
    from tidemark.llm.common import read
    docs = read(spark, sf_dir, "documents").select("doc_id")
    return assign_shards(docs, SHARDS, "doc_id", TABLE_SIZE)


# The claims as a recursion: one step is one claim.  ``free`` has a 1 for each
# free slot; the claiming shard takes the first free one in its order.
OP7_SQL = f"""
WITH RECURSIVE orders AS (
  SELECT i, list(slot ORDER BY j) AS slots
  FROM (SELECT i, j, (('0x' || substr(md5(printf('shard-%03d/start', i)), 1, 15))::BIGINT % {TABLE_SIZE}
                + j * (('0x' || substr(md5(printf('shard-%03d/step', i)), 1, 15))::BIGINT
                       % {TABLE_SIZE - 1} + 1)) % {TABLE_SIZE} AS slot
        FROM range({N_SHARDS}) a(i), range({TABLE_SIZE}) b(j))
  GROUP BY i),
claims AS (
  SELECT -1 AS turn, 0::BIGINT AS slot, repeat('1', {TABLE_SIZE})::BIT AS free
  UNION ALL
  SELECT turn + 1, s, set_bit(free, s::INTEGER, 0)
  FROM (SELECT turn, free, list_filter(slots, lambda x: get_bit(free, x::INTEGER) = 1)[1] AS s
        FROM claims JOIN orders ON i = (turn + 1) % {N_SHARDS} WHERE turn + 1 < {TABLE_SIZE}))
SELECT d.doc_id, d.slot::INTEGER AS slot, printf('shard-%03d', turn % {N_SHARDS}) AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {TABLE_SIZE} AS slot
      FROM documents) d
JOIN (SELECT turn, slot FROM claims WHERE turn >= 0) c ON c.slot = d.slot
"""
