"""Contiguous shards of equal bytes (column expressions only).

Rows are put in one global order by range partitioning and written with their partition's number. Each partition's total
bytes and rows give global prefix sums; a row's shard is the one whose equal share of the bytes holds the row's middle
byte. The only small table is one row per partition, and one per shard for the slots.

Defined cases: a null or empty text weighs ``overhead`` bytes, so nothing weighs nothing; rows with equal keys, null keys
(first) and fully repeated rows are told apart by where they were read, so any number of them can be split between
partitions and shards; an empty table gives an empty result; fewer rows than shards leave shards empty. Input columns
that have the name of a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize


def text_size(text: Column, overhead: int = 8) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead


def shard_by_bytes(rows: DataFrame, shards: int, order: list[str], size: str = "size") -> DataFrame:
    """Add ``shard`` (0 .. shards - 1) and ``slot`` (gapless from 0 in each shard) to rows with a positive ``size``.

    Ask only for the columns that the result needs: they are what is sorted.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    keys = [*order, "place_"]
    ranged = rows.select(*names, F.monotonically_increasing_id().alias("place_")).repartitionByRange(*keys)
    ranged = materialize(ranged.withColumn("part_", F.spark_partition_id()), "shard-rows")

    totals = ranged.groupBy("part_").agg(F.sum(size).alias("bytes_"), F.count(F.lit(1)).alias("rows_"))
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(totals.select(
        "part_",
        F.coalesce(F.sum("bytes_").over(before), F.lit(0)).alias("byte_offset_"),
        F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("row_offset_"),
        F.sum("bytes_").over(Window.partitionBy()).alias("all_bytes_"),
    ), "shard-offsets")

    inside = Window.partitionBy("part_").orderBy(*keys)
    placed = ranged.withColumns({
        "end_": F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "nth_": F.row_number().over(inside).cast("long"),
    }).join(offsets, "part_")
    # Twice the row's middle byte over twice the total, in whole decimals: bytes times shards may pass 2^63.
    middle = f"cast(2 * (byte_offset_ + end_) - `{size}` as decimal(20,0))"
    shard = F.expr(f"cast({middle} * {int(shards)} div cast(2 * all_bytes_ as decimal(20,0)) as int)")
    placed = placed.select(*names, shard.alias("shard"), (F.col("row_offset_") + F.col("nth_") - 1).alias("index_"))
    placed = materialize(placed, "shard-placed")
    first = placed.groupBy("shard").agg(F.min("index_").alias("first_"))
    return placed.join(F.broadcast(first), "shard").select(*names, "shard", (F.col("index_") - F.col("first_")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every document, in the order of ``key``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key), text_size(F.col(text)).alias("size"), F.crc32(body).alias("text_crc32"))
    return shard_by_bytes(rows, shards, [key])
