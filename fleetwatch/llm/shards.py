"""Contiguous shards of nearly equal size: prefix sums of sizes, from the totals of range partitions.

Rows are put in ranges by an order. Each range is sorted and numbered on its own; totals of ranges (one row each) give
every range its offset, so a row knows how many bytes and rows come before it anywhere. A shard is then a cut of that
line at equal targets: a row belongs to the shard in which its middle lies, so each cut is at most half a row off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatch.llm.support import partitions, stored


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the range's number, the row's place in it and the sum of the sizes before it."""
    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sizes = pc.cast(batch.column("size"), pa.int64()).to_numpy(zero_copy_only=False)
        ends = total + np.cumsum(sizes, dtype=np.int64)
        n = batch.num_rows
        columns = [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rows, rows + n, dtype=np.int64)), pa.array(ends - sizes)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "place", "before"])
        if n:
            rows, total = rows + n, int(ends[-1])


def assign_shards(rows: DataFrame, n_shards: int, order: list[str]) -> DataFrame:
    """rows has the columns of `order` and `size` (long, at least 1), and any others not named shard, slot, part, place
    or before; the result adds shard (0 to n_shards - 1) and slot (place in the shard, gapless from 0).

    Sizes of shards differ from total / n_shards by less than the largest row. Shards may be empty if there are fewer
    rows than shards. Rows that tie in `order` keep some order, the same in every read of the result. An empty table
    gives no rows. What is shuffled is these columns alone, once; the numbered rows are stored before they are used.
    """
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    numbered = stored(ranged.mapInArrow(_number, f"{fields}, part int, place long, before long"), "shards")
    totals = numbered.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("sum"))
    line = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    whole = Window.partitionBy()
    bases = totals.select(
        "part",
        F.coalesce(F.sum("n").over(line), F.lit(0)).alias("row_base"),
        F.coalesce(F.sum("sum").over(line), F.lit(0)).alias("base"),
        F.sum("sum").over(whole).alias("total"),
    )
    middle = 2 * (F.col("base") + F.col("before")) + F.col("size")  # twice the place of the row's middle
    placed = numbered.join(F.broadcast(bases), "part").withColumn(
        "shard", F.least(F.lit(n_shards - 1), F.floor(middle.cast("decimal(38,0)") * n_shards / (2 * F.col("total")))).cast("int")
    )
    placed = placed.withColumn("row", F.col("row_base") + F.col("place"))
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("row") - F.col("first")).drop("part", "place", "before", "row_base", "base", "total", "row", "first")


def byte_size(text: Column, overhead: int = 8) -> Column:
    """UTF-8 bytes of a text (null: none) plus a fixed number per row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")


def shard_documents(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32 (unsigned, of the UTF-8 text; null counts as empty), shard and slot of every document.

    Order: key, then size and checksum of the text, so equal keys and repeated rows stay rows of their own. Null keys
    come first. Other columns are not read. Texts are not shuffled.
    """
    body = F.col(text).cast("string")
    rows = docs.select(F.col(key).cast("long").alias("key"), byte_size(body).alias("size"), F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"))
    return assign_shards(rows, n_shards, ["key", "size", "text_crc32"])


def write_shards(docs: DataFrame, path: str, n_shards: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the documents themselves, one folder per shard, rows in slot order within each file.

    Every row keeps its columns and gets _shard and _slot. Documents are told apart by key, size and checksum; repeated
    rows take their slots in some order.
    """
    body = F.col(text).cast("string")
    named = docs.select(F.struct(*docs.columns).alias("doc"), F.col(key).cast("long").alias("key"), byte_size(body).alias("size"), F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"))
    places = shard_documents(docs, n_shards, key, text)
    same = ["key", "size", "text_crc32"]
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0)))
    mine = named.withColumn("nth", nth)
    theirs = places.withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy("shard", "slot")))
    match = [mine[c].eqNullSafe(theirs[c]) for c in [*same, "nth"]]
    joined = mine.join(theirs, match).select("doc.*", theirs["shard"].alias("_shard"), theirs["slot"].alias("_slot"))
    joined.repartitionByRange(n_shards * 4, "_shard", "_slot").sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)
