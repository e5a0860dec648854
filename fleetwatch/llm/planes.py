"""Token ids of documents in a bit-plane file format: shuffled blocks, compressed planes, a chunk index.

A token file is a Parquet table with one row per chunk, so that Spark writes and commits it on any store:

    shard int, chunk int, first long (ids of the shard before the chunk), n_ids int, width int,
    planes array<binary>, pieces array<struct<nth, key, place, length, total>>

A chunk holds a fixed number of ids (the last of a shard may hold fewer). Its ids are transposed into byte planes (all
low bytes, then all next bytes, ...) or bit planes, and each plane is compressed with zstandard on its own; a plane of
zeros is stored empty. `pieces` is the chunk index: which document each stretch of ids belongs to. Shards are ranges of
the key in ascending order, so shard, chunk and place give every id its place in the whole stream.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwatch.llm.support import partitions, pieces

CHUNK_SCHEMA = (
    "shard int, chunk int, first long, n_ids int, width int, planes array<binary>, "
    "pieces array<struct<nth:long, key:long, place:long, length:int, total:long>>"
)
_PIECE = pa.struct([("nth", pa.int64()), ("key", pa.int64()), ("place", pa.int64()), ("length", pa.int32()), ("total", pa.int64())])
_CHUNK = pa.schema(
    [("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("width", pa.int32()), ("planes", pa.list_(pa.binary())), ("pieces", pa.list_(_PIECE))]
)


def to_planes(ids: np.ndarray, bits: bool = False, level: int = 3) -> list[bytes]:
    """Unsigned 32-bit ids to compressed planes: 4 of bytes or 32 of bits, lowest first."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T
    if bits:
        rows = np.unpackbits(rows, axis=0, bitorder="little").reshape(4, 8, -1).reshape(32, -1)
        rows = np.packbits(rows, axis=1, bitorder="little")
    packer = zstandard.ZstdCompressor(level=level)
    return [packer.compress(row.tobytes()) if row.any() else b"" for row in rows]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    """The ids of to_planes; the number of planes tells bytes from bits."""
    bits = len(planes) == 32
    size = (n_ids + 7) // 8 if bits else n_ids
    unpacker = zstandard.ZstdDecompressor()
    rows = [np.frombuffer(unpacker.decompress(p, max_output_size=size), np.uint8) if p else np.zeros(size, np.uint8) for p in planes]
    rows = np.stack(rows) if size else np.zeros((len(planes), 0), np.uint8)
    if bits:
        rows = np.unpackbits(rows, axis=1, count=n_ids, bitorder="little").reshape(4, 8, n_ids)
        rows = np.packbits(rows, axis=1, bitorder="little").reshape(4, n_ids)
    return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)


def _writer(encode: Callable[[], Callable[[str | None], bytes]], end_id: int, block: int, bits: bool):
    tail = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, run = TaskContext.get().partitionId(), encode()
        chunk = first = nth = 0
        held, size, spans = [], 0, []  # ids waiting for their chunk, and whose they are

        def flush():
            nonlocal chunk, first, held, size, spans
            data = np.frombuffer(b"".join(held), "<u4")
            row = {"shard": shard, "chunk": chunk, "first": first, "n_ids": size, "width": 4, "planes": to_planes(data, bits), "pieces": spans}
            chunk, first, held, size, spans = chunk + 1, first + size, [], 0, []
            return pa.RecordBatch.from_pylist([row], schema=_CHUNK)

        for batch in pieces(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, place = run(text) + tail, 0
                total = len(ids) // 4
                while place < total:
                    n = min(block - size, total - place)
                    held.append(ids[4 * place : 4 * (place + n)])
                    spans.append({"nth": nth, "key": key, "place": place, "length": n, "total": total})
                    place, size = place + n, size + n
                    if size == block:
                        yield flush()
                nth += 1
        if size:
            yield flush()

    return write


def token_chunks(docs: DataFrame, encode, key: str = "doc_id", text: str = "text", end_id: int = 1, block: int = 65_536, bits: bool = False) -> DataFrame:
    """Chunk rows of the format: every document's ids and end_id, in ascending key order.

    encode() is called in each task and returns text -> little-endian unsigned 32-bit ids. A null or empty text gives
    its end id alone. Equal keys and repeated rows are documents of their own, ordered by a hash of the text; null keys
    come first. Other columns are not read. An empty table gives no chunks.
    """
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    # the last sort key only splits keys that repeat without end among ranges
    order = ["key", F.xxhash64("body"), F.crc32(F.col("body").cast("binary"))]
    ranged = narrow.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return ranged.mapInArrow(_writer(encode, end_id, block, bits), CHUNK_SCHEMA)


def write_tokens(docs: DataFrame, path: str, encode, **options) -> DataFrame:
    """Write the token file of docs to path and return its chunks as read back."""
    spark = docs.sparkSession
    token_chunks(docs, encode, **options).write.option("compression", "none").parquet(path)
    return spark.read.schema(CHUNK_SCHEMA).parquet(path)


_PART = "shard int, nth long, key long, place long, total long, begin long, ids binary, crc long"
_READ = pa.schema(
    [("shard", pa.int32()), ("nth", pa.int64()), ("key", pa.int64()), ("place", pa.int64()), ("total", pa.int64()), ("begin", pa.int64()), ("ids", pa.binary()), ("crc", pa.int64())]
)


def _reader(with_ids: bool):
    """Parts of documents in a chunk; a part that is the whole document has its crc, others their ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 8):
            for row in batch.to_pylist():
                ids, at, out = from_planes(row["planes"], row["n_ids"]).tobytes(), 0, []
                for p in row["pieces"]:
                    part, begin = ids[4 * at : 4 * (at + p["length"])], row["first"] + at
                    whole = p["length"] == p["total"]
                    out.append(
                        {"shard": row["shard"], "nth": p["nth"], "key": p["key"], "place": p["place"], "total": p["total"]}
                        | {"begin": None if p["place"] else begin, "ids": None if whole and not with_ids else part, "crc": zlib.crc32(part) if whole else None}
                    )
                    at += p["length"]
                yield pa.RecordBatch.from_pylist(out, schema=_READ)

    return read


def _documents(chunks: DataFrame, with_ids: bool) -> DataFrame:
    """Parts of a document come together by shard and number; starts add the totals of earlier shards, one row each."""
    held = F.when(F.col("ids").isNotNull(), F.struct("place", "ids"))
    docs = (
        chunks.mapInArrow(_reader(with_ids), _PART)
        .groupBy("shard", "nth")
        .agg(F.first("key").alias("key"), F.first("total").alias("n_tokens"), F.max("begin").alias("begin"), F.max("crc").alias("crc"), F.array_sort(F.collect_list(held)).alias("parts"))
    )
    totals = chunks.groupBy("shard").agg(F.sum(F.col("n_ids").cast("long")).alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    parts = F.transform("parts", lambda x: x["ids"])
    return docs.join(bases, "shard").select("key", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "crc", parts.alias("parts"))


def read_tokens(chunks: DataFrame) -> DataFrame:
    """Documents of a token file: key, start (ids of all documents before it), n_tokens and the ids themselves."""
    join = F.udf(lambda parts: b"".join(parts), "binary")
    return _documents(chunks, True).select("key", "start", "n_tokens", join("parts").alias("ids"))


def token_digests(chunks: DataFrame) -> DataFrame:
    """As read_tokens, with the unsigned crc32 of a document's ids in place of the ids.

    Chunks decode on their own; only the parts of a document that lies in several chunks are shuffled.
    """
    crc = F.udf(lambda parts: zlib.crc32(b"".join(parts)), "long")
    return _documents(chunks, False).select("key", "start", "n_tokens", F.coalesce("crc", crc("parts")).alias("ids_crc32"))
