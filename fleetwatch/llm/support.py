"""What the operators of this package share: stored intermediate tables, word splitting and row batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from fleetwatch.session import scratch_path

_ASCII = bytes(range(128))
#: A-Z to a-z, everything else unchanged.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Lower-cases A-Z and turns each ASCII byte that is neither letter nor digit into a space.
ALNUM = bytes(
    LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def short_batches(spark: SparkSession) -> None:
    """Arrow batches of a few megabytes: ten thousand long texts at once would not fit beside others in an executor."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df below the shared scratch folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; null counts as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def space_words(raw: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of a UTF-8 text."""
    return raw.split()


class Powers:
    """Powers of an odd number and of its inverse modulo 2 ** 64, as many as were ever asked for."""

    _BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(size, x, np.uint64)]) for x in (self._BASE, pow(self._BASE, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


_powers = Powers()
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_OF_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
#: Words of more bytes are hashed one by one: sums of powers are for short words.
_LONG = 64
#: Bytes hashed at once.
_BLOCK = 1 << 20


def word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each of the words of space_words()."""
    space = np.ones(len(raw) + 2, bool)
    np.take(_IS_SPACE, np.frombuffer(raw, np.uint8), out=space[1:-1])
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


def word_hashes(raw: bytes, places: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """A 64-bit hash of each of the words of space_words(), all at once: sums of powers over their bytes, mixed.

    places: those of the words, if they are known.
    """
    begin, end = word_places(raw) if places is None else places
    out = np.empty(len(begin), np.uint64)
    first = 0
    while first < len(begin):
        zero = begin[first]
        last = max(first + 1, int(np.searchsorted(end, zero + _BLOCK, "right")))
        a, b = begin[first:last] - zero, end[first:last] - zero
        if b[-1] <= _BLOCK:  # else one word, longer than a block
            up, down = _powers(int(b[-1]))
            total = np.zeros(int(b[-1]) + 1, np.uint64)
            np.cumsum(_OF_BYTE[np.frombuffer(raw, np.uint8, int(b[-1]), int(zero))] * up, out=total[1:])
            x = (total[b] - total[a]) * down[a]
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            out[first:last] = x ^ (x >> np.uint64(32))
        first = last
    for i in np.flatnonzero(end - begin > _LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[begin[i] : end[i]])
    return out


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a few, so that long texts do not pile up in one worker."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
