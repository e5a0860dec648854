"""Resampling documents towards a target distribution of hashed n-grams, with CRCs taken from two prefixes.

A text is normalised to its words with one space before each. One scan stores the running CRC-32 behind every word. The
CRC is linear over GF(2): crc(AB) = shift(crc(A), len(B)) ^ crc(B), where shift() appends zero bytes. So the CRC of any
run of words is the running value at its end, with the one at its begin shifted away; no n-gram is ever put together.

A document's weight is the mean gain (log ratio of target to source frequency) of its n-grams' buckets. With a Gumbel
draw from its id added, the highest scores are a sample without replacement in proportion to exp(weight / 1000).
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatch.llm.leaks import words_of
from fleetwatch.llm.support import pieces, stored

ORDERS = 2
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = "7"
#: Equal rows are numbered in runs of so many.
_RUN = 4096
#: Scores are added up in blocks of so many values, so that one task sees a row per block.
_SCORES = 1024


def _byte_steps() -> np.ndarray:
    """What the register becomes when a byte's worth of zeros follows it, by its lowest byte."""
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = np.where(register & 1, (register >> 1) ^ np.uint32(0xEDB88320), register >> 1)
    return register


_STEP = _byte_steps()


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


def _append(crc: np.ndarray, byte: int) -> np.ndarray:
    """The CRC after one more byte."""
    flipped = ~crc
    return ~(_STEP[(flipped ^ np.uint32(byte)) & 255] ^ (flipped >> 8))


class _Shifts:
    """shift() for any number of zero bytes, as tables for the powers of two."""

    def __init__(self):
        values = np.arange(256, dtype=np.uint32)
        self.powers = [np.stack([_STEP[(values << k) & 255] ^ ((values << k) >> 8) for k in (0, 8, 16, 24)])]

    def __call__(self, crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
        out = crc.copy()
        for bit in range(int(n_bytes.max(initial=0)).bit_length()):
            if bit == len(self.powers):
                last = self.powers[-1]
                self.powers.append(np.stack([_apply(last, row) for row in last]))
            at = np.flatnonzero((n_bytes >> bit) & 1)
            out[at] = _apply(self.powers[bit], out[at])
        return out


_SHIFT = _Shifts()


class Prefixes:
    """Running CRCs over the words of some texts, scanned once."""

    def __init__(self, texts: list[list[bytes]]):
        self.sizes = np.array([len(words) for words in texts], np.int64)
        self.last = np.repeat(np.cumsum(self.sizes), self.sizes)  # behind the last word of each word's text
        spaced = [b" " + word for words in texts for word in words]
        crc, ends = 0, [0]
        for word in spaced:
            crc = crc32(word, crc)
            ends.append(crc)
        self.ends = np.array(ends, np.uint32)
        self.starts = _append(self.ends[:-1], 32)
        raw = np.frombuffer(b"".join(spaced), np.uint8)
        self.bytes = np.append(np.flatnonzero(raw == 32), len(raw))  # where each word's space stands

    def crcs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and CRCs of all runs of n words that lie in one text, joined by one space."""
        first = np.flatnonzero(np.arange(len(self.last)) + n <= self.last)
        length = self.bytes[first + n] - self.bytes[first] - 1
        return first, self.ends[first + n] ^ _SHIFT(self.starts[first], length)


def _bucket_counts(texts: list[str | None], orders: int, buckets: int) -> np.ndarray:
    prefixes = Prefixes([words_of(t) for t in texts])
    return sum(np.bincount(prefixes.crcs(n)[1] % buckets, minlength=buckets) for n in range(1, orders + 1))


def count_buckets(rows: DataFrame, text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many n-grams of all texts fall into each bucket, repeats counted; a row per bucket that is used."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in pieces(batches):
            total += _bucket_counts(batch.column(0).to_pylist(), orders, buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    counted = rows.select(F.col(text).cast("string").alias("body")).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain for every bucket, from count_buckets() of both; gain = floor(1000 ln of the smoothed ratio)."""
    spark = source.sparkSession
    both = (
        spark.range(buckets).select(F.col("id").alias("bucket"))
        .join(source.select("bucket", F.col("n").alias("s")), "bucket", "left")
        .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    )
    sums = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    whole_s, whole_t = (F.lit(float((x or 0) + buckets)) for x in sums)
    ratio = ((F.col("t") + 1) * whole_s) / ((F.col("s") + 1) * whole_t)
    return both.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).cast("long").alias("gain"))


def weigh(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text", orders: int = ORDERS) -> DataFrame:
    """key, n_words, n_features, weight of every row; weight is the mean gain rounded down, 0 without features."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in pieces(batches):
            prefixes = Prefixes([words_of(t) for t in batch.column(1).to_pylist()])
            edges = np.concatenate([[0], np.cumsum(prefixes.sizes)])
            features, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for n in range(1, orders + 1):
                first, crcs = prefixes.crcs(n)
                sums = np.concatenate([[0], np.cumsum(table[crcs % len(table)])])
                at = np.searchsorted(first, edges)
                features += at[1:] - at[:-1]
                total += sums[at[1:]] - sums[at[:-1]]
            weights = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in (prefixes.sizes, features, weights)]],
                names=["key", "n_words", "n_features", "weight"],
            )

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    return narrow.mapInArrow(score, "key long, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: str = SEED) -> Column:
    """1000 times a Gumbel draw, rounded down, that the seed and the id alone decide; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def rank_highest(rows: DataFrame, eligible: Column, percent: int = PERCENT) -> DataFrame:
    """rows with `rank` 1, 2, ... for the highest scores among the eligible, floor(percent of their number) of them.

    rows: key, score and other columns, read several times, so best a stored table. Ties go to the smaller key, null keys
    last; of rows alike in all columns any may be drawn. Scores are counted first: rows whose score has at least as many
    above it as are drawn are ranked no further, the others within their score. Equal rows are one row with a count.
    """
    names = rows.columns
    marked = rows.withColumn("_eligible", F.coalesce(eligible, F.lit(False)))
    drawn = marked.agg(F.count_if("_eligible")).first()[0] * percent // 100
    counts = marked.where("_eligible").groupBy("score").agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_block", F.floor(F.col("score") / _SCORES))
    # Windows over blocks, then within a block; the number of blocks is bounded by the range of scores, not by rows.
    blocks = counts.groupBy("_block").agg(F.sum("_n").alias("_of_block"))
    higher = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", F.coalesce(F.sum("_of_block").over(higher), F.lit(0)).alias("_blocks_above"))
    inside = Window.partitionBy("_block").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    above = counts.join(blocks, "_block").select(
        "score", (F.col("_blocks_above") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_above")
    )
    above = above.where(F.col("_above") < drawn).withColumn("_eligible", F.lit(True))

    same = marked.groupBy(*names, "_eligible").agg(F.count("*").alias("_copies")).join(above, ["score", "_eligible"], "left")
    rest = same.where("_above IS NULL").withColumn("_before", F.lit(None).cast("long"))
    place = [F.col("key").asc_nulls_last(), *[F.col(c) for c in names if c not in ("key", "score")]]
    earlier = Window.partitionBy("score").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    near = same.where("_above IS NOT NULL").withColumn("_before", F.col("_above") + F.coalesce(F.sum("_copies").over(earlier), F.lit(0)))
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / _RUN))
    numbers = F.sequence(F.col("_run") * _RUN + 1, F.least("_copies", (F.col("_run") + 1) * _RUN))
    rank = F.col("_before") + F.col("_i")
    return (
        near.unionByName(rest)
        .withColumn("_run", F.explode(runs))
        .withColumn("_i", F.explode(numbers))
        .select(*names, F.when(rank <= drawn, rank).alias("rank"))
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    orders: int = ORDERS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """key, n_features, weight, score and rank (null if not drawn) of every row of docs.

    Texts without words and null texts have no features and weight 0; a null id draws as an empty one; repeated rows each
    count and each give a row. Empty docs give an empty table; an empty target weighs by the source alone. Two scans of
    docs: one for the counts of all buckets, one for the weights. The driver sees the gain of each bucket and two totals.
    """
    # Stored, as the gains read them for the sums and again for each bucket.
    counts = [stored(count_buckets(rows, column, orders, buckets), "counts") for rows, column in ((docs, text), (target, target_text))]
    gains = bucket_gains(*counts, buckets)
    by_bucket = np.zeros(buckets, np.int64)
    for row in gains.collect():
        by_bucket[row["bucket"]] = row["gain"]
    weighed = weigh(docs, by_bucket, key, text, orders).withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
    ranked = rank_highest(stored(weighed, "weights"), F.col("n_words") >= least_words, percent)
    return ranked.select("key", "n_features", "weight", "score", "rank")
