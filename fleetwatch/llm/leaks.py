"""Benchmark passages in documents: Wu-Manber search for many word strings at once.

Words are the alphabet. For patterns of one length m the shift table says, for each block of two words, how far the
search window may jump: m - 1 if no pattern holds the block, else the distance from the block's last place in a pattern
to the pattern's end. Only windows that end in a pattern's last block have shift 0; its suffix bucket lists the pattern
strings to compare directly. Patterns are windows of ten words of a benchmark item; shorter items are patterns of their
own length, searched with tables of that length.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.support import ALNUM, pieces, utf8

WINDOW = 10
#: UTF-8 bytes of benchmark text in one set of tables; more text is searched in further passes.
BLOCK_BYTES = 16_000_000


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased."""
    return utf8(text).translate(ALNUM).split()


class _Length:
    """Shift table and suffix buckets for patterns of one length."""

    def __init__(self, length: int):
        self.m, self.b = length, min(2, length)
        self.shift: dict = {}
        self.buckets: dict = defaultdict(dict)  # last block -> pattern -> items

    def add(self, pattern: tuple, item) -> None:
        for end in range(self.b, self.m + 1):
            block = pattern[end - self.b : end]
            self.shift[block] = min(self.shift.get(block, self.m), self.m - end)
        self.buckets[pattern[self.m - self.b :]].setdefault(pattern, set()).add(item)

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(place of the first word, items) of every window of a text that is a pattern."""
        m, b, shift, buckets = self.m, self.b, self.shift, self.buckets
        jump, n, end = m - b + 1, len(words), m
        get = shift.get
        if b == 2:
            while end <= n:
                move = get((words[end - 2], words[end - 1]), jump)
                if move:
                    end += move
                    continue
                found = buckets[words[end - 2], words[end - 1]].get(tuple(words[end - m : end]))
                if found:
                    yield end - m, found
                end += 1
        else:
            for at, word in enumerate(words):
                if (word,) in shift:
                    yield at, buckets[(word,)][(word,)]


class Patterns:
    """Tables for the windows of benchmark items, one set for each length of pattern."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.lengths: dict[int, _Length] = {}
        for item, text in items:
            words = words_of(text)
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if size else 0):
                self.lengths.setdefault(size, _Length(size)).add(tuple(words[at : at + size]), item)

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged [begin, end) stretches of words inside an occurrence, and the items with one."""
        spans, items = [], set()
        for table in self.lengths.values():
            for at, found in table.occurrences(words):
                spans.append((at, at + table.m))
                items |= found
        return merge(spans), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [tuple(x) for x in out]


_TABLES: dict = {}


def _patterns(shared, window: int) -> Patterns:
    """Built once per worker for each broadcast block of items."""
    key = (shared.value["id"], window)
    if key not in _TABLES:
        if len(_TABLES) > 3:
            _TABLES.clear()
        _TABLES[key] = Patterns(shared.value["items"], window)
    return _TABLES[key]


def item_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcast blocks of distinct (item, text) rows, each of about block_bytes; items without words are left out."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("body")).where("body IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    context, blocks = benchmark.sparkSession.sparkContext, []
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k)
        found = sorted((r["item"] or "", r["body"]) for r in part.toLocalIterator())
        digest = hashlib.sha256(repr(found).encode("utf-8", "surrogatepass")).hexdigest()
        blocks.append(context.broadcast({"id": digest, "items": found}))
    return blocks



def find_occurrences(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """key, n_words, spans (begin and end words of merged hit stretches, flat) and items of every document row.

    Every row of docs gives one row, repeated keys too. A null or empty text has no words; null or wordless items match
    nothing; an item id that repeats counts once; a null item id is the empty id. An empty benchmark hits nothing. The
    benchmark is broadcast in blocks of bounded size; with more than one block each row is searched once per block,
    in the same pass over the documents, and a worker keeps the tables of at most four blocks.
    """
    blocks = item_blocks(benchmark, item, item_text, block_bytes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [[k, words_of(t), [], set()] for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            for block in blocks:
                tables = _patterns(block, window)
                for row in rows:
                    spans, items = tables.search(row[1])
                    row[2] += spans
                    row[3] |= items
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([len(r[1]) for r in rows], pa.int64()),
                    pa.array([np.array(merge(r[2]), np.int64).ravel() for r in rows], pa.list_(pa.int64())),
                    pa.array([sorted(r[3]) for r in rows], pa.list_(pa.string())),
                ],
                names=["key", "n_words", "spans", "items"],
            )

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    return narrow.mapInArrow(search, "key long, n_words long, spans array<bigint>, items array<string>")


def leak_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """find_occurrences as counts: key, n_words, n_hit, n_items, items_sha256 (of the sorted ids, comma-joined), contaminated."""
    found = find_occurrences(docs, benchmark, **options)
    lengths = F.transform(F.sequence(F.lit(0), F.size("spans") - 1), lambda i: F.when(i % 2 == 0, -F.get("spans", i)).otherwise(F.get("spans", i)))
    hit = F.when(F.size("spans") > 0, F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long"))
    return found.select(
        "key",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the rows that hold an occurrence; all columns, whatever their names, stay as they are."""
    blocks, at = item_blocks(benchmark, item, item_text, block_bytes), docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [words_of(t) for t in batch.column(at).to_pylist()]
            keep = np.ones(len(texts), bool)
            for block in blocks:
                tables = _patterns(block, window)
                keep &= [not tables.search(words)[0] for words in texts]
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)
