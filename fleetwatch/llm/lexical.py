"""Ranked lexical search: term at a time with a limited number of accumulators.

Documents are reduced to their occurrences of the items' terms, from which tasks build postings for a block of documents
at a time. An item takes its terms from the rarest to the most frequent. While a document that none of its terms has met
so far could still be among the best, each posting may create an accumulator; as soon as the bounds of the terms that
remain add up to less than the kth best partial score, only accumulators that exist are updated, to their exact scores.
Tasks keep the best of each item over their blocks, so that later blocks start with a bound to beat.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwatch.llm.leaks import words_of
from fleetwatch.llm.support import pieces, stored

K = 50
#: Pairs of item and term searched in one pass; more items take further passes.
PASS_TERMS = 200_000
#: Postings, or documents, that a task holds at once.
BLOCK_POSTINGS, BLOCK_DOCS = 500_000, 50_000
_N, _L = -1, -2  # stand for the number of documents and of their terms in the table of counts
_SALTS = 64


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """item (as text), term: the distinct terms of each item; texts of one id are one item, null or wordless ones none."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [(name, term) for name, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for term in set(words_of(t))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["item", "term"])

    narrow = items.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("body"))
    return narrow.mapInArrow(split, "item string, term binary").distinct()


def item_passes(terms: DataFrame, pass_terms: int = PASS_TERMS) -> Iterator[dict]:
    """{item: its terms} for one pass after the other, of about pass_terms pairs each; an item is never split."""
    n = max(1, -(-terms.count() // pass_terms))
    for k in range(n):
        part = terms if n == 1 else terms.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        found: dict = {}
        for row in part.toLocalIterator():
            found.setdefault(row["item"], []).append(bytes(row["term"]))
        if found:
            yield found


def occurrences(docs: DataFrame, vocabulary: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n (terms with repeats), terms (numbers in the vocabulary, ascending) and tfs of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: n for n, term in enumerate(shared.value)}
        for batch in pieces(batches):
            texts = [words_of(t) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(words) for words in texts], np.int64)
            ids = np.fromiter((number.get(w, -1) for w in chain.from_iterable(texts)), np.int64, int(sizes.sum()))
            place = np.repeat(np.arange(len(texts)) * len(number), sizes) + ids
            met, tfs = np.unique(place[ids >= 0], return_counts=True)
            edges = pa.array(np.searchsorted(met, np.arange(len(texts) + 1) * len(number)), pa.int32())
            lists = [pa.ListArray.from_arrays(edges, pa.array(values, pa.int32())) for values in (met % len(number), tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), *lists], names=["key", "n", "terms", "tfs"])

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    return narrow.mapInArrow(find, "key long, n long, terms array<int>, tfs array<int>")


def collection_counts(found: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each term of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_terms, total, df = 0, 0, np.zeros(n_terms, np.int64)
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            with_terms, total = with_terms + int((sizes > 0).sum()), total + int(sizes.sum())
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([_N, _L, *held], pa.int64()), pa.array([with_terms, total, *df[held]], pa.int64())], names=["term", "n"])

    counts = found.select("n", "terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df, whole = np.zeros(n_terms, np.int64), {_N: 0, _L: 0}
    for row in counts.toLocalIterator():
        if row["term"] < 0:
            whole[row["term"]] = row["n"]
        else:
            df[row["term"]] = row["n"]
    return whole[_N], whole[_L], df


class Postings:
    """The postings of a block of documents: for each term the documents and what each adds to a score, and the most."""

    def __init__(self, lists: list[tuple], weights: np.ndarray, n_docs: int, n_terms: int):
        self.keys = np.concatenate([x[0] for x in lists])
        self.nameless = np.concatenate([x[1] for x in lists])
        sizes, held = (np.concatenate([x[k] for x in lists]) for k in (2, 3))
        terms, tfs = (np.concatenate([x[k] for x in lists]).astype(np.int64) for k in (4, 5))
        m = 50 + (50 * sizes * n_docs) // max(n_terms, 1)
        docs = np.repeat(np.arange(len(sizes)), held)
        order = np.argsort(terms, kind="stable")
        terms, tfs, self.docs = terms[order], tfs[order], docs[order]
        self.adds = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[self.docs]))
        self.edges = np.searchsorted(terms, np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        used = np.flatnonzero(np.diff(self.edges))
        if len(used):
            self.most[used] = np.maximum.reduceat(self.adds, self.edges[used])
        self.sums = np.zeros(len(sizes), np.int64)

    def best(self, terms: np.ndarray, k: int, floor: int) -> np.ndarray:
        """Documents that may be among an item's k best, with exact scores in `sums`, if a score must reach floor.

        terms go from rare to frequent.
        """
        sums = self.sums
        sums[:] = 0
        terms = terms[self.most[terms] > 0]
        remaining = np.cumsum(self.most[terms][::-1])[::-1]
        create = True
        for term, bound in zip(terms, remaining, strict=True):
            docs, adds = (x[self.edges[term] : self.edges[term + 1]] for x in (self.docs, self.adds))
            create = create and bound >= floor
            if create and bound < sums.max():
                create = bound >= _kth(sums, k)
            if not create:
                met = sums[docs] > 0
                docs, adds = docs[met], adds[met]
            sums[docs] += adds
        return np.flatnonzero(sums >= max(floor, _kth(sums, k), 1))


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0


class _Best:
    """The k best (score, key) so far: highest scores, ties to smaller keys, null keys last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.keys, self.nameless = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, keys: np.ndarray, nameless: np.ndarray) -> None:
        mine = [np.concatenate(x) for x in ((self.scores, scores), (self.keys, keys), (self.nameless, nameless))]
        order = np.lexsort((mine[1], mine[2], -mine[0]))[: self.k]
        self.scores, self.keys, self.nameless = (x[order] for x in mine)


def _blocks(batches: Iterator[pa.RecordBatch], postings: int, docs: int) -> Iterator[list[tuple]]:
    held, n_postings, n_docs = [], 0, 0
    for batch in batches:
        key, terms, tfs = batch.column(0), batch.column(2), batch.column(3)
        held.append(
            (
                key.fill_null(0).to_numpy(zero_copy_only=False),
                key.is_null().to_numpy(zero_copy_only=False),
                batch.column(1).to_numpy(),
                np.diff(terms.offsets.to_numpy()),
                terms.flatten().to_numpy(),
                tfs.flatten().to_numpy(),
            )
        )
        n_postings, n_docs = n_postings + len(held[-1][4]), n_docs + batch.num_rows
        if n_postings >= postings or n_docs >= docs:
            yield held
            held, n_postings, n_docs = [], 0, 0
    if held:
        yield held


def _search(found: DataFrame, items: dict, vocabulary: list[bytes], k: int, block: tuple[int, int]) -> DataFrame:
    """item, key, score: of each task the k best documents of each item."""
    n_docs, n_terms, df = collection_counts(found, len(vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    number = {term: n for n, term in enumerate(vocabulary)}
    wanted = {name: np.array(sorted((number[t] for t in terms), key=lambda n: (df[n], n)), np.int64) for name, terms in items.items()}
    shared = found.sparkSession.sparkContext.broadcast((wanted, weights, n_docs, n_terms))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weights, n_docs, n_terms = shared.value
        best = {name: _Best(k) for name in wanted}
        for lists in _blocks(batches, *block):
            postings = Postings(lists, weights, n_docs, n_terms)
            for name, terms in wanted.items():
                at = postings.best(terms, k, best[name].floor)
                best[name].add(postings.sums[at], postings.keys[at], postings.nameless[at])
        for name, top in best.items():
            n = len(top.keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.string()), pa.array(top.keys, pa.int64(), mask=top.nameless), pa.array(top.scores)], names=["item", "key", "score"]
            )

    return found.mapInArrow(search, "item string, key long, score long")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    pass_terms: int = PASS_TERMS,
    block: tuple[int, int] = (BLOCK_POSTINGS, BLOCK_DOCS),
) -> DataFrame:
    """item (as text), rank from 1, key, score: each item's k documents of highest score above 0.

    Ties go to the smaller key, null keys last; a document row that repeats ranks as often as it stands there. Null and
    empty texts hold no term and count nowhere; texts of one item id (null is an id too) are one item; items without
    terms, or whose terms no document holds, give no row, as do empty tables. Items are searched in passes over the
    documents, each with a bounded table of terms, and what a pass found is stored before the next begins. A task emits
    k rows per item, which are cut to k in two steps, so that no task meets all of them.
    """
    passes = []
    for wanted in item_passes(item_terms(items, item, item_text), pass_terms):
        vocabulary = sorted({term for terms in wanted.values() for term in terms})
        found = stored(occurrences(docs, vocabulary, key, text), "occurrences")
        passes.append(stored(_search(found, wanted, vocabulary, k, block), "ranked"))
    best = docs.sparkSession.createDataFrame([], "item string, key long, score long")
    for part in passes:
        best = best.unionByName(part)
    place = [F.desc("score"), F.col("key").asc_nulls_last()]
    best = best.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(_SALTS)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*place))).where(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*place))).where(F.col("rank") <= k)
    return best.select("item", "rank", "key", "score")
