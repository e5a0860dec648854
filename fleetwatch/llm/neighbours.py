"""Nearest neighbours by inner product from a permutation index.

Vectors are lengthened by one component so that all have the largest norm; then the largest inner product is also the
nearest direction, whatever the original norms. Pivots are vectors of a bounded sample and their opposites. A vector is
represented by its DEPTH nearest pivots in order, and posted with its rank into the inverted file of each of them. A
query adds up, over the files of its own pivots, what shared pivots take off the footrule distance: with absent pivots
at rank DEPTH, the distance is a constant less 2 * (DEPTH - max(rank in query, rank in vector)) for each shared pivot.
The vectors with the smallest distance are ranked again by their true inner product.

Index and queries come in blocks: Spark deals each pair of a block of vectors and a block of queries to a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.support import stored

#: Sample from which pivots come, pivots (each with its opposite), and pivots that represent a vector.
SAMPLE = 1024
PIVOTS = 128
DEPTH = 64
#: Share of a block's vectors that is ranked again, and the least number.
SHARE = 0.07
LEAST = 400
PACK, BLOCK, QUERIES = 256, 16_384, 16_384

_PACKED = "dim int, pack long, n int, n_asks int, norm double, ids binary, asks binary, vectors binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that take part, in packs of one dimension."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        by_size: dict[int, list] = {}
        for key, vector, ask in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if vector and None not in vector:
                by_size.setdefault(len(vector), []).append((key, vector, ask))
        for dim, rows in sorted(by_size.items()):
            x = np.array([r[1] for r in rows], np.float64)
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            ids, asks, x = np.array([r[0] for r in rows], np.int64)[good], np.array([r[2] for r in rows], np.uint8)[good], x[good]
            for at in range(0, len(x), PACK):
                v = x[at : at + PACK]
                row = {"dim": dim, "pack": part << 32 | seq, "n": len(v), "n_asks": int(asks[at : at + PACK].sum()), "norm": float(np.sqrt((v * v).sum(axis=1).max()))}
                row |= {"ids": ids[at : at + PACK].tobytes(), "asks": asks[at : at + PACK].tobytes(), "vectors": v.tobytes()}
                seq += 1
                yield pa.RecordBatch.from_pylist([row], schema=_ARROW)


_ARROW = pa.schema([("dim", pa.int32()), ("pack", pa.int64()), ("n", pa.int32()), ("n_asks", pa.int32()), ("norm", pa.float64()), ("ids", pa.binary()), ("asks", pa.binary()), ("vectors", pa.binary())])


def _unpack(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, row numbers, which rows are queries, vectors."""
    ids = np.frombuffer(b"".join(table["ids"].to_pylist()), np.int64)
    asks = np.frombuffer(b"".join(table["asks"].to_pylist()), np.uint8).astype(bool)
    rows = np.concatenate([(p << 8) + np.arange(n) for p, n in zip(table["pack"].to_pylist(), table["n"].to_pylist(), strict=True)] or [np.zeros(0, np.int64)])
    return ids, rows, asks, np.frombuffer(b"".join(table["vectors"].to_pylist())).reshape(-1, dim)


def lengthen(x: np.ndarray, norm: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1, keepdims=True), 0))])


def choose_pivots(sample: np.ndarray, norm: float) -> np.ndarray:
    """At most PIVOTS different directions of the sample, in its order."""
    if not len(sample):
        return sample
    x = lengthen(sample, norm)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    _, first = np.unique(np.round(x, 9), axis=0, return_index=True)
    return x[np.sort(first)[:PIVOTS]]


def permutation(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The DEPTH nearest pivots of each vector, nearest first; numbers from len(pivots) on are opposites."""
    near = x @ pivots.T
    near = np.hstack([near, -near])
    return np.argsort(-near, axis=1, kind="stable")[:, :DEPTH]


class InvertedFiles:
    """For each pivot the vectors it represents, and its ranks in their permutations."""

    def __init__(self, nearest: np.ndarray, n_pivots: int):
        self.n, self.depth = nearest.shape
        flat = nearest.ravel()
        order = np.argsort(flat, kind="stable")
        self.ids, self.ranks = order // self.depth, (order % self.depth).astype(np.int32)
        self.ends = np.searchsorted(flat[order], np.arange(n_pivots + 1))

    def closeness(self, nearest: np.ndarray) -> np.ndarray:
        """What the shared pivots take off half the footrule distance between a query and every vector."""
        out = np.zeros(self.n, np.int32)
        for rank, pivot in enumerate(nearest):
            a, b = self.ends[pivot], self.ends[pivot + 1]
            out[self.ids[a:b]] += self.depth - np.maximum(self.ranks[a:b], rank)
        return out


def search_block(vectors, rows, ids, asked, asked_rows, pivots, norm, k):
    """For each query the places and scores of its k nearest among the candidates of one block."""
    n = len(vectors)
    most = max(LEAST, int(np.ceil(SHARE * n)))
    files = None
    if len(pivots) and n > most:
        files = InvertedFiles(permutation(lengthen(vectors, norm), pivots), 2 * len(pivots))
        nearest = permutation(np.hstack([asked, np.zeros((len(asked), 1))]), pivots)
    for i, query in enumerate(asked):
        if files:
            near = files.closeness(nearest[i])
            cut = np.partition(near, n - most)[n - most]
            found = np.flatnonzero(near >= cut)  # with all that tie at the cut
        else:
            found = np.arange(n)
        found = found[rows[found] != asked_rows[i]]
        score = (vectors[found] * query).sum(axis=1)  # row by row, so equal vectors get equal scores
        top = np.lexsort((ids[found], -score))[:k]
        yield found[top], score[top]


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found for each row in which `queries` holds.

    Candidates are all other rows. Ties go to the smaller id. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows with a null id; vectors of different dimensions are never compared.
    Rows that repeat an id are rows of their own, as queries and as candidates. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).cast("int").alias("ask")).where("key IS NOT NULL")
    packs = stored(rows.mapInArrow(_pack, _PACKED), "vectors")
    sizes = {r["dim"]: r for r in packs.groupBy("dim").agg(F.sum("n").alias("n"), F.max("norm").alias("norm"), F.sum("n_asks").alias("asked")).collect()}
    sample: dict[int, list] = {}
    for r in rows.where("vector IS NOT NULL").orderBy(F.xxhash64("key"), "key").limit(SAMPLE).collect():
        if len(r["vector"]) in sizes and None not in r["vector"] and np.isfinite(r["vector"]).all() and any(r["vector"]):
            sample.setdefault(len(r["vector"]), []).append(r["vector"])
    fitted = {d: (choose_pivots(np.array(sample.get(d, np.zeros((0, d))), float), s["norm"]), s["norm"]) for d, s in sizes.items()}
    shared = spark.sparkContext.broadcast(fitted)  # PIVOTS vectors for each dimension in the sample
    blocks = max([1, *(-(-int(s["n"]) // BLOCK) for s in sizes.values())])
    groups = max([1, *(-(-int(s["asked"] or 0) // QUERIES) for s in sizes.values())])
    spread = lambda name, n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    deal = lambda name, n: F.pmod(F.xxhash64("pack"), F.lit(n)).cast("int").alias(name)
    fields = ["dim", "pack", "n", "ids", "asks", "vectors"]
    data = packs.select(*fields, deal("block", blocks), spread("group", groups))
    asked = packs.where("n_asks > 0").select(*fields, deal("group", groups), spread("block", blocks))

    def search(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        ids, at, _, x = _unpack(left, dim)
        query_ids, query_at, asks, q = _unpack(right, dim)
        query_ids, query_at, q = query_ids[asks], query_at[asks], q[asks]
        pivots, norm = shared.value[dim]
        out: list[list] = [[], [], [], []]
        for i, (place, score) in enumerate(search_block(x, at, ids, q, query_at, pivots, norm, k)):
            for column, value in zip(out, (query_at[i], query_ids[i], -score, ids[place]), strict=True):
                column.append(value)
        return pa.table(
            {
                "query_row": pa.array(out[0], pa.int64()),
                "query_id": pa.array(out[1], pa.int64()),
                "far": pa.array(out[2], pa.list_(pa.float64())),
                "near_ids": pa.array(out[3], pa.list_(pa.int64())),
            }
        )

    pairs = data.groupBy("dim", "block", "group").cogroup(asked.groupBy("dim", "block", "group"))
    found = pairs.applyInArrow(search, "query_row long, query_id long, far array<double>, near_ids array<bigint>")
    best = found.groupBy("query_row", "query_id").agg(F.flatten(F.collect_list(F.arrays_zip("far", "near_ids"))).alias("all"))
    top = best.select("query_id", F.posexplode(F.slice(F.array_sort("all"), 1, k)).alias("i", "x"))
    return top.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.near_ids").alias("vec_id"), (-F.col("x.far")).alias("score"))
