"""Documents whose sets of word shingles are similar, and the components their links form.

Equal sets are one class. The join runs over classes and over components of links already confirmed:

1.  Classes that agree in two of four min-hashes are compared with the most central class of their group, which
    confirms most links of a group of near copies with one comparison each.
2.  Shingles are put in one order: rare ones by hash, then frequent ones, those that many of one in COUNTED classes hold
    and more than one component. Two sets of Jaccard similarity t share at least 2 shingles of their prefixes of
    size - ceil(t * size) + 2 shingles. If one of the shared ones is rare, it is an index key by itself; if all are
    frequent, a pair of them is a key. A set with very many frequent shingles in its prefix would have too many pairs;
    it is matched by single frequent shingles with every set that has one in its prefix.
3.  Components that share a key are candidates if sizes, and what is left of both sets after the key, allow it: the
    first shingle, or frequent pair, that two similar sets share passes this test. All members of candidates are
    compared by exact intersection, in blocks.

Which shingles count as frequent changes the work, never the result. Sets travel as sorted 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.components import components
from fleetwatch.llm.support import partitions, pieces, stored, utf8, word_hashes, word_places

SHINGLE = 5
#: Similar if 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A shingle counts as frequent from about this many classes on, judged by one in COUNTED of all classes.
FREQUENT = 64
COUNTED = 8
#: Frequent shingles that the driver and each worker hold at most; the number above is doubled until no more are left.
LISTED = 2_000_000
#: A prefix with more frequent shingles is not paired up.
PAIRED = 48
#: Shingles counted or postings gathered at once by a task.
CHUNK = 3_000_000
#: Pairs of postings judged at once.
PAIRS = 1 << 18
#: Bytes of texts whose shingles are hashed at once.
TOGETHER = 1 << 16
#: Bits of the filter that says which classes are wanted; a false yes costs work only.
FILTER_BITS = 27
#: Members of a component, and partners, in one comparison block.
BLOCK = 2000

#: The first SHINGLE ones weigh the words of a shingle.
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
#: n is the size of a set, rest what is left of it from the key's place in the prefix on; LARGE and above are LARGE.
LARGE = 65_535
_POST = np.dtype([("key", "<u8"), ("comp", "<i8"), ("n", "<u2"), ("rest", "<u2")])
_RANGE = np.dtype([("key", "<u8"), ("low", "<i8"), ("high", "<i8")])
_COUNT = np.dtype([("key", "<u8"), ("tag", "<u4")])
_PAIR = np.dtype([("a", "<i8"), ("b", "<i8")])
_DENSE = np.dtype([("key", "<u8"), ("comp", "<i8"), ("n", "<u2"), ("rest", "<u2"), ("dense", "<u2")])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[4]
    return x ^ (x >> np.uint64(32))


def _sets_of(raws: list[bytes], size: int) -> list[np.ndarray]:
    whole = b" ".join(raws)
    places = word_places(whole)
    each = word_hashes(whole, places)
    first = np.searchsorted(places[0], np.cumsum([0, *(len(raw) + 1 for raw in raws)])).tolist()
    windows = max(0, len(each) - size + 1)
    total = np.zeros(windows, np.uint64)
    for k in range(size):
        total += each[k : k + windows] * _ODD[k]
    total = _mix(total)
    found = []
    for raw, a, b in zip(raws, first, first[1:], strict=False):
        if b - a < size:
            found.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(raw.split()))] if b > a else [], np.uint64))
            continue
        mine = np.sort(total[a : b - size + 1])
        new = mine[1:] != mine[:-1]
        found.append(mine if new.all() else mine[np.r_[True, new]])
    return found


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text; one of fewer words is one shingle, one without words has none."""
    held, n = [], 0
    for text in texts:
        raw = utf8(text).lower()
        if held and n + len(raw) > TOGETHER:
            yield from _sets_of(held, size)
            held, n = [], 0
        held.append(raw)
        n += len(raw)
    if held:
        yield from _sets_of(held, size)


def outline(shingles: np.ndarray) -> bytes | None:
    """How many hashes lie in each of 2 ** k equal ranges, 4 to 8 on average; None if a count does not fit a byte."""
    k = max(2, math.ceil(math.log2(max(len(shingles), 1) / 8)))
    count = np.bincount((shingles >> np.uint64(64 - k)).astype(np.int64), minlength=1 << k)
    return count.astype(np.uint8).tobytes() if count.max() < 256 else None


def _coarser(count: np.ndarray, size: int) -> np.ndarray:
    return count.reshape(size, -1).sum(axis=1) if len(count) > size else count


def _may_be_similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose outlines allow enough shared shingles; a pair without both outlines stays."""
    for batch in batches:
        a, b, na, nb, left, right = (c.to_pylist() for c in batch.columns)
        keep = np.ones(len(a), bool)
        for i in range(len(a)):
            if left[i] and right[i]:
                x, y = (np.frombuffer(side[i], np.uint8).astype(np.int64) for side in (left, right))
                size = min(len(x), len(y))
                most = int(np.minimum(_coarser(x, size), _coarser(y, size)).sum())
                keep[i] = (100 + PERCENT) * most >= PERCENT * (na[i] + nb[i])
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])


def possible(pairs: DataFrame, outlines: DataFrame) -> DataFrame:
    """The pairs a, b that sizes and outlines (comp, n, outline) allow; a pair without outlines stays."""
    for side in ("a", "b"):
        pairs = pairs.join(outlines.select(F.col("comp").alias(side), F.col("n").alias(f"n_{side}"), F.col("outline").alias(f"outline_{side}")), side, "left")
    return pairs.select("a", "b", "n_a", "n_b", "outline_a", "outline_b").mapInArrow(_may_be_similar, "a long, b long")


class _Cover:
    """Smallest size and largest counts of the members of a component."""

    def __init__(self):
        self.n, self.count, self.known = 1 << 62, None, True

    def add(self, n: int, count: bytes | None) -> None:
        self.n = min(self.n, n)
        if count is None:
            self.known = False
        else:
            new = np.frombuffer(count, np.uint8).astype(np.int64)
            old = new if self.count is None else self.count
            size = min(len(old), len(new))
            self.count = np.maximum(_coarser(old, size), _coarser(new, size))

    def row(self) -> tuple[int, bytes | None]:
        fits = self.known and self.count is not None and self.count.max(initial=0) < 256
        return self.n, self.count.astype(np.uint8).tobytes() if fits else None


def cover(rows: DataFrame) -> DataFrame:
    """One outline for each component (comp, n, outline of its members) that no member exceeds; combined in each task first."""

    def table(covers: dict[int, _Cover]) -> dict[str, pa.Array]:
        found = [(comp, *c.row()) for comp, c in covers.items()]
        return {"comp": pa.array([f[0] for f in found], pa.int64()), "n": pa.array([f[1] for f in found], pa.int64()), "outline": pa.array([f[2] for f in found], pa.binary())}

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        covers: dict[int, _Cover] = {}
        for batch in batches:
            for comp, n, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                covers.setdefault(comp, _Cover()).add(n, count)
            if len(covers) > 20_000:
                yield pa.RecordBatch.from_pydict(table(covers))
                covers = {}
        yield pa.RecordBatch.from_pydict(table(covers))

    def merge(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        whole = _Cover()
        for n, count in zip(found["n"].to_pylist(), found["outline"].to_pylist(), strict=True):
            whole.add(n, count)
        return pa.table(table({key[0].as_py(): whole}))

    schema = "comp long, n long, outline binary"
    return rows.select("comp", "n", "outline").mapInArrow(here, schema).groupBy("comp").applyInArrow(merge, schema)


def class_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def sketch(shingles: np.ndarray) -> list[int]:
    """One key for each pair of four min-hashes."""
    least = [int(_mix(shingles * _ODD[k] + _ODD[4]).min()) for k in range(4)]
    return [xxhash.xxh3_64_intdigest(f"{i},{j},{least[i]},{least[j]}") - (1 << 63) for i in range(4) for j in range(i)]


def _dealt(rows: np.ndarray, n_buckets: int) -> Iterator[tuple[int, bytes]]:
    """Rows by bucket of their key."""
    bucket = (_mix(rows["key"]) % np.uint64(n_buckets)).astype(np.min_scalar_type(n_buckets))  # few bits sort fastest
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(rows) else []
    for a, b in zip(starts, [*starts[1:], len(rows)], strict=False):
        yield int(bucket[a]), rows[a:b].tobytes()


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def _blobs(kind: int, rows: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    found = list(_dealt(rows, n_buckets))
    return _batch({"kind": ([kind] * len(found), pa.int32()), "bucket": ([b for b, _ in found], pa.int32()), "blob": ([x for _, x in found], pa.binary())})


class Filter:
    """Which hashed class ids are wanted, as bits."""

    def __init__(self, segments: dict[int, bytes]):
        self.bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for at, part in segments.items():
            self.bits[at << 17 : (at + 1) << 17] = np.frombuffer(part, np.uint8)

    def __contains__(self, cls: int) -> bool:
        slot = _slot(cls)
        return bool(self.bits[slot >> 3] >> (slot & 7) & 1)


def _slot(cls: int) -> int:
    return (cls * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - FILTER_BITS)


def make_filter(classes: DataFrame, name: str) -> Filter:
    """The filter of the column `name`; the driver gets its segments, 2 ** FILTER_BITS bits in all."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_slot(c) for c in batch.column(0).to_pylist()]
            yield _batch({"segment": ([v >> 20 for v in values], pa.int32()), "slot": ([v & (1 << 20) - 1 for v in values], pa.int32())})

    def segment(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << 20, np.uint8)
        bits[table["slot"].to_numpy()] = 1
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    marked = classes.select(name).mapInArrow(slots, "segment int, slot int").distinct()
    return Filter({r["segment"]: r["bits"] for r in marked.groupBy("segment").applyInArrow(segment, "segment int, bits binary").toLocalIterator()})


_SIGNED = "kind int, key long, same long, cls long, n long, keys array<bigint>, outline binary, bucket int, blob binary"


def _sign(n_buckets: int):
    """One row per document with its class, and the shingles of one in COUNTED classes, by bucket."""
    types = {"kind": pa.int32(), "key": pa.int64(), "same": pa.int64(), "cls": pa.int64(), "n": pa.int64(), "keys": pa.list_(pa.int64()), "outline": pa.binary(), "bucket": pa.int32(), "blob": pa.binary()}

    def rows(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in found], t) for c, t in types.items()], names=list(types))

    def counted(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        out = np.empty(sum(map(len, held.values())), _COUNT)
        out["key"] = np.concatenate(list(held.values()))
        out["tag"] = np.repeat([cls // COUNTED & (1 << 32) - 1 for cls in held], [len(s) for s in held.values()])
        return rows([{"kind": 1, "bucket": b, "blob": x} for b, x in _dealt(out, n_buckets)])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in pieces(batches):
            found = []
            keys, sames, texts = (c.to_pylist() for c in batch.columns)
            for key, same, shingles in zip(keys, sames, shingle_sets(texts), strict=True):
                row = {"kind": 0, "key": key, "same": same, "n": len(shingles)}
                if len(shingles):
                    row["cls"] = class_id(shingles)
                    row["keys"] = sketch(shingles)
                    row["outline"] = outline(shingles)
                    if row["cls"] % COUNTED == 0 and row["cls"] not in held:
                        held[row["cls"]] = shingles
                        size += len(shingles)
                found.append(row)
            yield rows(found)
            if size > CHUNK:
                yield counted(held)
                held, size = {}, 0
        if held:
            yield counted(held)

    return sign


def _frequent(counted: DataFrame) -> np.ndarray:
    """Shingles of about FREQUENT classes or more, or of twice as many and so on if that leaves more than LISTED.

    counted has the shingles of one in COUNTED classes, tagged so that a class counts once however many tasks saw it. So
    neither the number of tasks nor that of copies matters.
    """
    least = max(2, FREQUENT // COUNTED)

    def levels(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, n = np.unique(_distinct(np.frombuffer(b"".join(table["blob"].to_pylist()), _COUNT))["key"], return_counts=True)
        keys, n = keys[n >= least], n[n >= least]
        level = np.log2(n / least).astype(np.int64)
        each = [(int(x), keys[level == x]) for x in np.unique(level)]
        return pa.table({"level": pa.array([x for x, _ in each], pa.int32()), "n": pa.array([len(k) for _, k in each], pa.int64()), "keys": pa.array([k.tobytes() for _, k in each], pa.binary())})

    found = stored(counted.groupBy("bucket").applyInArrow(levels, "level int, n long, keys binary"), "frequent")
    lowest, held = 0, 0
    for r in found.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():
        held += r["n"]
        if held > LISTED:
            lowest = r["level"] + 1
            break
    rows = found.where(F.col("level") >= lowest).select("keys").toLocalIterator()
    return np.sort(np.frombuffer(b"".join(r["keys"] for r in rows), np.uint64))


def _is_in(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


class _Ranges:
    """Smallest and largest component that holds each of the frequent shingles."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.low = np.full(len(known), np.iinfo(np.int64).max)
        self.high = np.full(len(known), np.iinfo(np.int64).min)

    def add(self, shingles: np.ndarray, comp: int) -> None:
        if not len(self.known):
            return
        at = np.searchsorted(self.known, shingles)
        at = at[self.known[np.minimum(at, len(self.known) - 1)] == shingles]
        self.low[at] = np.minimum(self.low[at], comp)
        self.high[at] = np.maximum(self.high[at], comp)

    def rows(self) -> np.ndarray:
        at = np.flatnonzero(self.low <= self.high)
        out = np.zeros(len(at), _RANGE)
        out["key"], out["low"], out["high"] = self.known[at], self.low[at], self.high[at]
        return out


_GATHERED = "kind int, cls long, n long, bucket int, blob binary"


def _gather(wanted, known, n_buckets: int):
    """Sets of wanted classes, and for all others the classes that hold each frequent shingle."""
    types = {"kind": pa.int32(), "cls": pa.int64(), "n": pa.int64(), "bucket": pa.int32(), "blob": pa.binary()}

    def rows(found):
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in found], t) for c, t in types.items()], names=list(types))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, ranges = set(), _Ranges(known.value) if known else None
        for batch in pieces(batches):
            found = []
            for shingles in shingle_sets(batch.column(0).to_pylist()):
                if not len(shingles) or (cls := class_id(shingles)) in seen:
                    continue
                seen.add(cls)
                if all(cls in w.value for w in wanted[:1]) and not any(cls in w.value for w in wanted[1:]):
                    found.append({"kind": 0, "cls": cls, "n": len(shingles), "blob": shingles.tobytes()})
                elif ranges:
                    ranges.add(shingles, cls)
            yield rows(found)
        if ranges:
            yield rows([{"kind": 1, "bucket": b, "blob": x} for b, x in _dealt(ranges.rows(), n_buckets)])

    return gather


def _prefix(shingles: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rare and frequent shingles of the prefix: rare ones first, each kind by hash."""
    n = len(shingles)
    length = n - -(-PERCENT * n // 100) + 2
    often = _is_in(shingles, common)
    rare, frequent = shingles[~often], shingles[often]
    return rare[:length], frequent[: max(0, length - len(rare))]


def _distinct(rows: np.ndarray) -> np.ndarray:
    """Rows of a structured array without repetition: only those that share their first field are sorted by all."""
    names = rows.dtype.names
    order = np.argsort(rows[names[0]])
    first = rows[names[0]][order]
    same = np.zeros(len(rows) + 1, bool)
    same[1:-1] = first[1:] == first[:-1]
    several = same[1:] | same[:-1]
    once, rows = rows[order[~several]], rows[order[several]]
    rows = rows[np.lexsort([rows[name] for name in names[::-1]])]
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for name in names:
        new[1:] |= rows[name][1:] != rows[name][:-1]
    return np.concatenate([once, rows[new]])


class _Postings:
    """Index entries of prefixes; repeated ones of a chunk only once, unless each component comes with one set only."""

    def __init__(self, common: np.ndarray, n_buckets: int, single: bool = False):
        self.common, self.n_buckets, self.single = common, n_buckets, single
        self.plain, self.dense, self.size = [], [], 0

    def add(self, shingles: np.ndarray, comp: int) -> None:
        n = len(shingles)
        rare, frequent = _prefix(shingles, self.common)
        dense = len(frequent) > PAIRED
        first = len(rare)  # if any frequent one is in the prefix, all rare ones are
        keys, rest = rare, n - np.arange(len(rare))
        if not dense and len(frequent) > 1:
            i, j = np.triu_indices(len(frequent), 1)
            keys = np.concatenate([rare, _mix(frequent[i] * _ODD[1] + _mix(frequent[j]))])
            rest = np.concatenate([rest, n - first - j + 1])  # the two shared ones, and all after the second
        rows = np.empty(len(keys), _POST)
        rows["key"], rows["comp"], rows["n"], rows["rest"] = keys, comp, min(n, LARGE), np.minimum(rest, LARGE)
        self.plain.append(rows)
        if len(frequent):
            rows = np.empty(len(frequent), _DENSE)
            rows["key"], rows["comp"], rows["n"], rows["dense"] = frequent, comp, min(n, LARGE), dense
            rows["rest"] = np.minimum(n - first - np.arange(len(frequent)), LARGE)
            self.dense.append(rows)
        self.size += len(keys) + len(frequent)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for kind, held in ((0, self.plain), (1, self.dense)):
            if held:
                rows = np.concatenate(held)
                yield _blobs(kind, rows if self.single else _distinct(rows), self.n_buckets)
        self.plain, self.dense, self.size = [], [], 0


_POSTED = "kind int, bucket int, blob binary"


def _post(wanted, common, n_buckets: int, from_sets: bool):
    """Postings of documents that the filter leaves out (each its own component), or of stored sets with components."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, out = set(), _Postings(common.value, n_buckets, not from_sets)
        for batch in pieces(batches):
            if from_sets:
                for blob, comp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out.add(np.frombuffer(blob, np.uint64), comp)
            else:
                for shingles in shingle_sets(batch.column(0).to_pylist()):
                    if len(shingles) and (cls := class_id(shingles)) not in seen and cls not in wanted.value:
                        seen.add(cls)
                        out.add(shingles, cls)
            if out.size > CHUNK:
                yield from out.flush()
        yield from out.flush()

    return post


def _similar_sizes(low, high, rest, i: slice | np.ndarray, j: slice | np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be similar if they share their first common shingle, or pair, where `rest` says."""
    least = 100 + PERCENT
    unknown = (high[i] >= LARGE) | (high[j] >= LARGE)
    return unknown | (100 * high[i] >= PERCENT * low[j]) & (100 * high[j] >= PERCENT * low[i]) & (least * np.minimum(rest[i], rest[j]) >= PERCENT * (low[i] + low[j]))


def _crossed(rows: np.ndarray) -> Iterator[np.ndarray]:
    """Pairs of different components that meet in a key and may be similar, the smaller one first; may repeat."""
    order = np.argsort(rows["key"])
    same = np.zeros(len(rows) + 1, bool)
    same[1:-1] = rows["key"][order[1:]] == rows["key"][order[:-1]]
    rows = rows[order[same[1:] | same[:-1]]]  # most keys are in one row only
    if not len(rows):
        return
    rows = rows[np.lexsort([rows["comp"], rows["key"]])]
    starts = np.flatnonzero(np.r_[True, (rows["key"][1:] != rows["key"][:-1]) | (rows["comp"][1:] != rows["comp"][:-1])])
    keys, comps = rows["key"][starts], rows["comp"][starts]
    low, high = np.minimum.reduceat(rows["n"], starts).astype(np.int64), np.maximum.reduceat(rows["n"], starts).astype(np.int64)
    rest = np.maximum.reduceat(rows["rest"], starts).astype(np.int64)
    dense = np.maximum.reduceat(rows["dense"], starts) if "dense" in rows.dtype.names else np.ones(len(starts), np.int64)
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[begin, len(keys)])
    end = np.repeat(begin + size, size)
    i, step = np.arange(len(keys)), 1
    while len(i := i[i + step < end[i]]):  # each row with the row `step` places on in its group
        for at in range(0, len(i), PAIRS):
            a = i[at : at + PAIRS]
            good = _similar_sizes(low, high, rest, a, a + step) & ((dense[a] | dense[a + step]) > 0)
            if good.any():
                a = a[good]
                pairs = np.empty(len(a), _PAIR)
                pairs["a"], pairs["b"] = comps[a], comps[a + step]
                yield pairs
        step += 1


def _meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Pairs of components that share a key and may be similar, each once per bucket, smaller component first."""
    kinds, blobs = table["kind"].to_numpy(), table["blob"].to_pylist()
    held, size = [np.zeros(0, _PAIR)], 0
    for kind, dtype in ((0, _POST), (1, _DENSE)):
        for found in _crossed(np.frombuffer(b"".join(x for k, x in zip(kinds, blobs, strict=True) if k == kind), dtype)):
            held.append(found)
            size += len(found)
            if size > CHUNK:
                held = [_distinct(np.concatenate(held))]
                size = 0
    pairs = _distinct(np.concatenate(held))
    return pa.table({"a": pa.array(pairs["a"]), "b": pa.array(pairs["b"])})


def _compare(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between sets of one component (left) and sets of its partners (right), as pairs of components."""
    sets = [np.frombuffer(x, np.uint64) for x in left["blob"].to_pylist()]
    size = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
    order = np.argsort(tokens, kind="stable")
    owner, tokens = np.repeat(np.arange(len(sets)), size)[order], tokens[order]
    linked = set()
    for other, blob in zip(right["other"].to_pylist(), right["blob"].to_pylist(), strict=True):
        if other in linked or not len(sets):
            continue
        mine = np.frombuffer(blob, np.uint64)
        low, high = np.searchsorted(tokens, mine, "left"), np.searchsorted(tokens, mine, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        both = np.bincount(owner[at], minlength=len(sets))
        if (100 * both >= PERCENT * (size + len(mine) - both)).any():
            linked.add(other)
    found = sorted(linked)
    return pa.table({"u": pa.array([key[0].as_py()] * len(found), pa.int64()), "v": pa.array(found, pa.int64())})


def _only(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield batch.filter(pa.array([c in wanted.value for c in batch.column(0).to_pylist()], pa.bool_()))

    return run


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links u, v among candidate pairs: pairs has comp and other; sets has comp, cls and blob of all their members.

    A pair is linked if any member of comp is similar to any of other. The other's sets travel to comp's; members and
    partners come in blocks of BLOCK, and only components with more of either are split.
    """
    wanted = sets.sparkSession.sparkContext.broadcast(make_filter(pairs, "comp"))
    members = sets.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rows"))
    partners = sets.select(F.col("comp").alias("other"), F.col("cls").alias("other_cls"), F.col("blob"))
    met = pairs.join(sets.select(F.col("comp").alias("other")), "other").groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("columns"))
    blocks = stored(met.join(members, "comp").where("rows > 1 OR columns > 1"), "blocks")
    n_rows, n_columns = F.coalesce("rows", F.lit(1)), F.coalesce("columns", F.lit(1))
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    deal = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    left = sets.select("comp", "cls", "blob").mapInArrow(_only(wanted), "comp long, cls long, blob binary")
    left = left.join(blocks, "comp", "left").select("comp", "blob", deal("cls", n_rows).alias("r"), spread(n_columns).alias("c"))
    right = pairs.join(partners, "other").join(blocks, "comp", "left")
    right = right.select("comp", "other", "blob", deal("other_cls", n_columns).alias("c"), spread(n_rows).alias("r"))
    return left.groupBy("comp", "r", "c").cogroup(right.groupBy("comp", "r", "c")).applyInArrow(_compare, "u long, v long")


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, same (hash of the text), n_shingles, cls (equal for equal sets) and component_id (smallest key reachable by links) of every row.

    Rows without words have an empty set, no class and their own key as component. Repeated rows are copies. A null key
    takes part, but is a component's id only if no row in it has a key. Other columns are not read.
    """
    spark = docs.sparkSession
    share, n_buckets = spark.sparkContext.broadcast, 2 * partitions(spark)
    body = F.col(text).cast("string")
    texts = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(body).alias("same"), body.alias("body"))
    signed = stored(texts.mapInArrow(_sign(n_buckets), _SIGNED), "signed")
    rows = signed.where("kind = 0").select("key", "same", "cls", "n", "keys", "outline")
    known = _frequent(signed.where("kind = 1").select("bucket", "blob"))

    classes = stored(rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("key").alias("least"), F.first("keys").alias("keys"), F.first("n").alias("n"), F.first("outline").alias("outline")), "classes")
    hints = classes.select("cls", F.explode("keys").alias("hint"))
    sizes = hints.groupBy("hint").agg(F.count("*").alias("size")).where("size > 1")
    centre = hints.join(sizes, "hint").groupBy("cls").agg(F.sum("size").alias("weight"))  # classes near the centre share the most
    grouped = stored(hints.join(sizes, "hint").join(centre, "cls"), "grouped")
    pivots = grouped.groupBy("hint").agg(F.max_by("cls", F.struct("weight", "cls")).alias("pivot"))
    stars = grouped.join(pivots, "hint").where("cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b")).distinct()
    own = classes.select(F.col("cls").alias("comp"), "n", "outline")
    stars = stored(possible(stars, own).select(F.col("a").alias("comp"), F.col("b").alias("other")), "stars")

    near = share(make_filter(stars.select(F.explode(F.array("comp", "other")).alias("cls")), "cls"))
    gathered = stored(texts.select("body").mapInArrow(_gather([near], share(known), n_buckets), _GATHERED), "gathered")
    sets = gathered.where("kind = 0").select("cls", "blob").dropDuplicates(["cls"])
    first = stored(components(confirmed(stars, sets.select(F.col("cls").alias("comp"), "cls", "blob"))), "first")
    mine = sets.join(first.withColumnRenamed("node", "cls"), "cls", "left").select(F.coalesce("root", "cls").alias("comp"), "cls", "blob")
    sets = stored(mine, "sets")

    common = share(_shared(gathered.where("kind = 1"), sets, share(known), n_buckets))
    posted = texts.select("body").mapInArrow(_post(near, common, n_buckets, False), _POSTED).union(sets.select("blob", "comp").mapInArrow(_post(None, common, n_buckets, True), _POSTED))
    pairs = stored(posted.groupBy("bucket").applyInArrow(_meet, "a long, b long").distinct(), "candidates")
    joined = own.withColumnRenamed("comp", "cls").join(first.withColumnRenamed("node", "cls"), "cls").select(F.col("root").alias("comp"), "n", "outline")
    single = own.join(first, F.col("comp") == F.col("node"), "left_anti")
    pairs = stored(possible(pairs, single.union(cover(joined))), "possible")
    asked = share(make_filter(pairs.select(F.explode(F.array("a", "b")).alias("cls")), "cls"))
    others = texts.select("body").mapInArrow(_gather([asked, near], None, n_buckets), _GATHERED).dropDuplicates(["cls"])
    some = sets.select("comp", "cls", "blob").mapInArrow(_only(asked), "comp long, cls long, blob binary")
    every = stored(some.union(others.select(F.col("cls").alias("comp"), "cls", "blob")), "every")
    members = every.groupBy("comp").agg(F.count("*").alias("n"))
    sized = pairs.join(members.select(F.col("comp").alias("a"), F.col("n").alias("n_a")), "a").join(members.select(F.col("comp").alias("b"), F.col("n").alias("n_b")), "b")
    more = F.col("n_a") >= F.col("n_b")  # the sets of the smaller component travel
    turned = stored(sized.select(F.when(more, F.col("a")).otherwise(F.col("b")).alias("comp"), F.when(more, F.col("b")).otherwise(F.col("a")).alias("other")), "turned")
    second = components(confirmed(turned, every)).select(F.col("node").alias("comp"), F.col("root").alias("whole"))

    roots = classes.select("cls", "least").join(first.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "least", F.coalesce("root", "cls").alias("comp"))
    roots = stored(roots.join(second, "comp", "left").select("cls", "least", F.coalesce("whole", "comp").alias("root")), "roots")
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(ids, "root").select("cls", "component_id")
    return rows.join(named, "cls", "left").select("key", "same", F.col("n").alias("n_shingles"), "cls", F.when(F.col("cls").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each component, that of the smallest key; documents without words all stay.

    Rows that repeat both key and text are one document. All columns, whatever their names, stay as they are.
    """
    found = similar_documents(docs, key, text)
    kept = found.where("cls IS NOT NULL").groupBy("component_id").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "same")).alias("x")).select("x.key", "x.same")
    kept = kept.union(found.where("cls IS NULL").select("key", "same")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text).cast("string")).alias("s"))
    rows = rows.join(kept, F.col("k").eqNullSafe(F.col("key")) & (F.col("s") == F.col("same")), "left_semi")
    return rows.dropDuplicates(["k", "s"]).select("row.*")


def _shared(ranges: DataFrame, sets: DataFrame, known, n_buckets: int) -> np.ndarray:
    """Those of the frequent shingles that more than one component holds."""

    def of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Ranges(known.value)
        for batch in pieces(batches):
            for blob, comp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.add(np.frombuffer(blob, np.uint64), comp)
        yield _blobs(1, found.rows(), n_buckets)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(table["blob"].to_pylist()), _RANGE)
        keys, at = np.unique(rows["key"], return_inverse=True)
        low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, at, rows["low"])
        np.maximum.at(high, at, rows["high"])
        return pa.table({"keys": pa.array([keys[low != high].tobytes()], pa.binary())})

    both = ranges.select("kind", "bucket", "blob").union(sets.select("blob", "comp").mapInArrow(of_sets, _POSTED))
    found = both.groupBy("bucket").applyInArrow(merge, "keys binary").toLocalIterator()
    return np.sort(np.frombuffer(b"".join(r["keys"] for r in found), np.uint64))
