"""Documents packed into as few fixed-length sequences as bin completion finds.

Only lengths matter for packing, and there are at most as many as the capacity, so the plan is made on their histogram
(2048 counts, whatever the corpus) and holds fillings with the number of times each is used. Documents of a length are
interchangeable: each gets its rank among those of its length, and the plan turns (length, rank) into a sequence and an
offset. Ranks come from range partitions and their totals, so a length that holds a third of all rows is split.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwatch.llm.support import partitions, pieces, stored

#: A filling: ((length, copies), ...), longest first; a plan: (filling, times) pairs.
Filling = tuple[tuple[int, int], ...]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing uses fewer sequences: total length, and what cannot share with the long ones, for every split point."""
    best = -(-sum(n * k for n, k in counts.items()) // capacity)
    size = np.zeros(capacity + 1, np.int64)
    for n, k in counts.items():
        size[n] = k
    number, volume = np.cumsum(size), np.cumsum(size * np.arange(capacity + 1))
    half = capacity // 2
    for short in range(1, half + 1):  # items shorter than `short` are left out
        top = number[-1] - number[capacity - short]  # too long for any item considered
        middle = number[capacity - short] - number[half]
        room = middle * capacity - (volume[capacity - short] - volume[half])
        rest = volume[half] - volume[short - 1]
        best = max(best, int(top + middle + max(0, -(-(rest - room) // capacity))))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, in whole groups of sequences with the same content."""
    room: dict[int, Counter] = defaultdict(Counter)  # free length -> filling -> how many
    for n in sorted(counts, reverse=True):
        left = counts[n]
        for free in sorted(f for f in room if f >= n):
            fit = free // n
            for filling in sorted(room[free]):
                if not left:
                    break
                groups = [(fit, min(room[free][filling], left // fit))]
                if groups[0][1] < room[free][filling] and left - groups[0][1] * fit:
                    groups.append((left - groups[0][1] * fit, 1))
                for copies, times in groups:
                    if times:
                        room[free][filling] -= times
                        room[free - copies * n][(*filling, (n, copies))] += times
                        left -= copies * times
                if not room[free][filling]:
                    del room[free][filling]
            if not left:
                break
        fit = capacity // n
        if left // fit:
            room[capacity - fit * n][((n, fit),)] += left // fit
        if left % fit:
            room[capacity - left % fit * n][((n, left % fit),)] += 1
    return [(filling, times) for group in room.values() for filling, times in group.items() if times]


class Sums:
    """Sums that the shortest lengths can reach, as bits, kept from one use to the next as far as counts stay the same."""

    def __init__(self, capacity: int):
        self.capacity, self.whole = capacity, (1 << (capacity + 1)) - 1
        self.have, self.usable = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.reach = [1]  # reach[i]: sums of the i shortest lengths

    def of(self, count: np.ndarray, room: int) -> tuple[np.ndarray, list[int]]:
        """The lengths up to room, and what they reach."""
        have = np.flatnonzero(count[: room + 1])
        usable = np.minimum(count[have], self.capacity // np.maximum(have, 1))
        n = min(len(have), len(self.have))
        other = np.flatnonzero((have[:n] != self.have[:n]) | (usable[:n] != self.usable[:n]))
        same = int(other[0]) if len(other) else n
        if same < len(have):
            self.have, self.usable, self.reach = have, usable, self.reach[: same + 1]
            for length, many in zip(have[same:].tolist(), usable[same:].tolist(), strict=True):
                sums, k = self.reach[-1], 1
                while many:
                    k = min(k, many)
                    sums |= sums << length * k & self.whole
                    many, k = many - k, 2 * k
                self.reach.append(sums)
        return have, self.reach


def completions(count: np.ndarray, room: int, steps: list[int], sums: Sums | None = None) -> Iterator[tuple[Filling, int]]:
    """(filling, waste) of `room`, of any number of lengths: least waste first, then longest first, made as they are asked for.

    Sums that the shorter lengths can reach guide the recursion, so it meets no dead end for want of a fitting rest. Left
    out is what a swap dominates: a free length that takes the place of one or two members, or of none, within the waste.
    The number of recursion steps is taken off steps[0]; at 0 no more are made.
    """
    lengths, reach = (sums or Sums(room)).of(count, room)
    have = lengths.tolist()
    copies = dict(zip(have, count[lengths].tolist(), strict=True))

    def fill(i: int, target: int, waste: int, chosen: Filling, free: int) -> Iterator[Filling]:
        if not target:
            if not free >> 1 & ((1 << waste) - 1):
                yield chosen
            return
        window = (1 << (waste + 1)) - 1
        for j in range(min(i, bisect_right(have, target)), 0, -1):
            if not reach[j] >> target & 1:
                return
            n = have[j - 1]
            for c in range(min(copies[n], target // n), 0, -1):
                if not reach[j - 1] >> target - c * n & 1:
                    continue
                if steps[0] <= 0:
                    return
                steps[0] -= 1
                left = free & ~(1 << n) if c == copies[n] else free
                if left >> n + 1 & window >> 1 or any(left >> m + n & window for m, _ in chosen) or (c > 1 and left >> 2 * n & window):
                    continue
                yield from fill(j - 1, target - c * n, waste, (*chosen, (n, c)), left)

    free = sum(1 << n for n in have)
    for waste in range(room + 1):
        if reach[len(have)] >> room - waste & 1:
            for filling in fill(len(have), room - waste, waste, (), free):
                yield filling, waste


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = 6000, steps: int = 300_000, depth: int = 64) -> list[tuple[Filling, int]]:
    """Branch and bound over completions of the longest remaining document; the best-fit plan is the first incumbent.

    A node applies one completion as often as the counts allow, then also half, a quarter, ... as often, down to once. A
    branch ends when its sequences so far and the total of what is left reach the incumbent, that is, when its waste is
    no longer affordable. The search ends at the lower bound, after `nodes` nodes or after `steps` steps of completions,
    and turns back over the last `depth` open nodes at most; these bound time and memory, not the rows.
    """
    best = best_fit(counts, capacity)
    best_n, bound = sum(t for _, t in best), lower_bound(counts, capacity)
    count = np.zeros(capacity + 1, np.int64)
    for n, k in counts.items():
        count[n] = k
    left = sum(n * k for n, k in counts.items())
    path: list[tuple[Filling, int]] = []
    choices: list[Iterator] = []
    used = spent = 0
    budget, sums = [steps], Sums(capacity)

    def branch():
        longest = int(np.flatnonzero(count)[-1])
        count[longest] -= 1
        rest = count.copy()
        count[longest] += 1
        again: list[tuple[Counter, int]] = []
        for filling, waste in completions(rest, capacity - longest, budget, sums):
            if used + 1 + -(-(left - capacity + waste) // capacity) >= best_n:
                break  # nor is any greater waste affordable
            members = Counter(dict(filling))
            members[longest] += 1
            fewer = [(m, t // 2) for m, t in again if t > 1]
            again = [*fewer, (members, min(int(count[n]) // c for n, c in members.items()))]
            yield from reversed(again)
        while again := [(m, t // 2) for m, t in again if t > 1]:
            yield from reversed(again)

    if left and best_n > bound:
        choices.append(branch())
    while choices and best_n > bound and spent < nodes:
        filling, times = next(choices[-1], (None, 0))
        if filling is None:
            choices.pop()
            if path:
                done, times = path.pop()
                for n, c in done:
                    count[n] += c * times
                    left += n * c * times
                used -= times
            continue
        spent += 1
        size = sum(n * c for n, c in filling.items()) * times
        if used + times + -(-(left - size) // capacity) >= best_n:
            continue
        for n, c in filling.items():
            count[n] -= c * times
        used, left = used + times, left - size
        path.append((tuple(sorted(filling.items(), reverse=True)), times))
        if left:
            choices.append(branch())
            if len(choices) > depth:  # what an open node holds is given up; the nodes below it stay as they are
                choices[-depth - 1] = iter(())
        else:
            best, best_n = list(path), used
            choices.append(iter(()))
    return best


def _cut(encode, end_id: int, capacity: int):
    tail = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encode()
        for batch in pieces(batches):
            out: list[list] = [[], [], [], [], []]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = run(text) + tail
                total, start, piece = len(ids) // 4, 0, 0
                while start < total:
                    size = (total - start) % capacity or capacity
                    values = (key, piece, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]))
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    start, piece = start + size, piece + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["key", "piece", "start", "length", "ids_crc32"])

    return cut


def cut_documents(docs: DataFrame, encode, key: str = "doc_id", text: str = "text", end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Pieces of at most `capacity` ids: key, piece, start, length, ids_crc32. The first piece takes the remainder.

    A null or empty text is its end id alone. Repeated rows give pieces of their own; other columns are not read.
    """
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    return narrow.mapInArrow(_cut(encode, end_id, capacity), "key long, piece int, start long, length long, ids_crc32 long")


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the range's number and a row's place among the rows of its length in that range; rows come by length."""
    part, last, seen = TaskContext.get().partitionId(), -1, 0
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        n = len(length)
        if not n:
            continue
        starts = np.flatnonzero(np.r_[True, length[1:] != length[:-1]])
        place = np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))
        if length[0] == last:
            place[: starts[1] if len(starts) > 1 else n] += seen
        last, seen = length[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(place)], names=[*batch.schema.names, "part", "place"])


class _Plan:
    """The plan as sorted arrays, to look up (length, rank) by binary search."""

    def __init__(self, plan: list[tuple[Filling, int]], first: int = 0):
        taken: Counter = Counter()
        rows = []
        for filling, times in plan:
            offset = 0
            for n, copies in filling:
                rows.append((n, taken[n], copies, first, offset))
                taken[n] += copies * times
                offset += n * copies
            first += times
        rows.sort()
        self.length, self.rank, self.copies, self.sequence, self.offset = np.array(rows, np.int64).reshape(-1, 5).T
        self.keys = (self.length << 48) + self.rank

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, (length << 48) + rank, side="right") - 1
        nth = rank - self.rank[at]
        return self.sequence[at] + nth // self.copies[at], self.offset[at] + nth % self.copies[at] * length


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """cut has a long column `length` (1 to capacity) and others not named part, place, base; adds sequence_id and offset.

    Rows of one sequence have offsets without gaps from 0. An empty table gives no rows. The pieces are stored, then
    numbered in ranges by length and stored again; the driver sees one count per length.
    """
    spark = cut.sparkSession
    kept = stored(cut, "pieces")
    counts = {r["length"]: r["count"] for r in kept.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(_Plan(bin_completion(counts, capacity)))
    order = ["length", *[c for c in kept.columns if c != "length"]]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    ranged = kept.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ranked = stored(ranged.mapInArrow(_rank, f"{fields}, part int, place long"), "ranked")
    totals = ranked.groupBy("part", "length").agg(F.count("*").alias("n"))  # ranges + lengths rows at most
    line = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", "length", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("base"))
    rows = ranked.join(F.broadcast(bases), ["part", "length"])

    names = kept.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("place").to_numpy(zero_copy_only=False) + batch.column("base").to_numpy(zero_copy_only=False)
            sequence, offset = plan.value.place(length, rank)
            keep = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return rows.mapInArrow(place, f"{fields}, sequence_id long, offset long")
