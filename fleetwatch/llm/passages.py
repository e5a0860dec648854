"""Passages that recur across documents, found by sharded Aho-Corasick automata, and the words they cover.

A window is WINDOW consecutive words. Every window has a phrase of PHRASE words that its own words single out (the
smallest hash of all its phrases), so equal windows have equal phrases wherever they stand.

1.  Phrases that several documents single out are routed: each gets a shard. Routes fit a table of fixed size.
2.  Windows around routed phrases are confirmed by hash: a window that occurs in several documents recurs, and the
    document with the smallest id owns it. Runs of windows that recur make an owner's passages.
3.  Each shard compiles the routed phrases of its passages into an automaton over words. Documents are streamed through
    the automata of the shards that their own phrases are routed to, each with the stretches that windows around those
    phrases can reach; around each occurrence, words are compared with the passage, and windows that are equal to
    windows of an owner with a smaller id are covered.

Documents without a routed phrase are finished in step 2. Shards that many documents are routed to are split; each part
has the shard's passages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.support import Powers, partitions, pieces, stored, utf8, word_places
from fleetwatch.llm.support import word_hashes as text_hashes

WINDOW = 50
PHRASE = 40
#: Slots of the route table, two bytes each; phrases that share a slot share a shard, which costs work only.
ROUTE_BITS = 24
#: Bytes of text that one part of a shard streams.
PART_BYTES = 32_000_000
CHUNK = 2_000_000

_SPAN = WINDOW - PHRASE + 1  # phrases in a window
_ENTRY = np.dtype([("hash", "<u8"), ("low", "<i8"), ("high", "<i8")])
_powers = Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return text_hashes(b" ".join(words))


def stretch_hashes(each: np.ndarray, size: int) -> np.ndarray:
    """Hash of every stretch of `size` words: sums of powers, shifted to the stretch's own start."""
    n = len(each) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(each))
    total = np.r_[np.uint64(0), np.cumsum(each * up)]
    return _mix((total[size:] - total[:n]) * down[:n])


def _sliding(x: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every `size` neighbours."""
    width, out = 1, x
    while 2 * width <= size:
        out = pick(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def singled_out(each: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all phrases, places of those singled out by some window, phrase hash of each window)."""
    phrases = stretch_hashes(each, PHRASE)
    if len(each) < WINDOW:
        return phrases, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _sliding(phrases, _SPAN, np.minimum)
    padded = np.r_[np.zeros(_SPAN - 1, np.uint64), least, np.zeros(_SPAN - 1, np.uint64)]
    return phrases, np.flatnonzero(_sliding(padded, _SPAN, np.maximum) == phrases), least


def regions(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The merged stretches of n words in which windows around phrases at these places lie."""
    begin, end = np.maximum(places - _SPAN + 1, 0), np.minimum(places + WINDOW, n)
    cut = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]]) if len(places) else np.zeros(0, np.int64)
    return list(zip(begin[cut].tolist(), end[np.r_[cut[1:] - 1, len(places) - 1]].tolist(), strict=True)) if len(places) else []


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - ROUTE_BITS)).astype(np.int64)


def _dealt(ends: np.ndarray, n_buckets: int) -> list[dict]:
    """Smallest and largest keys of hashes by bucket, a range of the hash; in order of the key, so that keys compress."""
    two = ends[ends["low"] != ends["high"]]
    hashes, keys = np.r_[ends["hash"], two["hash"]], np.r_[ends["low"], two["high"]]
    bucket = ((hashes >> np.uint64(40)).astype(np.int64) * n_buckets) >> 24
    order = np.lexsort((keys, bucket))
    hashes, keys, bucket = hashes[order], keys[order], bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    return [{"bucket": int(bucket[a]), "hashes": hashes[a:b].tobytes(), "keys": keys[a:b].tobytes()} for a, b in zip(starts, [*starts[1:], len(bucket)], strict=False)]


def _entries(table: pa.Table) -> np.ndarray:
    """Smallest and largest key of each hash in the rows of a bucket."""
    hashes, keys = (b"".join(table[c].to_pylist()) for c in ("hashes", "keys"))
    return _ends(np.frombuffer(hashes, "<u8"), np.frombuffer(keys, "<i8"))


def _ends(hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Smallest and largest key of each hash."""
    order = np.lexsort((keys, hashes))
    hashes, keys = hashes[order], keys[order]
    starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, np.int64)
    out = np.zeros(len(starts), _ENTRY)
    if len(starts):
        out["hash"], out["low"], out["high"] = hashes[starts], keys[starts], keys[np.r_[starts[1:], len(keys)] - 1]
    return out


_BLOBS = "bucket int, hashes binary, keys binary"
_BLOBS_ARROW = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("keys", pa.binary())])


def _collect(find, n_buckets: int):
    """Hashes that find(key, text) gives for each document, by bucket, combined in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys, size = [], [], 0

        def flush():
            return pa.RecordBatch.from_pylist(_dealt(_ends(np.concatenate(hashes), np.concatenate(keys)), n_buckets), schema=_BLOBS_ARROW)

        for batch in pieces(batches):
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key is not None:
                    hashes.append(find(text))
                    keys.append(np.full(len(hashes[-1]), key, np.int64))
                    size += len(hashes[-1])
            if size > CHUNK:
                yield flush()
                hashes, keys, size = [], [], 0
        if hashes:
            yield flush()

    return run


def _phrases(text: str | None) -> np.ndarray:
    phrases, at, _ = singled_out(text_hashes(utf8(text)))
    return np.unique(phrases[at])


def _windows(routes):
    """Windows around routed phrases."""

    def find(text: str | None) -> np.ndarray:
        each = text_hashes(utf8(text))
        return np.unique(stretch_hashes(each, WINDOW)[routes.value.find(singled_out(each)[2]) > 0])

    return find


class Routes:
    """One plus the shard of each routed phrase, zero for others: shards by slot, and a Bloom filter of the phrases.

    The filter has 2 ** (ROUTE_BITS + 4) bits; a false yes costs work only.
    """

    def __init__(self):
        self.shards = np.zeros(1 << ROUTE_BITS, np.uint16)
        self.bits = np.zeros(1 << (ROUTE_BITS + 1), np.uint8)

    @staticmethod
    def _places(hashes: np.ndarray) -> Iterator[np.ndarray]:
        mask = np.uint64((1 << (ROUTE_BITS + 4)) - 1)
        for k in range(3):
            yield ((_mix(hashes + np.uint64(k)) >> np.uint64(7)) & mask).astype(np.int64)

    def add(self, hashes: np.ndarray) -> None:
        for at in self._places(hashes):
            np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        found = self.shards[_slots(hashes)]
        maybe = np.flatnonzero(found)
        for at in self._places(hashes[maybe]):
            found[maybe[(self.bits[at >> 3] >> (at & 7) & 1) == 0]] = 0
        return found


def route_table(texts: DataFrame, n_buckets: int, n_shards: int) -> Routes:
    """One plus the shard of each slot with a phrase that several documents single out, zero for other slots.

    A slot's shard depends on the smallest document with such a phrase, so the phrases of copies go to the same shards.
    """

    def shared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ends = _entries(table)
        ends = ends[ends["low"] != ends["high"]]
        slots = _slots(ends["hash"])
        order = np.lexsort((ends["low"], slots))
        slots, low = slots[order], ends["low"][order]
        first = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]]) if len(slots) else np.zeros(0, np.int64)
        shards = (_mix(low[first].view(np.uint64)) % np.uint64(n_shards)).astype("<u2") + np.uint16(1)
        return pa.table({"slots": pa.array([slots[first].astype("<u4").tobytes()], pa.binary()), "shards": pa.array([shards.tobytes()], pa.binary()), "hashes": pa.array([ends["hash"].tobytes()], pa.binary())})

    found = texts.mapInArrow(_collect(_phrases, n_buckets), _BLOBS).groupBy("bucket").applyInArrow(shared, "slots binary, shards binary, hashes binary")
    routes = Routes()  # of fixed size; buckets come to the driver one by one
    for row in found.toLocalIterator():
        slots, shards = np.frombuffer(row["slots"], "<u4"), np.frombuffer(row["shards"], "<u2")
        free = routes.shards[slots] == 0  # only where two buckets meet in a slot
        routes.shards[slots[free]] = shards[free]
        routes.add(np.frombuffer(row["hashes"], "<u8"))
    return routes


def _kept(words: list[bytes], spans: list[int]) -> tuple[int, int, str]:
    """n_words, n_removed and the digest of what is left when spans (begin, end, ...) go."""
    if not spans:
        return len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest()
    keep = np.ones(len(words), bool)
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        keep[a:b] = False
    left = [words[i] for i in np.flatnonzero(keep)]
    return len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()


_SCANNED = "kind int, key long, body string, same long, parts array<struct<shard:int,at:int,words:binary>>, n_words long, n_removed long, kept_sha256 string, bucket int"
_TYPES = {"kind": pa.int32(), "key": pa.int64(), "body": pa.string(), "same": pa.int64()}
_TYPES |= {"parts": pa.list_(pa.struct([("shard", pa.int32()), ("at", pa.int32()), ("words", pa.binary())]))}
_TYPES |= {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "bucket": pa.int32()}


def _scan(routes, n_buckets: int):
    """Finished documents (kind 0), and documents with routed phrases (kind 1) by the group of their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = routes.value
        for batch in pieces(batches):
            found = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = utf8(text)
                begin, end = word_places(raw)
                phrases, at, _ = singled_out(text_hashes(raw, (begin, end)))
                to = table.find(phrases[at])
                if key is None or not to.any():
                    n, gone, digest = _kept(raw.split(), [])
                    found.append({"kind": 0, "key": key, "n_words": n, "n_removed": gone, "kept_sha256": digest})
                    continue
                same = xxhash.xxh3_64_intdigest(raw) - (1 << 63)
                group = int(_groups(np.array([key]), n_buckets)[0])
                parts = [{"shard": int(shard) - 1, "at": a, "words": raw[begin[a] : end[b - 1]]} for shard in np.unique(to[to > 0]) for a, b in regions(at[to == shard], len(begin))]
                found.append({"kind": 1, "key": key, "bucket": group, "body": text, "same": same, "parts": parts})
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in found], t) for c, t in _TYPES.items()], names=list(_TYPES))

    return run


def _groups(keys: np.ndarray, n_groups: int) -> np.ndarray:
    return (_mix(keys.astype(np.int64).view(np.uint64)) % np.uint64(n_groups)).astype(np.int64)


def _owned(n_groups: int):
    """Windows of a bucket that several documents have, with the smallest document, packed by that document's group."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ends = _entries(table)
        ends = ends[ends["low"] != ends["high"]]
        group = _groups(ends["low"], n_groups)
        order = np.lexsort((ends["low"], group))
        ends, group = ends[order], group[order]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(ends) else []
        cut = list(zip(starts, [*starts[1:], len(ends)], strict=False))
        return pa.Table.from_pylist([{"bucket": int(group[a]), "hashes": ends["hash"][a:b].tobytes(), "keys": ends["low"][a:b].tobytes()} for a, b in cut], schema=_BLOBS_ARROW)

    return run


def _cut_passages(routes):
    """Passages of the owners in a group: words of runs of windows that recur, once for each shard they have phrases in."""

    def run(key: tuple[pa.Scalar, ...], texts: pa.Table, blobs: pa.Table) -> pa.Table:
        hashes, owners = (np.frombuffer(b"".join(blobs[c].to_pylist()), t) for c, t in (("hashes", "<u8"), ("keys", "<i8")))
        order = np.argsort(owners, kind="stable")
        hashes, owners = hashes[order], owners[order]
        out: list[list] = [[], [], []]
        for owner, text in zip(texts["key"].to_pylist(), texts["body"].to_pylist(), strict=True):
            mine = hashes[np.searchsorted(owners, owner) : np.searchsorted(owners, owner, "right")]
            if not len(mine):
                continue
            raw = utf8(text)
            begin, end = word_places(raw)
            each = text_hashes(raw, (begin, end))
            edge = np.flatnonzero(np.diff(np.r_[False, np.isin(stretch_hashes(each, WINDOW), mine), False].astype(np.int8)))
            for a, b in zip(edge[::2], edge[1::2] + WINDOW - 1, strict=True):
                phrases, at, _ = singled_out(each[a:b])
                to = routes.value.find(phrases[at])
                for shard in np.unique(to[to > 0]):
                    for c, d in regions(at[to == shard], b - a):
                        for column, value in zip(out, (int(shard) - 1, owner, raw[begin[a + c] : end[a + d - 1]]), strict=True):
                            column.append(value)
        return pa.table({"shard": pa.array(out[0], pa.int32()), "key": pa.array(out[1], pa.int64()), "passage": pa.array(out[2], pa.binary())})

    return run


class PhraseAutomaton:
    """Aho-Corasick automaton over the words of a shard's phrases, and the owned windows around those phrases by hash."""

    def __init__(self, routes: Routes, shard: int):
        self.routes, self.mark = routes, shard + 1
        self.words: dict[bytes, int] = {}
        self.phrases: set[tuple] = set()
        self.passages: list[list[bytes]] = []
        self.windows: list[tuple] = []  # of each passage: hashes of windows around its phrases, owner, passage, their places
        self.automaton = None

    def add(self, owner: int, passage: bytes) -> None:
        words = passage.split()
        each = text_hashes(passage)
        phrases, at, _ = singled_out(each)
        at = at[self.routes.find(phrases[at]) == self.mark]
        number = self.words
        ids = tuple([number.setdefault(w, len(number) + 1) for w in words])
        self.phrases.update([ids[p : p + PHRASE] for p in at.tolist()])
        starts = _around(np.maximum(at - _SPAN + 1, 0), np.minimum(at, len(words) - WINDOW), len(words))
        self.windows.append((stretch_hashes(each, WINDOW)[starts], np.full(len(starts), owner), np.full(len(starts), len(self.passages)), starts))
        self.passages.append(words)

    def compile(self) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for phrase in self.phrases:
            self.automaton.add_word(phrase, 1)
        self.automaton.make_automaton()
        # The smallest owner of each window, in order of the hash.
        none = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
        hashes, owners, passage, place = (np.concatenate(c) for c in zip(none, *self.windows, strict=True))
        order = np.lexsort((owners, hashes))
        order = order[np.r_[True, hashes[order][1:] != hashes[order][:-1]]] if len(order) else order
        self.hashes, self.owners, self.passage, self.place = hashes[order], owners[order], passage[order], place[order]
        self.windows = []

    def covered(self, key: int, words: list[bytes]) -> list[int]:
        """Merged stretches of words in windows equal to a window of an owner smaller than key: begin, end, ..."""
        return self.covered_all([key], [b" ".join(words)])[0]

    def covered_all(self, keys: list[int], texts: list[bytes]) -> list[list[int]]:
        """covered() of many stretches at once, each the text of its words.

        They go through the automaton as one sequence with a word behind each; windows never reach over it. Each window
        around an occurrence is looked up once, and a run of windows that follow one another in a passage is compared with it at
        once, so the work is linear in the words, however many surroundings a phrase has.
        """
        found: list[list[int]] = [[] for _ in texts]
        raw = b"".join([text + b" \0 " for text in texts])
        words = raw.split()
        ends = [last for last, _ in self.automaton.iter(tuple(map(self.words.get, words, repeat(0))))] if self.phrases else []
        if not ends:
            return found
        # The words of each stretch and its separator, by where the separator's bytes are.
        places = word_places(raw)
        after = np.searchsorted(places[0], np.cumsum([len(text) + 3 for text in texts]))
        size = np.diff(np.r_[0, after])
        at = np.array(ends, np.int64) - PHRASE + 1
        text_of = np.searchsorted(after, at, "right")
        first, last = np.maximum(at - _SPAN + 1, (after - size)[text_of]), np.minimum(at, after[text_of] - 1 - WINDOW)
        fits = first <= last
        starts = _around(first[fits], last[fits], len(words))
        if not len(starts):
            return found
        hashes = stretch_hashes(text_hashes(raw, places), WINDOW)[starts]
        text_of = np.searchsorted(after, starts, "right")
        row = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        owned = (self.hashes[row] == hashes) & (self.owners[row] < np.array(keys, np.int64)[text_of])
        starts, row, text_of = starts[owned], row[owned], text_of[owned]
        passage, place = self.passage[row], self.place[row]
        # A window cannot begin in the last words of a stretch, so runs never pass from one to the next.
        new = (np.diff(starts) != 1) | (np.diff(passage) != 0) | (np.diff(place) != 1)
        cuts = np.flatnonzero(np.r_[True, new, True]) if len(starts) else np.zeros(0, np.int64)
        begins, runs, offset = starts[cuts[:-1]], np.diff(cuts), (after - size)[text_of[cuts[:-1]]]
        columns = (begins, runs, passage[cuts[:-1]], place[cuts[:-1]], text_of[cuts[:-1]], offset)
        for begin, n, held, other, which, zero in zip(*(c.tolist() for c in columns), strict=True):
            text, length, spans = self.passages[held], n + WINDOW - 1, found[which]
            whole = text[other : other + length] == words[begin : begin + length]
            for low, high in [(begin, begin + length)] if whole else _equal_windows(text, other, words, begin, n):
                if spans and low - zero <= spans[-1]:
                    spans[-1] = max(spans[-1], high - zero)
                else:
                    spans += [low - zero, high - zero]
        return found


def _around(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """The places below n that lie in a range from first to last, both included; an empty range has none."""
    fits = first <= last
    step = np.bincount(first[fits], minlength=n + 1) - np.bincount(last[fits] + 1, minlength=n + 1)
    return np.flatnonzero(np.cumsum(step[:n]) > 0)


def _equal_windows(text: list[bytes], other: int, words: list[bytes], begin: int, n: int) -> Iterator[tuple[int, int]]:
    """Those of n windows whose words are equal, where some only have equal hashes."""
    for k in range(n):
        if text[other + k : other + k + WINDOW] == words[begin + k : begin + k + WINDOW]:
            yield begin + k, begin + k + WINDOW


def _stream(routes):
    """Rows sorted by shard, part and kind: the passages of a part are compiled, then its documents go through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, automaton = None, None
        for batch in pieces(batches):
            out: list[list] = [[], [], []]
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for group, mine in groupby(rows, lambda row: row[:3]):  # shard, part and kind
                if group[:2] != now:
                    now, automaton = group[:2], PhraseAutomaton(routes.value, group[0])
                if group[2] == 0:
                    for row in mine:
                        automaton.add(row[3], row[6])
                    continue
                if automaton.automaton is None:
                    automaton.compile()
                mine = list(mine)
                for row, spans in zip(mine, automaton.covered_all([row[3] for row in mine], [row[6] for row in mine]), strict=True):
                    if spans:
                        for column, value in zip(out, (row[3], row[4], [x + row[5] for x in spans]), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32()))], names=["key", "same", "spans"])

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        keys, texts, spans = (c.to_pylist() for c in batch.columns)
        found = [_kept(utf8(t).split(), s or []) for t, s in zip(texts, spans, strict=True)]
        columns = [pa.array(keys, pa.int64()), *(pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "n_removed", "kept_sha256"])


def recurring_spans(scanned: DataFrame, routes, n_buckets: int) -> DataFrame:
    """key, same (hash of the text) and spans of covered words (begin, end, ...) of documents with any, per shard."""
    spark = scanned.sparkSession
    texts = scanned.where("kind = 1").select("bucket", "key", "same", "body", "parts")
    windows = texts.select("key", "body").mapInArrow(_collect(_windows(routes), n_buckets), _BLOBS)
    owned = windows.groupBy("bucket").applyInArrow(_owned(n_buckets), _BLOBS)
    owners = texts.select("bucket", "key", "body").groupBy("bucket").cogroup(owned.groupBy("bucket"))
    passages = stored(owners.applyInArrow(_cut_passages(routes), "shard int, key long, passage binary"), "passages")
    routed = texts.select("key", "same", F.inline("parts"))
    loads = routed.groupBy("shard").agg(F.ceil(F.sum(F.length("words")) / PART_BYTES).cast("int").alias("parts"))
    loads = stored(loads, "loads")  # a row for each shard
    streams = routed.join(F.broadcast(loads), "shard").select(
        "shard", F.pmod(F.xxhash64("key", "same"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), "key", "same", "at", F.col("words").alias("body")
    )
    ready = passages.join(F.broadcast(loads), "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "key", F.lit(0).cast("long").alias("same"), F.lit(0).alias("at"), F.col("passage").alias("body")
    )
    both = ready.union(streams).repartition(partitions(spark), "shard", "part").sortWithinPartitions("shard", "part", "kind")
    return both.mapInArrow(_stream(routes), "key long, same long, spans array<int>")


def _scanned(texts: DataFrame, n_shards: int, n_buckets: int) -> tuple[DataFrame, object]:
    routes = texts.sparkSession.sparkContext.broadcast(route_table(texts, n_buckets, n_shards))  # 2 ** ROUTE_BITS slots
    return stored(texts.mapInArrow(_scan(routes, n_buckets), _SCANNED), "scanned"), routes


def remove_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_removed and kept_sha256 (of the kept words joined by one space) of every row.

    A word goes if a window that covers it also occurs in a row with a smaller key. Rows with equal keys do not act on
    each other; rows with a null key keep all words and act on none. Null and empty texts have no words. Other columns
    are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    n_buckets = 2 * partitions(spark)
    scanned, routes = _scanned(texts, min(60_000, 2 * n_buckets), n_buckets)
    spans = recurring_spans(scanned, routes, n_buckets).groupBy("key", "same").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    touched = scanned.where("kind = 1").select("key", "same", "body").join(spans, ["key", "same"], "left").select("key", "body", "spans")
    finished = scanned.where("kind = 0").select("key", "n_words", "n_removed", "kept_sha256")
    return finished.union(touched.mapInArrow(_finish, "key long, n_words long, n_removed long, kept_sha256 string"))
