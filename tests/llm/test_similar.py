import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from brute import awkward, components, leaks, recurring  # noqa: E402

from fleetwatch.llm import components as graph  # noqa: E402
from fleetwatch.llm import jaccard, passages, support  # noqa: E402
from fleetwatch.llm import leaks as leaking  # noqa: E402


@pytest.fixture(scope="module")
def rows():
    """The awkward rows, and documents of the same few passages so that shingles are frequent but not similar."""
    pick = random.Random(8)
    shared = [[f"p{k}x{i}" for i in range(30)] for k in range(4)]
    more = []
    for i in range(60):
        own = [f"o{i}y{k}" for k in range(pick.randint(3, 40))]
        more.append((1000 + i, " ".join(sum(pick.sample(shared, pick.randint(1, 4)), []) + own)))
    return awkward() + more


def test_components_of_documents(spark, documents, clashing, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    monkeypatch.setattr(jaccard, "PAIRED", 6)
    got = jaccard.similar_documents(clashing(documents(rows))).collect()
    want = components(rows)
    assert len(got) == len(rows)
    assert Counter((r["key"], r["n_shingles"], r["component_id"]) for r in got) == Counter((k, *want[k, t]) for k, t in rows)


def test_candidates_miss_no_link():
    """Postings of every kind, without the help of min-hashes, against all pairs."""
    pick = random.Random(2)
    pool = [np.uint64(x) for x in np.random.default_rng(0).integers(0, 2**63, 60)]
    sets = []
    for _ in range(120):
        base = pick.choice(sets) if sets and pick.random() < 0.6 else np.array(sorted(pick.sample(pool, pick.randint(2, 40))), np.uint64)
        extra = [np.uint64(pick.getrandbits(63)) for _ in range(pick.randint(0, 6))]
        sets.append(np.unique(np.array([x for x in base if pick.random() > 0.06] + extra, np.uint64)))
    sets = [s for s in sets if len(s)]
    for paired in (0, 5, 60):
        import pyarrow as pa

        jaccard.PAIRED, old = paired, jaccard.PAIRED
        try:
            posted = jaccard._Postings(np.sort(np.array(pool[:40], np.uint64)), 3)
            for comp, s in enumerate(sets):
                posted.add(s, comp)
            blobs = pa.Table.from_batches(list(posted.flush()))
        finally:
            jaccard.PAIRED = old
        found = set()
        for bucket in range(3):
            part = jaccard._meet((bucket,), blobs.filter(pa.compute.equal(blobs["bucket"], bucket)))
            found |= set(zip(part["a"].to_pylist(), part["b"].to_pylist(), strict=True))
        links = {(j, i) for i, a in enumerate(sets) for j in range(i) if 100 * len(np.intersect1d(a, sets[j])) >= 75 * len(np.union1d(a, sets[j]))}
        assert links and links <= found


def test_frequent_does_not_follow_the_tasks(spark, documents, monkeypatch):
    """A line in 150 texts that resemble each other in nothing else makes few candidates, however rows are dealt."""
    line = " ".join(f"line{i}" for i in range(30))
    rows = [(k, f"{line} " + " ".join(f"w{k}x{i}" for i in range(20))) for k in range(150)]
    made, possible = [], jaccard.possible
    monkeypatch.setattr(jaccard, "possible", lambda pairs, outlines: made.append(pairs.count()) or possible(pairs, outlines))
    got = jaccard.similar_documents(documents(rows).repartition(100)).collect()
    assert {r["key"]: r["component_id"] for r in got} == {k: k for k, _ in rows}
    assert made[-1] < 1000


def test_sets_of_many_texts_at_once(monkeypatch):
    texts = [t for _, t in awkward()] + [None, "", " ", "a", "a b c d", "a b c d e", "A b\tc d e a b c d e", "x " * 3000]
    alone = [next(jaccard.shingle_sets([t])).tolist() for t in texts]
    for together in (1, 50, 1 << 16):
        monkeypatch.setattr(jaccard, "TOGETHER", together)
        assert [s.tolist() for s in jaccard.shingle_sets(texts)] == alone
    by = {}
    for text, found in zip(texts, alone, strict=True):
        words = support.utf8(text).lower().split()
        want = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        assert len(found) == len(want) and found == sorted(set(found))
        by.setdefault(frozenset(want), set()).add(tuple(found))
    assert all(len(x) == 1 for x in by.values()) and len({x for y in by.values() for x in y}) == len(by)


def test_keep_one(spark, documents, clashing, rows):
    docs = clashing(documents(rows))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    want, by = components(rows), {}
    for key, text in rows:
        if want[key, text][0]:
            by.setdefault(want[key, text][1], set()).add(key)
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(got) == len(set(got))
    assert {k for k, t in got if want[k, t][0]} == {min(k, key=lambda x: (x is None, x)) for k in by.values()}
    assert {(k, t) for k, t in got if not want[k, t][0]} == {(k, t) for k, t in rows if not want[k, t][0]}


def test_empty(spark, documents):
    none = documents([])
    assert jaccard.similar_documents(none).count() == 0
    assert passages.remove_recurring(none).count() == 0


def test_graph_components(spark):
    edges = [(1, 2), (2, 3), (3, 2), (5, 5), (10, 9), (9, 8), (8, 7), (7, 6), (20, 30), (40, 30), (40, 50)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 8: 6, 9: 6, 10: 6, 20: 20, 30: 20, 40: 20, 50: 20}


def test_recurring_passages(spark, documents, clashing, rows):
    got = passages.remove_recurring(clashing(documents(rows)))
    assert Counter(tuple(r) for r in got.collect()) == Counter(recurring(rows))


@pytest.mark.parametrize("block", [64, 200, 1 << 20])
def test_words_are_hashed_at_once(block, monkeypatch):
    monkeypatch.setattr(support, "_BLOCK", block)
    pick = random.Random(6)
    odd = [b"a", b"\0", b"a\0", b"\x85", b"\xc2\xa0", b"x" * 63, b"x" * 65, b"y" * 500, b"\x1c", b"ab", b"ba"]
    by = {}
    for n in [0, 1, 2, 50, 400]:
        raw = b"".join(pick.choice([*odd, *[bytes([c]) for c in range(97, 105)], b" ", b"\t\n", b"\x0b", b"\x0c\r "]) for _ in range(n))
        words, (begin, end) = support.space_words(raw), support.word_places(raw)
        assert [raw[a:b] for a, b in zip(begin, end, strict=True)] == words
        hashes = support.word_hashes(raw).tolist()
        assert len(hashes) == len(words) and all(by.setdefault(w, h) == h for w, h in zip(words, hashes, strict=True))
    assert len(set(by.values())) == len(by)


def test_windows_single_out_the_same_phrase():
    pick = random.Random(4)
    words = [pick.choice([b"a", b"b", b"c"]) for _ in range(400)]
    each = passages.word_hashes(words)
    phrases, at, least = passages.singled_out(each)
    for w in range(len(words) - 49):
        inside = phrases[w : w + passages.WINDOW - passages.PHRASE + 1]
        assert least[w] == inside.min() and set(np.flatnonzero(inside == inside.min()) + w) <= set(at.tolist())


ITEMS = [(1, "alpha beta gamma"), (2, " ".join(f"b{i}" for i in range(25))), (2, " ".join(f"b{i}" for i in range(25))), (3, None), (4, "..."), (10, "solo"), (None, "alpha beta gamma"), (11, " ".join(f"b{i}" for i in range(5, 16)))]


def test_benchmark_words(spark, documents, clashing):
    texts = ["Alpha, BETA gamma! solo", None, "", "solo solo", " ".join(f"B{i}" for i in range(3, 20)), "x " + " ".join(f"b{i}." for i in range(30)), "alpha beta alpha beta gamma", "SOLOS élan b1 b2", "b1 " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[3])]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = clashing(documents(rows))
    want = leaks(rows, [(("" if k is None else k), t) for k, t in ITEMS])
    for block_bytes in (10**6, 40):  # one block of items, and several
        got = leaking.leak_report(docs, items, block_bytes=block_bytes).collect()
        assert Counter(tuple(r) for r in got) == Counter(want)
    kept = leaking.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(r for r, w in zip(rows, want, strict=True) if not w[-1])
    assert leaking.leak_report(documents([]), items).count() == 0
    assert {r["n_hit"] for r in leaking.leak_report(docs, items.limit(0)).collect()} == {0}


def test_wu_manber_on_random_words():
    pick = random.Random(9)
    items = [(i, " ".join(pick.choice("abcd") for _ in range(pick.choice([1, 2, 3, 9, 10, 11, 30])))) for i in range(30)]
    rows = [(i, " ".join(pick.choice("abcdef") for _ in range(pick.randrange(80)))) for i in range(200)]
    table = leaking.Patterns(items)
    for (_, text), want in zip(rows, leaks(rows, items), strict=True):
        spans, found = table.search(leaking.words_of(text))
        assert (sum(b - a for a, b in spans), len(found)) == want[2:4]
