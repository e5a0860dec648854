"""Resampling, ranked search and url rules against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from brute import awkward
from pyspark.sql import functions as F

from fleetwatch.llm import lexical, resampling, urls
from fleetwatch.llm.queries import URL_RULES


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def same(got, want):
    return sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


ITEMS = [(1, "w1 w2 w3 É w1"), (2, "W4 w5 nowhere"), (3, None), (4, ""), (None, "w6 w7"), (1, "w1 w2 w3 É w1"), (5, "never seen"), (6, " ".join(f"w{i}" for i in range(60)))]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_ngram_crcs_from_two_prefixes():
    pick = random.Random(4)
    word = lambda: bytes(pick.choice(b"abc\xc3\xa9") for _ in range(pick.choice([1, 2, 9, 300])))
    texts = [[word() for _ in range(pick.choice([0, 1, 2, 40]))] for _ in range(60)]
    prefixes = resampling.Prefixes(texts)
    for n in (1, 2, 3, 7):
        want = [zlib.crc32(b" ".join(w[i : i + n])) for w in texts for i in range(len(w) - n + 1)]
        assert prefixes.crcs(n)[1].tolist() == want
    assert len(resampling.Prefixes([]).crcs(1)[1]) == 0


def resampled(rows, items, percent):
    grams = lambda t: (lambda w: [x.encode() for x in w] + [f"{a} {b}".encode() for a, b in zip(w, w[1:])])(words(t))
    bucket = lambda t: [zlib.crc32(g) % 10000 for g in grams(t)]
    s, t = (Counter(b for _, text in table for b in bucket(text)) for table in (rows, items))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
    out = []
    for key, text in rows:
        found = bucket(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(text))])
    order = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, row in enumerate(order[: percent * len(order) // 100]):
        row[4] = place + 1
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("percent", [25, 100, 0])
def test_resampling(spark, documents, clashing, items, percent):
    rows = awkward(5)
    got = resampling.resample(clashing(documents(rows)), items, percent=percent)
    assert same(got.collect(), resampled(rows, ITEMS, percent))


def test_resampling_of_empty_tables(spark, documents, items):
    rows = awkward(6)
    assert resampling.resample(documents(rows).limit(0), items).count() == 0
    assert same(resampling.resample(documents(rows), items.limit(0)).collect(), resampled(rows, [], 25))


def test_ranks_of_many_equal_rows_are_gapless(spark):
    rows = spark.range(0, 9000).select((F.col("id") % 3).alias("key"), (F.col("id") % 2 * -5000).alias("score"))
    got = resampling.rank_highest(rows, F.lit(True), 50).where("rank IS NOT NULL").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 4501))
    assert [r["key"] for r in sorted(got, key=lambda r: r["rank"])] == [0] * 1500 + [1] * 1500 + [2] * 1500 and {r["score"] for r in got} == {0}


def ranked(rows, items, k):
    tfs = [(key, Counter(words(text))) for key, text in rows]
    tfs = [x for x in tfs if x[1]]
    n_docs, n_terms = len(tfs), sum(c.total() for _, c in tfs)
    df = Counter(term for _, c in tfs for term in c)
    weight = lambda term: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
    out = []
    for item in {i for i, _ in items}:
        terms = {w for i, text in items if i == item for w in words(text)}
        scores = []
        for key, c in tfs:
            m = 100 - 50 + (50 * c.total() * n_docs) // n_terms
            score = sum(weight(t) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(None if item is None else str(item), place + 1, x[3], -x[0]) for place, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return out


@pytest.mark.parametrize("block", [(500_000, 50_000), (40, 7)])
@pytest.mark.parametrize(("k", "pass_terms"), [(5, 200_000), (50, 20)])
def test_ranked_search(spark, documents, clashing, items, block, k, pass_terms):
    rows = awkward(7, 80)
    docs = clashing(documents(rows)).repartition(3)
    assert same(lexical.rank_documents(docs, items, k, pass_terms=pass_terms, block=block).collect(), ranked(rows, ITEMS, k))


def test_ranked_search_of_empty_tables(spark, documents, items):
    docs = documents(awkward(7))
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs, items.where("item_id IN (3, 4)"))):
        assert lexical.rank_documents(a, b).count() == 0


def test_survivors_stay_exact_after_the_last_new_accumulator():
    pick = np.random.default_rng(3)
    for _ in range(30):
        n, v = 200, 12
        tf = pick.poisson(pick.choice([0.02, 0.5, 3.0], v)[None, :], (n, v))
        weights = np.sort(pick.integers(1, 9000, v))[::-1]
        held = [np.flatnonzero(row) for row in tf]
        lists = [(np.arange(n), np.zeros(n, bool), tf.sum(1) + 5, np.array([len(h) for h in held]), np.concatenate(held), np.concatenate([tf[i][h] for i, h in enumerate(held)]))]
        postings = lexical.Postings(lists, weights, n, int((tf.sum(1) + 5).sum()))
        full = np.zeros(n, np.int64)
        for t in range(v):
            part = slice(postings.edges[t], postings.edges[t + 1])
            full[postings.docs[part]] += postings.adds[part]
        at = postings.best(np.arange(v), 5, 0)
        assert (postings.sums[at] == full[at]).all()
        assert set(np.lexsort((np.arange(n), -full))[:5][np.sort(full)[::-1][:5] > 0]) <= set(at)


URLS = [None, "", "no scheme", "http://", "http://COM/x", "https://a.Example.com/en/1?x#y", "http://www.example.com/en/", "http://example.com#/en/", "ftp://x.net/es/1", "http://net/fr/", "http://netx/fr/", "http://a.net/ES/", "http://u@xcom/", "http://a.com", "x://http://b.com/"]


def judged(all_urls):
    """{url: (host, path, rule, verdict)}"""
    lower = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    out, tokens = {}, {}
    for url in set(all_urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = lower(host)
        fits = [(len(h + p), h + p, v) for v, h, p in ((r.verdict, r.host, r.path) for r in URL_RULES) if (host == h or host.endswith("." + h)) and path.startswith(p)]
        out[url] = (host, path, *(max(fits)[1:] if fits else (None, None)))
        word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
        tokens[url] = {"h/" + w for w in re.findall(word, host)} | {"p/" + w for w in re.findall(word, lower(path))}
    known = [(tokens[u], x[3]) for u, x in out.items() if x[3]]
    least = max(2, math.ceil(len(known) / 100))
    count, blocked = Counter(t for ts, _ in known for t in ts), Counter(t for ts, v in known for t in ts if v == "block")
    share = sum(v == "block" for _, v in known) / max(1, len(known))
    telling = sorted((t for t in count if count[t] >= least), key=lambda t: (-abs(blocked[t] / count[t] - share), t))[:1000]
    sets = Counter()
    for ts, v in known:
        kept = [t for t in telling if t in ts][:8]
        for size in (1, 2, 3):
            for s in combinations(sorted(kept), size):
                sets[s, v] += 1
                sets[s, None] += 1
    rules = [(set(s), n / sets[s, None], v == "block") for (s, v), n in sets.items() if v and n >= least and n * 100 >= sets[s, None] * 95]
    for url, (host, path, rule, verdict) in out.items():
        best = max(((c, b) for s, c, b in rules if s <= tokens[url]), default=None) if url is not None else None
        out[url] = (host, path, rule, verdict or ("block" if best and best[1] else "allow"))
    return out


def test_urls(spark):
    pick = random.Random(9)
    many = [f"http://{pick.choice(['www.', 'm.', 'blog.', ''])}{pick.choice(['one', 'two', 'casino-x'])}.{pick.choice(['example', 'other'])}.{pick.choice(['com', 'net', 'org'])}/{pick.choice(['en', 'es', 'fr', 'De'])}/{n}" for n in range(400)]
    rows = list(enumerate(URLS + many + many[:50] * 2 + ["http://b.org/" + "/".join(f"en{n}" for n in range(3000))]))
    want = judged([u for _, u in rows])
    pages = spark.createDataFrame([(k, u, "<p>") for k, u in rows], "page_id long, url string, html string")
    pages = pages.select("*", *[F.lit("x").alias(c) for c in ("key", "host", "path", "verdict", "tokens", "found")])
    got = urls.judge_urls(pages, URL_RULES)
    assert set(map(tuple, got.collect())) ^ {(k, *want[u]) for k, u in rows} == set() and got.count() == len(rows)
    learned = {(v[3]) for u, v in want.items() if v[2] is None and v[0].endswith("org")}
    assert learned == {"allow", "block"}
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()


def test_urls_with_labels_of_their_own_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://win.casino.org/a"), (2, "http://news.org/a"), (3, "http://news.org/a")], "page_id long, url string")
    labels = spark.createDataFrame([(f"http://{h}.org/{i}", v) for i in range(9) for h, v in (("casino", "block"), ("news", "allow"))], "url string, verdict string")
    assert same(urls.judge_urls(pages, [], labels=labels).select("key", "rule", "verdict").collect(), [(1, None, "block"), (2, None, "allow"), (3, None, "allow")])
    assert urls.judge_urls(pages.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in urls.judge_urls(pages, []).collect()} == {"allow"}


@pytest.mark.parametrize(("width", "vocabulary"), [(8, 1000), (4, 1000), (8, 5), (0, 0)])
def test_rules_of_wide_urls_are_exact(spark, width, vocabulary):
    """Every combination of up to three tokens is looked at, whatever goes to FP-growth."""
    pick = random.Random(11)
    rows = []
    for _ in range(300):
        tokens = set(pick.sample("abcdefghijkl", pick.randint(2, 10)))
        rows.append((sorted(tokens), "block" if {"a", "b", "c"} <= tokens or {"k", "l"} <= tokens else "allow"))
    rows += [(["sure", *"defg"], "block")] * 9
    least, count = 4, Counter()
    for tokens, verdict in rows:
        for size in (1, 2, 3):
            for s in combinations(sorted(tokens), size):
                count[s, verdict] += 1
                count[s, None] += 1
    sure = {(s, v): c / count[s, None] for (s, v), c in count.items() if v and c >= least and c * 100 >= count[s, None] * 95}
    want = {(s, v, round(x, 9)) for (s, v), x in sure.items() if not any(sure.get((part, v), 0) >= x for size in range(1, len(s)) for part in combinations(s, size))}
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    got = urls.mine_rules(labelled, support=1, width=width, vocabulary=vocabulary).collect()
    assert {(("a", "b", "c"), "block", 1.0), (("k", "l"), "block", 1.0), (("sure",), "block", 1.0)} <= want
    assert Counter((tuple(r["tokens"]), r["verdict"], round(r["confidence"], 9)) for r in got) == Counter(want)
    assert all(r["token"] == min(r["tokens"], key=lambda t: (count[(t,), None], t)) for r in got)
