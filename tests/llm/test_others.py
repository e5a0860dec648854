import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from brute import awkward, base_spans  # noqa: E402

from fleetwatch.llm import crf, extraction, neighbours, pii, quality, shards  # noqa: E402


def test_base_spans_are_those_of_the_patterns():
    pick = random.Random(2)
    for _ in range(30_000):
        letters = pick.choice(["0123456789.-+ ()", "ab@.-_1", "019 .-+@a(é😀", "01. "])
        text = "".join(pick.choice(letters) for _ in range(pick.randrange(50)))
        assert [s for s in pii.find_spans(text) if s[2] in pii.BASE] == base_spans(text), repr(text)


def test_addresses_and_accounts():
    text = 'See https://a.example/x?y=1, or www.b.example. IBAN: DE89 3704 0044 0532 0130 00; token = "f231efbfd1fd", password: hunter, account no. #12345678.'
    got = [(k, text[a:b]) for a, b, k in pii.find_spans(text) if k not in pii.BASE]
    assert got == [("url", "https://a.example/x?y=1"), ("url", "www.b.example"), ("account", "DE89 3704 0044 0532 0130 00"), ("account", "f231efbfd1fd"), ("account", "12345678")]
    assert pii.redact("mail é@ me@x.co now +1 (555) 123-4567") == "mail é@ [EMAIL] now [PHONE]"
    assert pii.redact(None) is None and pii.redact("") == ""


def test_pii_tables(spark, documents, clashing):
    rows = [*awkward(), (900, "a@b.cd " * 2000), (901, "4111 1111 1111 1111 and 10.1.2.3")]
    docs = clashing(documents(rows))
    got = {(r["key"], r["spans"]) for r in pii.pii_report(docs).collect()}
    assert got == {(k, pii.spell(pii.find_spans(t))) for k, t in rows}
    assert Counter(r["redacted"] for r in pii.scan(docs).collect()) == Counter(pii.redact(t) for _, t in rows)
    clean = pii.redact_column(docs, "text", "n_chars")
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert all(r["text"] is None or len(r["text"]) == r["n_chars"] for r in clean.collect())
    assert pii.pii_report(documents([])).count() == 0


def test_shards(spark, documents, clashing, tmp_path):
    rows = awkward()
    for n_shards in (1, 3, 24, 500):
        got = shards.shard_documents(clashing(documents(rows)), n_shards).collect()
        want = Counter((k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in rows)
        assert Counter((r["key"], r["size"], r["text_crc32"]) for r in got) == want
        places, sizes = defaultdict(list), Counter()
        for r in got:
            places[r["shard"]].append(r["slot"])
            sizes[r["shard"]] += r["size"]
        assert all(sorted(v) == list(range(len(v))) for v in places.values()) and set(places) <= set(range(n_shards))
        total, largest = sum(sizes.values()), max(r["size"] for r in got)
        assert all(abs(sizes[s] - total / n_shards) <= largest for s in range(n_shards))
        keys = [(r["shard"], r["key"] is not None, r["key"] or 0) for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
        assert [k[1:] for k in keys] == sorted(k[1:] for k in keys)  # contiguous in the order of the key
    shards.write_shards(documents(rows), str(tmp_path / "s"), 3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter(rows)
    assert shards.shard_documents(documents([]), 24).count() == 0


def chain(model, scores):
    """All label sequences of one short sequence, with their probabilities."""
    from itertools import product

    n, k = scores.shape
    ways = list(product(range(k), repeat=n))
    value = np.array([model.first[w[0]] + sum(scores[t, y] for t, y in enumerate(w)) + sum(model.steps[a, b] for a, b in zip(w, w[1:])) for w in ways])
    p = np.exp(value - value.max())
    return ways, p / p.sum(), value


def test_field_against_all_sequences():
    rng = np.random.default_rng(0)
    for k in (2, 3):
        lengths = np.array([4, 0, 1, 6, 2])
        model = crf.Model(np.zeros((1, k)), rng.normal(size=(k, k)), rng.normal(size=k), np.zeros(1), np.ones(1))
        scores = rng.normal(size=(13, k)) * 2
        likely, pairs, norm = crf.marginals(model, scores, lengths)
        best = crf.viterbi(model, scores, lengths)
        at, total, want_pairs = 0, 0.0, np.zeros((k, k))
        for n in lengths:
            if not n:
                continue
            ways, p, value = chain(model, scores[at : at + n])
            assert tuple(best[at : at + n]) == ways[int(value.argmax())]
            for t in range(n):
                assert np.allclose(likely[at + t], [p[[w[t] == y for w in ways]].sum() for y in range(k)])
            for w, q in zip(ways, p, strict=True):
                for a, b in zip(w, w[1:]):
                    want_pairs[a, b] += q
            total += np.log(np.exp(value).sum())
            at += n
        assert np.allclose(pairs, want_pairs) and np.isclose(norm, total)


def test_training_finds_the_pattern():
    rng = np.random.default_rng(3)
    x, y, lengths = [], [], rng.integers(1, 12, 200)
    for n in lengths:
        state = rng.integers(0, 2)
        for _ in range(n):
            state = state if rng.random() < 0.9 else 1 - state
            y.append(state)
            x.append([state + rng.normal() * 0.9, rng.normal()])
    x, y = np.array(x), np.array(y)
    model = crf.train(x, y, lengths)
    alone = ((x[:, 0] > 0.5) == y).mean()
    assert (crf.viterbi(model, model.scores(x), lengths) == y).mean() > alone + 0.05
    assert crf.train(np.zeros((0, 2)), np.zeros(0, int), np.zeros(0, int)).weights.shape == (2, 2)


SF = "/root/testdata/sf0.01"


def test_held_out_quality(spark, clashing, documents):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    got = quality.score_documents(docs, model).join(labels.withColumnRenamed("doc_id", "key"), "key").where("held_out").collect()
    assert all((zlib.crc32(str(r["key"]).encode()) % 3 == 1) for r in got)
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.97
    rows = awkward()
    odd = clashing(documents(rows))
    scores = quality.score_documents(odd, model).collect()
    assert len(scores) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scores)
    kept = quality.keep_good(odd, model)
    good = [bool(model.score([t])[0] >= 0.5) for _, t in rows]
    assert kept.columns == odd.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(r for r, g in zip(rows, good, strict=True) if g)
    assert quality.score_documents(documents([]), model).count() == 0
    nothing = quality.fit(documents([]), labels)
    assert nothing.score(["any", None]).tolist() == [0.5, 0.5]


def test_main_text(spark, clashing):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = extraction.fit(pages)
    held_out = [b for b in map(extraction.leaf_blocks, extraction.training_pages(["some", "other", "words"], 150, seed=99)) if b]
    flat = [b for page in held_out for b in page]
    labels = crf.viterbi(model, model.scores(extraction.block_features(flat)), np.array([len(b) for b in held_out]))
    assert np.mean(labels == np.array([b[3] for b in flat])) > 0.97
    page = """<!doctype html><html><head><title>T</title><script>if (a < b) "</p>"</script></head><body><nav><a href=/>Home</a></nav>
      <div class="ad">Buy</div><article><h1>A &amp;  B</h1><p>One<b> tw</b>o&nbsp;&#233;<br>three<p>four<!-- no --><aside>Related</aside></article>
      <div id=comments><p>Me too</p></div><footer>&copy; 2024</footer></body></html>"""
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<nav>only</nav>"), (1, "u", page), (None, "u", "<![weird"), (6, "u", "<p>" * 3000 + "<b>" * 3000 + "</i>" * 3000)]
    rows.append((7, "u", "<article>" + "<p>word &lt;b&gt; word</p>" * 20000 + "</article>"))
    odd = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = extraction.extract(odd, model).collect()
    assert sorted(r["key"] or 0 for r in got) == sorted(r[0] or 0 for r in rows)
    texts = {r["key"]: r["text"] for r in got}
    assert texts[1] == "A & B One two é three four" and texts[2] == texts[3] == texts[4] == ""
    assert texts[7] == " ".join(["word <b> word"] * 20000)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extraction.extract(odd.limit(0), extraction.fit(odd.limit(0))).count() == 0


def test_head_without_its_end_tag():
    head, body = "<html><head><meta charset=utf-8><title>T</title><style>s</style><template><p>no</p></template> \n", "<article><p>One two.</p></article>"
    pages = [head + tag + body for tag in ("<body>", "", "</body>", "</html>", "<br>", "<div/>", "</head><body>", "<body><head>")]
    pages += ["<head>" + body, head + "<script>if (a) '<p>'</script>" + body, head + "<noscript><p>no</noscript>" + body]
    for page in pages:
        assert [b[0] for b in extraction.leaf_blocks(page)] == ["One two."], page
    assert [b[0] for b in extraction.leaf_blocks("<head><title>T</title>bare <b>text</b>")] == ["bare text"]
    assert extraction.leaf_blocks(head + "<meta name=x> <link rel=y>\n") == []


def test_text_of_formulas_drawings_and_objects():
    page = """<p>So <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1</annotation></semantics></math> holds.</p>
      <svg><title>no</title><desc>no</desc><path d="M0"/><text>A <tspan>b</tspan>c</text></svg><p>See <object data=f><param name=a>the chart</object>.<p>desc"""
    assert [b[0] for b in extraction.leaf_blocks(page)] == ["So x=1 holds.", "A bc", "See the chart.", "desc"]


def test_words_late_in_a_long_attribute():
    for name in ("class", "id", "role", "aria-label"):
        (_, bits, _, _), = extraction.leaf_blocks(f'<div {name}="{"px-4 " * 2000}sidebar">x</div>')
        assert bits == extraction.leaf_blocks(f'<div {name}="sidebar">x</div>')[0][1] != 0


def nearest(rows, k):
    out = {}
    good = [(i, key, np.array(v, float)) for i, (key, v) in enumerate(rows) if key is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    for i, key, v in good:
        if key % 20 == 0:
            found = sorted((-float((w * v).sum()), other) for j, other, w in good if j != i and len(w) == len(v))
            out.setdefault(key, []).append(found[:k])
    return out


def test_neighbours(spark, clashing, monkeypatch):
    rng = np.random.default_rng(2)
    common = rng.normal(size=16)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.5, 2)).tolist()) for i in range(900)] + [(2000 + i, common.tolist()) for i in range(300)]
    rows += [(3000, None), (3020, []), (3040, [0.0] * 16), (3060, [float("nan")] * 16), (3080, [1.0, None] * 8), (3100, [1.0, 2.0]), (3101, [2.0, 1.0]), (40, rows[40][1]), (None, rows[3][1])]
    table = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    monkeypatch.setattr(neighbours, "LEAST", 30)
    monkeypatch.setattr(neighbours, "SHARE", 0.3)
    monkeypatch.setattr(neighbours, "BLOCK", 500)
    monkeypatch.setattr(neighbours, "QUERIES", 30)
    monkeypatch.setattr(neighbours, "DEPTH", 32)
    got = defaultdict(list)
    for r in neighbours.nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = nearest(rows, 20)
    assert set(got) == set(want)
    hit = total = 0
    for key, lists in want.items():
        if len(lists) > 1:
            continue  # an id that repeats: two queries
        found = sorted(got[key])
        assert [r for r, _, _ in found] == list(range(1, len(lists[0]) + 1))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hit += len({v for _, v, _ in found} & {v for _, v in lists[0]})
        total += len(lists[0])
        if key >= 2000 and key < 3000:  # equal vectors: the smallest ids
            assert [v for _, v, _ in found] == [v for _, v in lists[0]]
    assert hit / total >= 0.9
    assert neighbours.nearest_neighbours(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]
    want = nearest(rows, 20)
    got = defaultdict(set)
    for r in neighbours.nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    recall = np.mean([len(got[k] & {v for _, v in lists[0]}) / len(lists[0]) for k, lists in want.items()])
    assert recall >= 0.9
