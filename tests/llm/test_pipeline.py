import sys
from collections import defaultdict
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from brute import awkward, components, crc, leaks  # noqa: E402

import corpus_pipeline  # noqa: E402
from fleetwatch.llm import pii, quality  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, documents, clashing, tmp_path_factory):
    """The given benchmark and labels; the given documents, with awkward rows, columns that clash, and a planted leak."""
    base = tmp_path_factory.mktemp("tables")
    given = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(k + 5000 if k is not None else None, t) for k, t in awkward()] + [(9000, f"Before it. {item} After it."), (9001, "Mail to some.one@example.org or call +1 (555) 123-4567 now, please.")]
    clashing(given.unionByName(documents(rows))).write.parquet(str(base / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(base / f"{name}.parquet"))
    return str(base)


def test_stages_against_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [r for r, s in zip(rows, model.score([t for _, t in rows]), strict=True) if s >= 0.5]
    groups, left = defaultdict(list), set()
    for row, (n, component) in components(rows).items():
        if n:
            groups[component].append(row)
        else:
            left.add(row)
    left |= {min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()}
    left = sorted(left, key=str)
    left = [r for r, leak in zip(left, leaks(left, items), strict=True) if not leak[-1]]
    left = [(k, pii.redact(t)) for k, t in left]
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    want = set()
    for key, text in left:
        ids = encode(text or "", add_special_tokens=False).ids + [0]
        start = 0
        while start < len(ids):
            size = (len(ids) - start) % 2048 or 2048
            want.add((key, start, size, crc(ids[start : start + size])))
            start += size
    result = corpus_pipeline.run(spark, folder)
    got = result.collect()
    assert {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    fill = defaultdict(int)
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048
    kept = {r["doc_id"] for r in got}
    assert 9000 not in kept and 9001 in kept


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "PII", "best-fit packing"]
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, none, folder)
        assert result.columns == docs.columns and result.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, none, folder).count() == 0
