import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from brute import awkward, crc  # noqa: E402

from fleetwatch.llm import packing, planes  # noqa: E402
from fleetwatch.llm.queries import encode_with  # noqa: E402
from fleetwatch.llm.tokens import TextEncoder  # noqa: E402

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")


def plain(file):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("file", FILES)
def test_encoder_equals_the_tokenizer(file):
    pick, want = random.Random(5), plain(file)
    letters = [*"ab Z.'sdt’1२ \n\t é́İΣ<|>\x1c\x85 　中😀ßŁ", "<|endoftext|>", "<|startoftext|>", " 's", "don't", "  "]
    got = TextEncoder(public_tokenizers.path(file), entries=300)
    texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(60))) for _ in range(3000)]
    for text in [*texts, None, "", " ", "x" * 5000, *(t for _, t in awkward())]:
        assert np.frombuffer(got.encode(text), "<u4").tolist() == want(text), repr(text)[:200]


@pytest.mark.parametrize("file", FILES)
def test_encoder_tables_are_bounded_in_bytes(file):
    """Texts without spaces are one chunk each: a bound on the number of chunks would keep all of these."""
    want, most = plain(file), 200_000
    got = TextEncoder(public_tokenizers.path(file), table_bytes=most)
    for n in range(60):
        for text in (chr(0x4E00 + n) * 3000, f"中{n} " + "x" * (n % 7)):
            assert np.frombuffer(got.encode(text), "<u4").tolist() == want(text)
        for held in (got.pre_tokens, got.first, got.later):
            assert sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in held.items()) <= most
    assert any((got.pre_tokens, got.first, got.later))
    huge = "丂" * 150_000  # longer than a whole table: encoded, not kept
    assert len(got.encode(huge)) == 4 * len(want(huge)) and huge not in got.first and huge not in got.later


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0), np.zeros(9), np.array([2**32 - 1]), rng.integers(0, 50_000, 1001), rng.integers(0, 2**32, 64)):
        ids = ids.astype("<u4")
        assert (planes.from_planes(planes.to_planes(ids, bits), len(ids)) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_token_file(spark, documents, clashing, tmp_path, bits):
    rows, want = awkward(), plain(FILES[0])
    chunks = planes.write_tokens(clashing(documents(rows)), str(tmp_path / "f"), encode_with(FILES[0]), end_id=1, block=100, bits=bits)
    assert {len(r["planes"]) for r in chunks.collect()} == {32 if bits else 4}
    assert all(r["n_ids"] <= 100 for r in chunks.collect())
    got = sorted(planes.token_digests(chunks).collect(), key=lambda r: r["start"])
    assert [r["key"] for r in got] == sorted([k for k, _ in rows], key=lambda k: (k is not None, k or 0))
    ids = {r["start"]: np.frombuffer(r["ids"], "<u4").tolist() for r in planes.read_tokens(chunks).collect()}
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(ids[at]) and r["ids_crc32"] == crc(ids[at])
        at += r["n_tokens"]
    texts = Counter((k, tuple(want(t) + [1])) for k, t in rows)
    assert texts == Counter((r["key"], tuple(ids[r["start"]])) for r in got)


def test_empty_tables(spark, documents, tmp_path):
    none = documents([])
    chunks = planes.write_tokens(none, str(tmp_path / "e"), encode_with(FILES[0]))
    assert planes.token_digests(chunks).count() == 0 and planes.read_tokens(chunks).count() == 0
    assert packing.pack(packing.cut_documents(none, encode_with(FILES[1]))).count() == 0


def test_packing(spark, documents, clashing):
    rows, want = awkward(), plain(FILES[1])
    got = packing.pack(packing.cut_documents(clashing(documents(rows)), encode_with(FILES[1]), capacity=256), 256).collect()
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    expected = Counter()
    for key, text in rows:
        ids = want(text) + [0]
        start, piece = 0, 0
        while start < len(ids):
            size = (len(ids) - start) % 256 or 256
            expected[key, piece, start, size, crc(ids[start : start + size])] += 1
            start, piece = start + size, piece + 1
    assert Counter((r["key"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    counts = Counter(r["length"] for r in got)
    assert len(sequences) <= packing.lower_bound(counts, 256) + 1


def fewest(lengths, capacity):
    """Exact number of sequences by trying all ways, for a few lengths."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def go(i, room):
        if len(room) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(room)
            return
        for j in range(len(room)):
            if room[j] >= lengths[i] and room[j] not in room[:j]:
                go(i + 1, room[:j] + [room[j] - lengths[i]] + room[j + 1 :])
        go(i + 1, room + [capacity - lengths[i]])

    go(0, [])
    return best[0]


def test_bin_completion():
    rng = np.random.default_rng(4)
    worse = 0
    for trial in range(150):
        lengths = rng.integers(1, 40, rng.integers(0, 10)).tolist() if trial % 2 else rng.integers(12, 30, rng.integers(0, 10)).tolist()
        plan = packing.bin_completion(Counter(lengths), 40)
        used = Counter()
        for filling, times in plan:
            assert sum(n * c for n, c in filling) <= 40 and times > 0
            for n, c in filling:
                used[n] += c * times
        assert used == Counter(lengths)
        n, exact = sum(t for _, t in plan), fewest(lengths, 40)
        assert packing.lower_bound(Counter(lengths), 40) <= exact <= n <= sum(t for _, t in packing.best_fit(Counter(lengths), 40))
        worse += n > exact
    assert worse <= 3


def test_fillings_of_many_lengths():
    lengths = np.random.default_rng(1).integers(200, 400, 400).tolist()
    plan = packing.bin_completion(Counter(lengths), 2048)
    assert sum((Counter({n: c * t}) for f, t in plan for n, c in f), Counter()) == Counter(lengths)
    assert sum(t for _, t in plan) == packing.lower_bound(Counter(lengths), 2048) < sum(t for _, t in packing.best_fit(Counter(lengths), 2048))
    count = np.bincount([9, 9, 8, 7, 6, 5, 4, 2], minlength=42)
    full = [f for f, waste in packing.completions(count, 41, [10_000]) if not waste]
    assert full and all(sum(n * c for n, c in f) == 41 and all(c <= count[n] for n, c in f) for f in full)
    assert max(len(f) for f in full) >= 4


def test_one_length_of_many_rows():
    plan = packing.bin_completion({700: 3_000_000, 648: 1_500_000}, 2048)
    assert sum(t for _, t in plan) == 1_500_000


def test_crc_helper():
    assert crc([1, 2]) == zlib.crc32(np.array([1, 2], "<u4").tobytes())
