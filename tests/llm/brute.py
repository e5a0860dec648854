"""Plain versions of the operators for small inputs, and an awkward table of documents."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

WORDS = [f"w{i}" for i in range(400)] + ["É", "ß", "中文", "a@b.co", "10.0.0.1", "'s", "don't", "!!", "<|endoftext|>"]


def awkward(seed=3, n=40):
    """(doc_id, text): nulls, empty and blank texts, repeated rows and ids, copies, near copies, shared passages, a long text."""
    pick = random.Random(seed)
    some = lambda k: [pick.choice(WORDS) for _ in range(k)]
    passage, hot = some(70), some(120)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (3, "one"), (None, "no id at all"), (None, None), (4, "one two three four"), (5, "same " * 200), (6, "same " * 150)]
    for i in range(10, 10 + n):
        kind = i % 5
        words = list(hot) if kind == 0 else some(pick.randint(1, 160))
        if kind == 0:
            for _ in range(pick.randint(0, 3)):
                words[pick.randrange(len(words))] = pick.choice(WORDS)
        if kind == 1:
            at = pick.randint(0, len(words))
            words[at:at] = passage[pick.randint(0, 25) :]
        rows.append((i, pick.choice([" ", "  ", "\n"]).join(words)))
    rows += [(100 + i, " ".join(hot)) for i in range(5)] + [(200, " ".join(some(4000))), (12, "an id that repeats " * 20)]
    pick.shuffle(rows)
    return rows


def components(rows):
    """{(doc_id, text): (n_shingles, component_id)}"""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset([tuple(w)]) if 0 < len(w) < 5 else frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        least[find(i)].append(key)
    return {row: (len(sets[i]), min((k for k in least[find(i)] if k is not None), default=None) if sets[i] else row[0]) for i, row in enumerate(rows)}


def recurring(rows):
    """[(doc_id, n_words, n_removed, kept_sha256)] by rows."""
    first = {}
    for key, text in rows:
        if key is not None:
            w = (text or "").encode().split()
            for k in range(len(w) - 49):
                first[tuple(w[k : k + 50])] = min(key, first.get(tuple(w[k : k + 50]), key))
    out = []
    for key, text in rows:
        w = (text or "").encode().split()
        keep = [True] * len(w)
        for k in range(len(w) - 49):
            if key is not None and first[tuple(w[k : k + 50])] < key:
                keep[k : k + 50] = [False] * 50
        left = [x for x, good in zip(w, keep, strict=True) if good]
        out.append((key, len(w), len(w) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
    return out


def leaks(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    patterns = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            patterns[tuple(w[k : k + n])].add(str(item))
    out = []
    for key, text in rows:
        w = words(text)
        hit, found = set(), set()
        for n in {len(p) for p in patterns}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in patterns:
                    hit.update(range(k, k + n))
                    found |= patterns[tuple(w[k : k + n])]
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = True
            if kind == "ip":
                good = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                sums = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
                good = 12 <= len(digits) <= 19 and sum(s - 9 if s > 9 else s for s in sums) % 10 == 0
            elif kind == "phone":
                good = 9 <= len(digits) <= 15
            if good:
                out.append((m.start(), order, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
