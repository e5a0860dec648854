"""Token ids of whole texts by the tokenizers library, with a table of chunks already encoded.

Texts of plain Latin characters are split by the tokenizer's own pattern, and each different pre-token goes once through
its model; equal ones then cost one dictionary look-up. Other texts, and any that could hold a special token, are cut at
spaces that follow a character other than white space: such a space always starts a new pre-token in the tokenizers used
here. Their chunks go through the whole tokenizer unless they are plain.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache
from sys import getsizeof

from tokenizers import Tokenizer

#: A space with white space on both sides may lie inside a pre-token.
_INSIDE = re.compile(r"\s \s")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
#: Characters whose class, case and composed form are the same in every Unicode version.
_PLAIN = re.compile(r"[\n !-~¡-¬®-į]*")
#: Letters and numbers among the plain characters.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-į", "0-9²³¹¼½¾"
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: itself if printable, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


#: Bytes that one table holds at most. Chunks can be as long as a text, so their number alone bounds nothing.
TABLE_BYTES = 48_000_000
#: Bytes of a place in a table, beside its key and its ids.
_PLACE = 64


class _Table(dict):
    """Ids of a chunk as little-endian unsigned 32-bit integers, computed when first asked for."""

    def __init__(self, encode, limit, most):
        super().__init__()
        self.encode, self.limit, self.most, self.held = encode, limit, most, 0

    def __missing__(self, key):
        ids = self.encode(key)
        size = getsizeof(key) + getsizeof(ids) + _PLACE
        if len(self) >= self.limit or self.held + size > self.most:
            self.clear()
            self.held = 0
        if size <= self.most:
            self[key] = ids
            self.held += size
        return ids


class TextEncoder:
    """encode(text) gives exactly the ids of Tokenizer.encode(text, add_special_tokens=False), as bytes."""

    def __init__(self, path: str, entries: int = 1_000_000, table_bytes: int = TABLE_BYTES):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special) or r"(?!)").search
        self.pattern, self.lower, self.spaced = self._plan(spec)
        self.plain = self.pattern and re.compile(self.pattern.replace(r"\p{L}", _LETTER).replace(r"\p{N}", _NUMBER)).findall
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        self.pre_tokens = _Table(self._pre_token, entries, table_bytes)
        self.first = _Table(self._chunk, entries, table_bytes)
        self.later = _Table(lambda part: self._chunk(" " + part), entries, table_bytes) if self.spaced else self.first

    @staticmethod
    def _plan(spec):
        """(pattern of pre-tokens, lower-cased?, is the space before a word part of it?); no pattern: no short cut."""
        kinds, pre = json.dumps(spec["normalizer"]), spec["pre_tokenizer"] or {}
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not spec["normalizer"]:
            return _BYTE_LEVEL, False, True
        split = (pre.get("pretokenizers") or [{}])[0]
        if split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"] and "Lowercase" in kinds:
            return split["pattern"]["Regex"], True, False
        return None, False, False

    @staticmethod
    def ids_of(ids):
        return struct.pack(f"<{len(ids)}I", *ids)

    def _pre_token(self, word):
        if not word.isascii() or word.startswith((" ", "\n")):  # other plain ASCII characters stand for themselves
            letters = self.letters
            word = "".join([letters[b] for b in word.encode()])
        return self.ids_of([t.id for t in self.model.tokenize(word)])

    def _whole(self, text):
        return self.ids_of(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk):
        return self._whole(chunk) if self.special(chunk) or not _PLAIN.fullmatch(chunk) else self._plain(chunk)

    def _plain(self, text):
        return b"".join(map(self.pre_tokens.__getitem__, self.plain(text.lower() if self.lower else text)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.pattern is None:
            return self._whole(text)
        if _PLAIN.fullmatch(text) and not self.special(text):
            return self._plain(text)
        if _INSIDE.search(text):
            return b"".join(map(self.first.__getitem__, _BEFORE_SPACE.split(text)))
        parts = text.split(" ")
        return self.first[parts[0]] + b"".join(map(self.later.__getitem__, parts[1:]))


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder per worker and vocabulary: its tables serve all tasks of that worker."""
    return TextEncoder(path)
