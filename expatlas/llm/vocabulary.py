"""Byte-pair vocabularies in the JSON format of the tokenizers library."""

from __future__ import annotations

import json
import re
from array import array
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import SparkSession

from expatlas.scratch import ship


#: Letters and numbers that the ``regex`` package knows and the tokenizers library does not
#: (it has Unicode 16), as code points in hexadecimal.
NEWER_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE "
    "11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 "
    "1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 "
    "1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NEWER_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"

#: Upper-case letters whose lower case the library knows and Python's 15.1 tables do not:
#: code points and their lower case; then ranges and the distance to it.
NEWER_LOWER = "1C89 1C8A, A7CB 264, A7CC A7CD, A7CE A7CF, A7D2 A7D3, A7D4 A7D5, A7DA A7DB, A7DC 19B"
NEWER_LOWER_RANGES = "10D50-10D65 20, 16EA0-16EB8 1B"

#: Characters that combine or decompose in Python's tables and stand for themselves in the
#: library's older composition tables.
UNCOMBINED = (
    "7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50 10F82-10F85 "
    "11070 1133B 1145E 11839-1183A 11938 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F "
    "1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"
)


def code_points(listed: str) -> list[tuple[int, int]]:
    """First and last code point of each range."""
    ends = [[int(x, 16) for x in part.split("-")] for part in listed.split()]
    return [(e[0], e[-1]) for e in ends]


def character_class(listed: str) -> str:
    """The ranges as the inside of a character class."""
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in code_points(listed))


_NEWER = re.compile(f"[{character_class(NEWER_LETTERS + ' ' + NEWER_NUMBERS)}]")


class Pieces:
    """Finds all matches of a split pattern with the library's letters and numbers.

    Texts without newer characters, by far the most, are matched with the pattern as it is written.
    """

    def __init__(self, pattern: str) -> None:
        self.plain = regex.compile(pattern)
        letters, numbers = character_class(NEWER_LETTERS), character_class(NEWER_NUMBERS)
        strict = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{letters}{numbers}])")
        strict = strict.replace(r"[\p{L}]+", r"\p{L}+").replace(r"[\p{N}]", r"\p{N}")
        strict = re.sub(r"(?<!\\s)\\p\{L\}(?!\\p)", lambda _: rf"(?:(?![{letters}])\p{{L}})", strict)
        strict = re.sub(r"(?<!\})\\p\{N\}(?!\])", lambda _: rf"(?:(?![{numbers}])\p{{N}})", strict)
        self.strict = regex.compile(strict)

    def findall(self, text: str) -> list[str]:
        return (self.plain if text.isascii() or not _NEWER.search(text) else self.strict).findall(text)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, all others for the code points from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and special tokens; ``partners[left][right]`` is a pair's rank."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ids: dict[str, int] = model["vocab"]
        self.size = max([*ids.values(), *self.specials.values()]) + 1
        self.tokens: list[str] = [""] * self.size
        for token, i in [*ids.items(), *self.specials.items()]:
            self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = [ids[s] for s in symbols]
        self.last = [ids[s + self.end] for s in symbols]
        none: dict[int, int] = {}
        self.partners: list[dict[int, int]] = [none] * self.size
        self.merged: list[int] = []
        self.rank_of = array("q", [-1]) * self.size
        self.left, self.right = array("q", [-1]) * self.size, array("q", [-1]) * self.size
        for rank, (a, b) in enumerate(model["merges"]):
            new = ids[a + b]
            if self.partners[ids[a]] is none:
                self.partners[ids[a]] = {}
            self.partners[ids[a]][ids[b]] = rank
            self.merged.append(new)
            self.rank_of[new], self.left[new], self.right[new] = rank, ids[a], ids[b]
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None

    def symbols(self, word: bytes) -> list[int]:
        """Ids of a word's symbols; the last one carries the end-of-word mark, if the vocabulary has one."""
        found = [self.inner[b] for b in word]
        found[-1] = self.last[word[-1]]
        return found

    def merge(self, ids: list[int]) -> list[int]:
        """Repeatedly merge the adjacent pair of lowest rank, the leftmost first, until none is left.

        Pairs wait in a heap as rank * 2**32 + place; the symbols form a linked list, so that a merge
        costs the time of a few heap steps wherever it happens. Works in ``ids`` and returns the rest.
        """
        n, merged, partners = len(ids), self.merged, self.partners
        heap = []
        left = ids[0]
        for i in range(1, n):
            right = ids[i]
            rank = partners[left].get(right)
            if rank is not None:
                heap.append(rank << 32 | i - 1)
            left = right
        if not heap:
            return ids
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if j >= n or ids[i] < 0 or partners[ids[i]].get(ids[j]) != rank:
                continue
            new = merged[rank]
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = partners[new].get(ids[k])
                if rank is not None:
                    heappush(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = partners[ids[h]].get(new)
                if rank is not None:
                    heappush(heap, rank << 32 | h)
        return [i for i in ids if i >= 0]

    def split_specials(self, text: str) -> list[str]:
        """Ordinary text at even places, special tokens at odd ones."""
        if self.special_pattern is None or not any(s in text for s in self.specials):
            return [text]
        return self.special_pattern.split(text)


class Bounded(dict):
    """Results of ``make`` by word, at most 2 * ``most`` of them. Words over ``longest`` are not kept.

    When the table is full it becomes the old one, from which words in use are taken over.
    """

    def __init__(self, make, most: int = 200_000, longest: int | None = 48) -> None:
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if self.longest is not None and len(key) > self.longest:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


_LOADED: dict = {}


def shared_vocabulary(spark: SparkSession, path: str):
    """Broadcast a vocabulary file (a few MB at most) and give a function that loads it once a worker."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    if len(source) > 64 << 20:
        raise ValueError(f"{path}: vocabulary files over 64 MB are not broadcast")
    ship(spark)
    sent = spark.sparkContext.broadcast(source)

    def load(kind):
        key = (path, kind)
        if key not in _LOADED:
            _LOADED[key] = kind(Vocabulary(sent.value))
        return _LOADED[key]

    return load
