"""BPE encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from expatlas.llm.vocabulary import NEWER_LOWER, NEWER_LOWER_RANGES, UNCOMBINED, Bounded, Pieces, Vocabulary, character_class, code_points, shared_vocabulary

#: Fixed value: the split pattern of this word-level family; what it does not match is dropped.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


_UNCOMBINED = re.compile(f"([{character_class(UNCOMBINED)}])")
_LOWER = {int(a, 16): int(b, 16) for a, b in (pair.split() for pair in NEWER_LOWER.split(", "))}
for _range, _step in (pair.split() for pair in NEWER_LOWER_RANGES.split(", ")):
    _LOWER |= {c: c + int(_step, 16) for a, b in code_points(_range) for c in range(a, b + 1)}
_TO_LOWER = re.compile("[" + "".join(map(chr, sorted(_LOWER))) + "]")


def normalize(text: str) -> str:
    """Composed form, then lower case character by character (a final sigma is no exception), by the library's tables."""
    if text.isascii():
        return text.lower()
    if _UNCOMBINED.search(text):  # nothing composes or changes places with these
        text = "".join([unicodedata.normalize("NFC", part) if i % 2 == 0 else part for i, part in enumerate(_UNCOMBINED.split(text))])
    else:
        text = unicodedata.normalize("NFC", text)
    if _TO_LOWER.search(text):
        text = text.translate(_LOWER)
    return text.replace("Σ", "σ").lower()


class Encoder:
    """Exact byte-pair ids of words.

    For every prefix of a word one token is the last of the prefix's encoding. An automaton over the
    vocabulary lists the tokens that end at each place; among them the last token is the one that
    starts where a shorter prefix ends and is compatible with that prefix's last token, that is,
    merging the two side by side leaves them apart. Following these tokens back from the whole word
    gives the ids.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.words = Pieces(WORDS)
        self.odd_space = re.compile("[\x1c-\x1f]")
        spelled: dict[int, str] = {}
        for byte in range(256):  # a symbol of its own for a byte at the end of a word
            spelled[vocabulary.last[byte]] = chr(0x400 + byte)
            spelled[vocabulary.inner[byte]] = chr(0x200 + byte)
        for token in vocabulary.merged:
            spelled[token] = spelled[vocabulary.left[token]] + spelled[vocabulary.right[token]]
        self.length = array("q", [0]) * vocabulary.size
        self.matches = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, letters in spelled.items():
            self.length[token] = len(letters)
            self.matches.add_word(letters, token)
        self.matches.make_automaton()
        self.inner_letters = {b: chr(0x200 + b) for b in range(256)}
        self.pairs = Bounded(self._compatible, 200_000, None)
        self.ids_of = Bounded(self._chunk, 150_000)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` apart when they stand side by side.

        Go back in time from the finished tokens: undo the later formed of the two that face each
        other. The pair (x, y) facing each other would have merged if it has a rank below that of
        the merge which swallowed x, or not above that of the one which swallowed y (of equal pairs
        the leftmost merges first).
        """
        v = self.vocabulary
        partners, rank_of, left, right = v.partners, v.rank_of, v.left, v.right
        until_x = until_y = 1 << 60
        x, y = a, b
        while True:
            rank = partners[x].get(y)
            if rank is not None and rank < until_x and rank <= until_y:
                return False
            rx, ry = rank_of[x], rank_of[y]
            if rx < 0 and ry < 0:
                return True
            if rx > ry:
                until_x, x = rx, right[x]
            else:
                until_y, y = ry, left[y]

    def _compatible(self, key: int) -> bool:
        return self.compatible(*divmod(key, self.vocabulary.size))

    def encode_word(self, word: bytes) -> list[int]:
        letters = word.decode("latin-1").translate(self.inner_letters)
        letters = letters[:-1] + chr(0x400 + word[-1])
        length, size, pairs = self.length, self.vocabulary.size, self.pairs
        last = [-1] * (len(letters) + 1)
        for end, token in self.matches.iter(letters):
            end += 1
            if last[end] < 0:
                start = end - length[token]
                if start == 0 or pairs[last[start] * size + token]:
                    last[end] = token
        ids, place = [], len(letters)
        while place:
            ids.append(last[place])
            place -= length[last[place]]
        return ids[::-1]

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return array("I", self.encode_word(chunk.encode())).tobytes()
        words = self.words.findall(chunk)
        if len(words) == 1 and words[0] == chunk:
            return array("I", self.encode_word(chunk.encode())).tobytes()
        return b"".join(map(self.ids_of.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out = []
        for place, part in enumerate(self.vocabulary.split_specials(text)):
            if place % 2:
                out.append(array("I", [self.vocabulary.specials[part]]).tobytes())
            else:  # no word reaches over white space
                part = normalize(part)
                chunks = self.words.findall(part) if self.odd_space.search(part) else part.split()
                out += map(self.ids_of.__getitem__, chunks)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens' strings with spaces between them, as a vocabulary without a decoder gives them."""
        tokens = self.vocabulary.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode_documents(documents: DataFrame, vocabulary_path: str, digests: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every whole text.

    Returns ``doc_id, n_tokens`` and then ``ids`` (array of int) and ``decoded``, or with ``digests``
    ``ids_sha256`` and ``decoded_sha256``; a row for each row. A null text counts as empty and gives
    no ids. Repeated rows stay; an empty table gives none; other columns are not carried. One pass
    over the texts without any shuffle.
    """
    load = shared_vocabulary(documents.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(Encoder)
        for batch in batches:
            ids = [encoder.encode(x) for x in batch.column("text").to_pylist()]
            counts = np.array([len(x) // 4 for x in ids], np.int64)
            out = [batch.column("doc_id"), pa.array(counts, pa.int64())]
            if digests:
                out.append(pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()))
                out.append(pa.array([hashlib.sha256(encoder.decode(x).encode()).hexdigest() for x in ids], pa.string()))
                names = ["ids_sha256", "decoded_sha256"]
            else:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
                out.append(pa.array([encoder.decode(x) for x in ids], pa.string()))
                names = ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", *names])

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rest = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, {rest}")
