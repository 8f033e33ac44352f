"""Token counts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from expatlas.llm.vocabulary import Bounded, Pieces, Vocabulary, shared_vocabulary

#: Fixed value: the split pattern of this byte-level family.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Counter:
    """Counts the tokens of texts; no identifiers are made beyond those of the pairs being merged.

    A text may be cut before every single space that precedes a visible character, for no piece and
    no run of white space that the pattern can match reaches over such a place. Chunks between cuts,
    and the words in them, are counted once and remembered in tables of bounded size.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.pieces = Pieces(PIECES)
        self.cut, self.uneven = re.compile(r" (?=\S)"), re.compile(r" (?=\s|\Z)")
        self.at_start = Bounded(self._chunk, 500_000)
        self.after_space = Bounded(lambda chunk: self._chunk(" " + chunk), 500_000)

    def _word(self, word: str) -> int:
        return len(self.vocabulary.merge(self.vocabulary.symbols(word.encode())))

    def _known(self, word: str) -> int:
        return self.after_space[word[1:]] if word[0] == " " and word[1:].isalpha() else self.at_start[word]

    def _chunk(self, chunk: str) -> int:
        if (chunk[1:] if chunk[:1] == " " else chunk).isalpha():
            return self._word(chunk)
        words = self.pieces.findall(chunk)
        return self._word(chunk) if len(words) == 1 else sum(map(self._known, words))

    def _plain(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = self.cut.split(text) if self.uneven.search(text) else text.split(" ")
        return self.at_start[first] * (first != "") + sum(map(self.after_space.__getitem__, rest))

    def count(self, text: str) -> int:
        parts = self.vocabulary.split_specials(text)
        return sum(map(self._plain, parts[::2])) + len(parts) // 2


def count_tokens(documents: DataFrame, vocabulary_path: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of every whole text: ``doc_id, n_bytes, n_tokens, over_limit``, a row for each row.

    Special tokens inside a text count as one token each. A null text counts as empty: 0 tokens.
    Repeated rows stay; an empty table gives none; other columns are not carried. One pass over the
    texts without any shuffle.
    """
    load = shared_vocabulary(documents.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load(Counter).count
        for batch in batches:
            tokens = pa.array([count(x) for x in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), tokens], ["doc_id", "n_bytes", "n_tokens"])

    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
