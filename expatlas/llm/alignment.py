"""Alignment of two tokenizers by products of token-byte incidence matrices."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from expatlas.llm.positional_index import pack, unpack
from expatlas.llm.vocabulary import byte_symbols
from expatlas.scratch import discard, materialize, ship


class Csr:
    """A sparse matrix: row ``i`` has the columns ``columns[ptr[i]:ptr[i + 1]]``, in order, and their values."""

    def __init__(self, ptr: np.ndarray, columns: np.ndarray, width: int, values: np.ndarray | None = None) -> None:
        self.ptr, self.columns, self.width = ptr, columns, width
        self.values = np.ones(len(columns), np.int64) if values is None else values

    @classmethod
    def of_pairs(cls, rows: np.ndarray, columns: np.ndarray, height: int, width: int) -> Csr:
        """Ones at the given places, which ascend by row and column."""
        return cls(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=height))]), columns, width)

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(ptr, self.rows()[order], len(self.ptr) - 1, self.values[order])

    def times_sizes(self, other: Csr) -> int:
        """Products that ``times`` would add up."""
        return int(np.diff(other.ptr)[self.columns].sum())

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: each row is the sum of the other's rows at its columns, times its values."""
        sizes = np.diff(other.ptr)[self.columns]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - other.ptr[self.columns], sizes)
        row, column, value = np.repeat(self.rows(), sizes), other.columns[at], np.repeat(self.values, sizes) * other.values[at]
        key = row * max(other.width, 1) + column
        if len(key) and (np.diff(key) < 0).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        heads = np.flatnonzero(np.diff(key, prepend=-1) != 0) if len(key) else np.zeros(0, np.int64)
        total = np.add.reduceat(value, heads) if len(heads) else np.zeros(0, np.int64)
        row, column = np.divmod(key[heads], max(other.width, 1))
        return Csr(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(self.ptr) - 1))]), column, other.width, total)


def incidence(ends: np.ndarray) -> Csr:
    """Tokens against bytes: tokens follow each other, each up to its end."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(n), n)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[Csr, np.ndarray, Csr, Csr]:
    """Alignment of two ways to cut the same bytes into tokens, given where the tokens end.

    The product of one incidence matrix with the other's transpose holds the overlaps, in bytes, of
    tokens of either side. Where two overlapping tokens end together, a group of tokens ends. Gives
    the overlaps, which of them end together, and both sides' matrices of groups against tokens; the
    product of the first's transpose with the second links all tokens of a group.
    """
    overlaps = incidence(ends_a).times(incidence(ends_b).transposed())
    rows = overlaps.rows()
    together = ends_a[rows] == ends_b[overlaps.columns]
    stops = ends_a[rows[together]]
    groups = [Csr.of_pairs(np.searchsorted(stops, ends), np.arange(len(ends)), len(stops), len(ends)) for ends in (ends_a, ends_b)]
    return overlaps, together, *groups


#: A text may be cut before a single space or line feed between visible characters: neither tokenizer
#: has a token over such a place, and none whose choice depends on what lies on the other side.
_CUT = re.compile(r"(?<=\S)(?: (?=\S)|(?=\n\S))")


class Aligner:
    """Tokens of chunks of texts by both tokenizers, and how they are aligned.

    Chunks are numbered; tables grow with the different chunks met and are emptied between segments
    when they hold more than ``most``.
    """

    def __init__(self, file_a: str, model_b: bytes, most: int = 300_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(file_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.encode().replace("▁".encode(), b" ") for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        ids_a, ids_b = range(len(self.bytes_a)), range(len(self.bytes_b))
        # a token's number and what follows it: within a group, at the end of its side of one
        self.names = [f"{i}{mark}" for ids, marks in ((ids_a, ",|"), (ids_b, ",;")) for mark in marks for i in ids]
        self.name_sizes = np.array(list(map(len, self.names)), np.int64)
        self.lengths_a, self.lengths_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.most = most
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.right, self.sizes = np.zeros(0, bool), np.zeros((0, 3), np.int64)  # tokens by either side, groups
        self.links = Csr(np.zeros(1, np.int64), none, 1 << 63)  # pairs of ids, as id of the first << 32 | id of the second

    @staticmethod
    def _whole(chunk: str) -> str:
        """What a chunk covers: itself after a line feed or odd space, else a space and itself."""
        return chunk if chunk[0] in " \n" else " " + chunk

    @staticmethod
    def chunks(text: str) -> list[str]:
        first, *rest = _CUT.split(text)
        return [" " + first if first[0].isspace() else first, *rest]

    def _encoded(self, whole: list[str]) -> Iterator[tuple[list[int], list[int], list[bool]]]:
        """Both sides' tokens of what some chunks cover, and which chunks have their bytes back; others have no tokens.

        Chunks are encoded together, as the text that they would be, and one by one where that fails.
        """
        joined = "".join(whole)
        a = self.a.encode(joined, add_special_tokens=False).ids
        b = self.b.encode(joined if joined[0] == "\n" else joined[1:])
        if joined[0] == "\n" and b[0] == self.space:
            b = b[1:]
        if b"".join(map(self.bytes_a.__getitem__, a)) == joined.encode() == b"".join(map(self.bytes_b.__getitem__, b)):
            yield a, b, [True] * len(whole)
        elif len(whole) == 1:
            yield [], [], [False]
        else:
            for w in whole:
                yield from self._encoded([w])

    def learn(self, chunks: list[str]) -> None:
        """Encode and align new chunks, all of them as one matrix whose columns are their bytes, one after another."""
        alone = lambda c: c[0] == " " or c[-1].isspace()
        even = [c for c in chunks if not alone(c)]
        chunks = even + list(filter(alone, chunks))
        blocks = [even[i : i + 500] for i in range(0, len(even), 500)] + [[c] for c in chunks[len(even) :]]
        flat_a, flat_b, right = [], [], []
        for block in blocks:
            for a, b, ok in self._encoded(list(map(self._whole, block))):
                flat_a += a
                flat_b += b
                right += ok
        flat_a, flat_b, right = np.array(flat_a, np.int64), np.array(flat_b, np.int64), np.array(right, bool)
        stops = np.cumsum(np.array([len(self._whole(c).encode()) for c in chunks], np.int64) * right)
        ends_a, ends_b = np.cumsum(self.lengths_a[flat_a]), np.cumsum(self.lengths_b[flat_b])
        overlaps, together, groups_a, groups_b = align(ends_a, ends_b)
        rows = overlaps.rows()[together]
        pairs = flat_a[rows] << 32 | flat_b[overlaps.columns[together]]
        cuts = [np.searchsorted(ends, stops, "right") for ends in (ends_a, ends_b, ends_a[rows])]
        last_a, last_b = (np.isin(np.arange(len(g.columns)), g.ptr[1:] - 1) for g in (groups_a, groups_b))
        name = np.concatenate([flat_a + len(self.bytes_a) * last_a, flat_b + 2 * len(self.bytes_a) + len(self.bytes_b) * last_b])
        name = name[np.argsort(np.concatenate([2 * groups_a.rows(), 2 * groups_b.rows() + 1]), kind="stable")]
        text = "".join(map(self.names.__getitem__, name.tolist()))
        ends = np.concatenate([[0], np.cumsum(self.name_sizes[name])])[np.concatenate([[0], cuts[0] + cuts[1]])].tolist()
        self.groups += [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        self.known.update(zip(chunks, range(len(self.right), len(self.right) + len(chunks)), strict=True))
        self.right = np.concatenate([self.right, right])
        self.sizes = np.concatenate([self.sizes, np.stack([np.diff(c, prepend=0) for c in cuts], 1)])
        self.links = Csr(np.concatenate([self.links.ptr, self.links.ptr[-1] + cuts[2]]), np.concatenate([self.links.columns, pairs]), self.links.width)

    def segment(self, texts: list[str]) -> tuple[list[tuple], Csr, Csr, np.ndarray]:
        """Numbers and digest of every text; matrices of texts against chunks and of chunks against different pairs of ids; those pairs."""
        cut = [self.chunks(x) if x else [] for x in texts]
        if len(self.right) > self.most:
            self.forget()
        fresh = set(chain.from_iterable(cut)).difference(self.known)
        if fresh:
            self.learn(sorted(fresh))
        out, ptr, rows = [], np.zeros(len(texts) + 1, np.int64), []
        for i, part in enumerate(cut):
            at = np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))
            if not len(at) or not self.right[at].all():
                out.append((0, 0, 0, ""))
                continue
            digest = hashlib.sha256("".join(map(self.groups.__getitem__, at.tolist()))[:-1].encode()).hexdigest()
            out.append((*self.sizes[at].sum(axis=0).tolist(), digest))
            ptr[i + 1] = len(at)
            at.sort()
            rows.append(at)
        met, at = np.unique(np.concatenate(rows), return_inverse=True) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        sizes = np.diff(self.links.ptr)[met]
        ends = np.cumsum(sizes)
        flat = self.links.columns[np.arange(sizes.sum()) + np.repeat(self.links.ptr[met] - (ends - sizes), sizes)]
        pairs, column = np.unique(flat, return_inverse=True)
        return out, Csr(np.cumsum(ptr), at, len(met)), Csr(np.concatenate([[0], ends]), column, len(pairs)), pairs


_LOADED: dict = {}


def _aligner(spark: SparkSession, path_a: str, path_b: str):
    """Broadcast both vocabulary files (a few MB) and give a function that loads them once a worker."""
    ship(spark)
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
        files = f.read(), g.read()
    if sum(map(len, files)) > 64 << 20:
        raise ValueError("vocabulary files over 64 MB are not broadcast")
    sent = spark.sparkContext.broadcast(files)

    def load() -> Aligner:
        if (path_a, path_b) not in _LOADED:
            _LOADED[path_a, path_b] = Aligner(*sent.value)
        return _LOADED[path_a, path_b]

    return load


def _blob(x: np.ndarray) -> bytes:
    return x.astype(np.uint32).tobytes()


def _array(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.uint32).astype(np.int64)


def _packed_rows(m: Csr) -> bytes:
    """The columns of a matrix as distances within each row, in few bytes."""
    gaps = np.diff(m.columns, prepend=0)
    heads = m.ptr[:-1][np.diff(m.ptr) > 0]
    gaps[heads] = m.columns[heads]
    return pack(gaps)[0].tobytes()


def _unpacked_rows(blob: bytes, ptr: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(unpack(blob))])
    return total[1:] - np.repeat(total[ptr[:-1]], np.diff(ptr))


def align_documents(documents: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", segment_chars: int = 2 << 20) -> DataFrame:
    """Tokens of a space and every whole text by two tokenizers, and how they fit together.

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: tokens by either side;
    groups of tokens between bytes where tokens of both end; links, occurrences of tokens of both
    sides that end together; links whose pair of ids is the most frequent of its second id in the
    whole corpus, ties included; and the sum over links of their pairs' corpus-wide counts. A text that
    is null or empty, or whose tokens do not give its bytes back, has zeros and ''. Repeated rows stay;
    no other columns are carried.

    Texts are encoded once, in segments of some ``segment_chars`` characters (more only where one text
    is longer): a segment keeps its different pairs with their numbers and matrices of texts against
    chunks against pairs. Pairs are counted over segments, which so meet the counts once a pair and
    segment, and one more product gives each text's sums.
    """
    spark = documents.sparkSession
    load = _aligner(spark, path_a, path_b)
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digest = "array<struct<n_a:bigint,n_b:bigint,n_groups:bigint,groups_sha256:string>>"
    shape = pa.list_(pa.struct([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string())]))
    columns = ["segment", "ids", "digests", "text_ptr", "text_chunks", "chunk_ptr", "chunk_pairs", "pairs", "counts"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, segment = load(), TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0

        def put() -> pa.RecordBatch:
            found, docs, chunks, pairs = aligner.segment(texts)
            named = [dict(zip(("n_a", "n_b", "n_groups", "groups_sha256"), x, strict=True)) for x in found]
            of_chunk = np.bincount(docs.columns, minlength=docs.width)
            counts = np.bincount(chunks.columns, np.repeat(of_chunk, np.diff(chunks.ptr)), len(pairs)).astype(np.int64)
            blobs = [pa.array([x], pa.binary()) for x in (_blob(docs.ptr), _packed_rows(docs), _blob(chunks.ptr), _blob(chunks.columns))]
            whole = pa.concat_arrays(ids)
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), one(whole), pa.array([named], shape), *blobs, one(pa.array(pairs)), one(pa.array(counts))], columns)

        for batch in batches:
            begin, bodies = 0, batch.column("text")
            for i, x in enumerate(bodies):
                texts.append(x.as_py())
                held += len(texts[-1])
                if held >= segment_chars:
                    ids.append(batch.column("doc_id").slice(begin, i + 1 - begin))
                    yield put()
                    segment, ids, texts, held, begin = segment + 1, [], [], 0, i + 1
            ids.append(batch.column("doc_id").slice(begin))
        if texts:
            yield put()

    blobs = ", ".join(f"{c} binary" for c in columns[3:7])
    encoded = materialize(rows.mapInArrow(encode, f"segment bigint, ids array<{kind}>, digests {digest}, {blobs}, pairs array<bigint>, counts array<bigint>"), "aligned")
    met = encoded.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = materialize(met.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pairs")
    highest = totals.groupBy("b").agg(F.max("n").alias("high"))
    judged = totals.join(highest, "b").select("pair", "n", (F.col("n") == F.col("high")).alias("best"))
    asked = encoded.select("segment", F.posexplode("pairs").alias("at", "pair"))
    told = asked.join(judged, "pair").groupBy("segment").agg(F.array_sort(F.collect_list(F.struct("at", "n", "best"))).alias("_t"))
    both = encoded.drop("pairs", "counts").join(told, "segment", "left").select("ids", "digests", *columns[3:7], F.col("_t.n").alias("n"), F.col("_t.best").alias("best"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, digests, *matrices, n, best = (c[i] for c in batch.columns)
                text_ptr, chunk_ptr, chunk_pairs = (_array(matrices[m].as_py()) for m in (0, 2, 3))
                text_chunks = _unpacked_rows(matrices[1].as_py(), text_ptr)
                count = np.array(n.as_py() or [], np.int64)
                is_best = np.array(best.as_py() or [], np.int64)
                zero = lambda v, ptr: np.concatenate([[0], np.cumsum(v)])[ptr]
                sums = []
                for value in (is_best, count):
                    chunk = np.diff(zero(value[chunk_pairs], chunk_ptr))
                    sums.append(np.diff(zero(chunk[text_chunks], text_ptr)))
                d = digests.values
                yield pa.RecordBatch.from_arrays([ids.values, d.field("n_a"), d.field("n_b"), d.field("n_groups"), d.field("n_groups"), pa.array(sums[0]), pa.array(sums[1]), d.field("groups_sha256")], names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    done = both.mapInArrow(finish, f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
    done = materialize(done, "alignment")
    discard(encoded, totals)
    return done


def token_links(documents: DataFrame, path_a: str, path_b: str, kind: str = "overlap", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Linked tokens of every text, a row a link: ``doc_id, a_at, b_at, a, b, weight``; a text without tokens has none.

    ``overlap`` links tokens that share bytes, ``weight`` of them; ``together`` those of these that end
    at one byte; ``group`` all tokens of either side between two bytes where both end (weight 1), made
    for some groups at a time as one group may hold many.
    """
    if kind not in ("overlap", "together", "group"):
        raise ValueError(kind)
    load = _aligner(documents.sparkSession, path_a, path_b)
    key = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def links(ends_a: np.ndarray, ends_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        overlaps, together, groups_a, groups_b = align(ends_a, ends_b)
        if kind != "group":
            on = together if kind == "together" else np.ones(len(together), bool)
            yield overlaps.rows()[on], overlaps.columns[on], overlaps.values[on]
            return
        to_group = groups_a.transposed()
        step = max(1, int(len(ends_a) * (1 << 16) / max(1, to_group.times_sizes(groups_b))))
        for low in range(0, len(ends_a), step):
            ptr = to_group.ptr[low : low + step + 1]
            shared = Csr(ptr - ptr[0], to_group.columns[ptr[0] : ptr[-1]], to_group.width).times(groups_b)
            yield shared.rows() + low, shared.columns, shared.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load()
        for batch in batches:
            for i, x in enumerate(batch.column("text").to_pylist()):
                if not x:
                    continue
                a = np.array(aligner.a.encode(" " + x, add_special_tokens=False).ids, np.int64)
                b = np.array(aligner.b.encode(x), np.int64)
                cut_a, cut_b = [aligner.bytes_a[t] for t in a.tolist()], [aligner.bytes_b[t] for t in b.tolist()]
                if not b"".join(cut_a) == (" " + x).encode() == b"".join(cut_b):
                    continue
                for p, q, weight in links(*(np.cumsum([len(t) for t in cut]).astype(np.int64) for cut in (cut_a, cut_b))):
                    ids = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(p), np.int32)), batch.column("doc_id").slice(i, 1)).dictionary_decode()
                    yield pa.RecordBatch.from_arrays([ids, pa.array(p), pa.array(q), pa.array(a[p]), pa.array(b[q]), pa.array(weight)], ["doc_id", "a_at", "b_at", "a", "b", "weight"])

    return rows.mapInArrow(run, f"doc_id {key}, a_at bigint, b_at bigint, a bigint, b bigint, weight bigint")
