"""Benchmark decontamination by a stored positional inverted index, searched from the rarest terms."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from expatlas.scratch import discard, materialize, ship

#: Words are runs of ASCII digits, letters and anything beyond ASCII; A-Z are lower-cased.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

INDEX = "segment bigint, term binary, n bigint, places binary, ids array<{kind}>, sizes array<bigint>"


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return text.translate(_FOLD).split()


class Numbering(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**32 as groups of seven bits, the low ones first; the high bit says that more follow. Also the size of each."""
    v = values.astype(np.uint32)
    size = 1 + (v >= 1 << 7) + (v >= 1 << 14) + (v >= 1 << 21) + (v >= 1 << 28)
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    at = ends - size
    for k in range(5):
        on = size > k
        if not on.any():
            break
        out[at[on] + k] = ((v[on] >> np.uint32(7 * k)) & np.uint32(127)) | np.where(size[on] > k + 1, 128, 0).astype(np.uint32)
    return out, size


def unpack(blob: bytes) -> np.ndarray:
    """The numbers that ``pack`` wrote."""
    b = np.frombuffer(blob, np.uint8)
    last = np.flatnonzero(b < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    shift = (np.arange(len(b)) - np.repeat(first, last - first + 1)) * 7
    return np.add.reduceat((b & 127).astype(np.int64) << shift, first) if len(last) else np.zeros(0, np.int64)


def _segment(bodies: list[bytes]) -> tuple[list[bytes], np.ndarray, pa.Array, list[int]]:
    """Terms of some documents, how often each occurs, its packed places, and the documents' sizes.

    Places run on through the documents; a list holds its first place and then distances.
    """
    numbers = Numbering()
    rows = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in map(words_of, bodies)]
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    keys = flat << 32 | np.arange(len(flat))
    keys.sort()
    places, counts = keys & 0xFFFFFFFF, np.bincount(flat, minlength=len(numbers))
    ends = np.cumsum(counts)
    gaps = np.diff(places, prepend=0)
    heads = (ends - counts)[counts > 0]
    gaps[heads] = places[heads]
    packed, size = pack(gaps)
    offsets = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], ends])].astype(np.int64)
    lists = pa.Array.from_buffers(pa.large_binary(), len(numbers), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).cast(pa.binary())
    return list(numbers), counts, lists, [len(r) for r in rows]


def build_index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", segment_words: int = 1 << 21) -> DataFrame:
    """Postings of all terms of all documents, stored in the shared folder.

    The index is cut by document into segments of some ``segment_words`` words (more only where one
    document has more), each written by the task that reads the documents, without a shuffle: a row a
    term with its places, and one row without a term that lists the segment's documents and their
    sizes. A frequent term so has a bounded list in each of many segments. A null text has no words,
    repeated rows stay, and no other columns are carried.
    """
    ship(documents.sparkSession)
    kind = documents.schema[doc_id].dataType
    schema = INDEX.format(kind=kind.simpleString())
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def write(names: pa.Array, bodies: list[bytes], segment: int) -> Iterator[pa.RecordBatch]:
        terms, counts, lists, sizes = _segment(bodies)
        n = len(terms)
        ids = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
        whole = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), pa.array(sizes, pa.int64()))
        columns = ["segment", "term", "n", "places", "ids", "sizes"]
        yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.array([None], pa.binary()), pa.array([len(names)], pa.int64()), pa.array([None], pa.binary()), ids, whole], columns)
        for a in range(0, n, 1 << 16):
            m = min(n - a, 1 << 16)
            none = [pa.nulls(m, ids.type), pa.nulls(m, whole.type)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, segment), pa.int64()), pa.array(terms[a : a + m], pa.binary()), pa.array(counts[a : a + m], pa.int64()), lists.slice(a, m), *none], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, names, bodies, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            texts, begin = batch.column("text"), 0
            for i, x in enumerate(texts):
                bodies.append(x.as_py())
                held += len(bodies[-1]) // 6 + 1
                if held >= segment_words:
                    names.append(batch.column("doc_id").slice(begin, i + 1 - begin))
                    yield from write(pa.concat_arrays(names), bodies, segment)
                    segment, names, bodies, held, begin = segment + 1, [], [], 0, i + 1
            names.append(batch.column("doc_id").slice(begin))
        if bodies:
            yield from write(pa.concat_arrays(names), bodies, segment)

    return materialize(rows.mapInArrow(run, schema), "index")


def _directory(index: DataFrame) -> DataFrame:
    """``segment, at, doc_id, n_words`` of every document, ``at`` its place in the segment."""
    both = index.filter("term is null").select("segment", F.posexplode(F.arrays_zip("ids", "sizes")).alias("at", "d"))
    return both.select("segment", "at", F.col("d.ids").alias("doc_id"), F.col("d.sizes").alias("n_words"))


class Items:
    """Words of some test items as numbers of terms, and where the windows begin that are looked for.

    Windows of the same words are looked for once and belong to several items.
    """

    def __init__(self, texts: list[tuple[str, bytes]], window: int | None) -> None:
        numbers, flat, known = Numbering(), [], {}
        names = Numbering()
        starts, sizes, owners = [], [], []
        for name, text in texts:
            words = words_of(text)
            found = [numbers[w] for w in words]
            size = len(words) if window is None else min(window, len(words))
            for i in range(len(words) - size + 1) if words else ():
                key = tuple(found[i : i + size])
                if key not in known:
                    known[key] = len(starts)
                    starts.append(len(flat) + i)
                    sizes.append(size)
                    owners.append(set())
                owners[known[key]].add(names[name])
            flat += found
        self.terms, self.names = list(numbers), list(names)
        self.flat, self.starts, self.sizes = np.array(flat, np.int64), np.array(starts, np.int64), np.array(sizes, np.int64)
        self.owners = [sorted(o) for o in owners]
        self.frequency = np.zeros(len(numbers), np.int64)


def item_blocks(items: DataFrame, window: int | None, item_id: str, text: str, block_bytes: int) -> Iterator[Items]:
    """Test items in blocks of some ``block_bytes`` of text, by a hash of their ids: what is sent to the tasks is bounded."""
    total = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    for b in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).orderBy("item", "text").collect()
        yield Items([(r["item"], bytes(r["text"])) for r in part], window)


def _search(index: DataFrame, items: Items, find: Callable[[dict[int, np.ndarray], np.ndarray, Items], Iterator[tuple[int, np.ndarray, np.ndarray]]]) -> DataFrame:
    """Run ``find`` on every segment's postings of the items' terms: ``segment, at, items, ranges``, a row a document met.

    ``find`` gets places by term and the documents' borders, and gives number of window, first places
    and places behind the last word. How often a term occurs anywhere is counted first.
    """
    spark = index.sparkSession
    terms = spark.createDataFrame([(bytearray(t), i) for i, t in enumerate(items.terms)], "term binary, number int")
    for r in index.select("term", "n").join(F.broadcast(terms), "term").groupBy("number").agg(F.sum("n").alias("n")).collect():  # a row a term of the block
        items.frequency[r["number"]] = r["n"]
    sent = spark.sparkContext.broadcast(items)
    used = index.join(F.broadcast(terms), "term", "left").filter("number is not null or term is null").select("segment", "number", "places", "sizes")

    def search(table: pa.Table) -> pa.Table:
        wanted, places, borders = sent.value, {}, None
        for number, blob, sizes in zip(*(table.column(c).to_pylist() for c in ("number", "places", "sizes")), strict=True):
            if number is None:
                borders = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
            else:
                places[number] = np.cumsum(unpack(blob))
        begins, ends, owner = [], [], []
        for w, first, behind in find(places, borders, wanted):
            begins.append(first)
            ends.append(behind)
            owner.append(np.full(len(first), w))
        segment = table.column("segment")[0].as_py()
        if not begins:
            return pa.Table.from_pylist([], schema=out)
        begins, ends, owner = map(np.concatenate, (begins, ends, owner))
        document = np.searchsorted(borders, begins, "right") - 1
        met: dict[int, set] = defaultdict(set)
        for d, w in np.unique(np.stack([document, owner], 1), axis=0).tolist():
            met[d].update(wanted.owners[w])
        cover = np.zeros(borders[-1] + 1, np.int64)
        np.add.at(cover, begins, 1)
        np.add.at(cover, ends, -1)
        on = np.cumsum(cover)[:-1] > 0
        fresh = np.zeros(len(on), bool)
        fresh[borders[:-1][np.diff(borders) > 0]] = True
        low = np.flatnonzero(on & (fresh | ~np.concatenate([[False], on[:-1]])))
        high = np.flatnonzero(on & (np.concatenate([fresh[1:], [True]]) | ~np.concatenate([on[1:], [False]]))) + 1
        of = np.searchsorted(borders, low, "right") - 1
        ranges: dict[int, list] = defaultdict(list)
        for d, a, b in zip(of.tolist(), (low - borders[of]).tolist(), (high - borders[of]).tolist(), strict=True):
            ranges[d].append({"low": a, "high": b})
        return pa.Table.from_pylist([{"segment": segment, "at": d, "items": sorted(wanted.names[i] for i in met[d]), "ranges": ranges[d]} for d in sorted(met)], schema=out)

    out = pa.schema([("segment", pa.int64()), ("at", pa.int32()), ("items", pa.list_(pa.string())), ("ranges", pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))])
    return used.groupBy("segment").applyInArrow(search, "segment bigint, at int, items array<string>, ranges array<struct<low:bigint,high:bigint>>")


def _kept(candidates: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which of the candidates are among the places; both ascend."""
    at = np.searchsorted(places, candidates)
    at[at == len(places)] = 0
    return places[at] == candidates


def _phrases(places: dict[int, np.ndarray], borders: np.ndarray, items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Occurrences of windows: the rarest term's places, less its offset, are met with those of the next rarest, and so on."""
    absent = np.ones(len(items.terms), np.int64)
    absent[list(places)] = 0
    missing = np.concatenate([[0], np.cumsum(absent[items.flat])])
    for w in np.flatnonzero(missing[items.starts + items.sizes] == missing[items.starts]).tolist():
        begin, size = items.starts[w], items.sizes[w]
        terms = items.flat[begin : begin + size]
        order = np.argsort(items.frequency[terms], kind="stable").tolist()
        found = places[terms[order[0]]] - order[0]
        for o in order[1:]:
            if not len(found):
                break
            found = found[_kept(found + o, places[terms[o]])]
        if len(found):
            found = found[(found >= 0) & (found + size <= borders[np.minimum(np.searchsorted(borders, found, "right"), len(borders) - 1)])]
        if len(found):
            yield w, found, found + size


def _near(within: int) -> Callable:
    """Least stretches of at most ``within`` words of one document that hold all different terms of a window in any order."""

    def find(places: dict[int, np.ndarray], borders: np.ndarray, items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for w, (begin, size) in enumerate(zip(items.starts.tolist(), items.sizes.tolist(), strict=True)):
            terms = sorted(set(items.flat[begin : begin + size].tolist()), key=lambda t: items.frequency[t])
            if any(t not in places for t in terms):
                continue
            rare = places[terms[0]]
            ends = [rare]
            for t in terms[1:]:  # a stretch ends at a place of some term, no further than ``within`` behind a place of the rarest
                p = places[t]
                at = np.searchsorted(rare, p, "right") - 1
                ends.append(p[(at >= 0) & (p - rare[np.maximum(at, 0)] < within)])
            ends = np.unique(np.concatenate(ends))
            begins = ends.copy()
            for t in terms:
                at = np.searchsorted(places[t], ends, "right") - 1
                begins = np.minimum(begins, np.where(at >= 0, places[t][np.maximum(at, 0)], -within))
            on = (begins >= 0) & (ends - begins < within)
            on &= np.searchsorted(borders, begins, "right") == np.searchsorted(borders, ends, "right")
            begins, ends = begins[on], ends[on]
            least = np.concatenate([[True], begins[1:] > begins[:-1]]) if len(begins) else on[on]  # of the stretches with one begin the shortest
            if least.any():
                yield w, begins[least], ends[least] + 1

    return find


def _matches(index: DataFrame, items: DataFrame, window: int | None, find: Callable, item_id: str, text: str, block_bytes: int) -> DataFrame:
    """Documents with their words, the items met and the union of the places met, blocks of items taken together."""
    hits = None
    for block in item_blocks(items, window, item_id, text, block_bytes):
        if block.terms:
            part = _search(index, block, find)
            hits = part if hits is None else hits.union(part)
    directory, ranges = _directory(index), "array<struct<low:bigint,high:bigint>>"
    no_items, no_ranges = F.array().cast("array<string>"), F.array().cast(ranges)
    if hits is None:
        return directory.select("doc_id", "n_words", no_items.alias("items"), no_ranges.alias("ranges"))
    hits = hits.groupBy("segment", "at").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.flatten(F.collect_list("ranges"))).alias("_r"))

    def ahead(s: Column, r: Column) -> Column:
        rest = F.struct(F.greatest(r["low"], s["upto"]).alias("low"), r["high"].alias("high"))
        return F.struct(F.when(r["high"] > s["upto"], F.concat(s["done"], F.array(rest))).otherwise(s["done"]).alias("done"), F.greatest(s["upto"], r["high"]).alias("upto"))

    none = F.struct(no_ranges.alias("done"), F.lit(0).cast("bigint").alias("upto"))
    hits = hits.select("segment", "at", "items", F.aggregate("_r", none, ahead, lambda s: s["done"]).alias("ranges"))
    return directory.join(hits, ["segment", "at"], "left").select("doc_id", "n_words", F.coalesce("items", no_items).alias("items"), F.coalesce("ranges", no_ranges).alias("ranges"))


def phrase_matches(index: DataFrame, items: DataFrame, window: int = 10, item_id: str = "item_id", text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """Exact occurrences of windows of items: ``doc_id, n_words, items, ranges``, a row for each row of the documents.

    A window is ``window`` consecutive words of an item, or all words of a shorter one; windows never
    cross documents. ``items`` are the ids, as sorted strings, of the items with an occurring window;
    ``ranges`` are disjoint stretches of words (from ``low`` to before ``high``) that occurrences cover.
    Rows of one item id are one item; a null id is the item ''; null and empty items have no windows.
    Items go to the tasks in blocks of some ``block_bytes``, each block reading only its terms' postings.
    """
    return _matches(index, items, window, _phrases, item_id, text, block_bytes)


def proximity_matches(index: DataFrame, items: DataFrame, within: int, item_id: str = "item_id", text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """The same for items whose different words all stand, in any order, within ``within`` words of one document."""
    return _matches(index, items, None, _near(within), item_id, text, block_bytes)


def contamination(documents: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Every document's words, hit words and items: ``doc_id, n_words, n_hit, items, ranges, contaminated``."""
    index = build_index(documents)
    found = phrase_matches(index, items, window).withColumn("n_hit", F.aggregate("ranges", F.lit(0).cast("bigint"), lambda s, r: s + r["high"] - r["low"]))
    done = materialize(found.select("doc_id", "n_words", "n_hit", "items", "ranges", (F.col("n_hit") > 0).alias("contaminated")), "contamination")
    discard(index)
    return done
