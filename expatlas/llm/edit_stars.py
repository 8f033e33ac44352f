"""Links within two edits among lines that share crowded segments, without meeting all pairs of a crowd.

A pair of lines is a shorter one (role ``SHORT``) and one that is 0, 1 or 2 letters longer (its role is
that number). A line's window is what is still to be compared; all before and after it is known to be
equal within a group ``ctx`` of lines. A window is cut into ``PARTS`` parts by the shorter line's length:

* both edits in one part: the part becomes the window of the next level;
* one edit in each of two parts: all else is equal, which groups the lines; in a crowded group each of
  the two parts must share an edit key, so that lines far from all others drop out alone;
* a window of at most ``LEAF`` letters has few edit keys, and all of them are made.

Under a full set of edit keys all shorter lines are within two edits of all longer ones. They are linked as
a star, to the smallest of either side: as many links as lines, and the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from expatlas.scratch import discard, materialize, ship

SHORT, PARTS, LEAF = 9, 8, 16
#: What the first and the second edit add to the longer line: a letter (1), none (0), or one less (-1).
KINDS = [(0, 0), (1, -1), (-1, 1), (0, 1), (1, 0), (1, 1)]
_BASE, _ODD = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []
_STATE = "hash long, odd int, role int, ctx long, edits int, w string"


def letter_parities(lines: pa.Array) -> pa.Array:
    """For each line a bit for each of 32 classes of letters: whether it has an odd number of them.

    An edit takes one letter, adds one or both, so that it changes two bits at most. A letter's class is made of its first byte.
    """
    texts = [x.encode("utf-8", "surrogatepass") for x in lines.to_pylist()]
    octets = np.frombuffer(b"".join(x + b"\x80" for x in texts), np.uint8)  # a byte that counts nothing, so that no line is empty
    bits = np.where(octets & 0xC0 == 0x80, 0, np.left_shift(np.int64(1), (octets & 31).astype(np.int64)))
    starts = np.cumsum([0, *(len(x) + 1 for x in texts)])[:-1]
    found = np.bitwise_xor.reduceat(bits, starts) if len(texts) else bits
    return pa.array(found.astype(np.uint32).view(np.int32), pa.int32())


def may_be_near(odd: Column, other: Column, edits: int) -> Column:
    """Whether two lines' parities allow so few edits."""
    return F.bit_count(odd.bitwiseXOR(other)) <= 2 * edits


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        columns = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(max(n, 1 << 14), base, np.uint64)
            x[0] = 1
            columns.append(np.multiply.accumulate(x))
        _POWERS[:] = columns
    return _POWERS


def mix(*parts) -> np.ndarray:
    """One 64-bit hash of several whole numbers, or arrays of them."""
    h = np.full(1, 0x5851F42D4C957F2D, np.uint64)
    for p in parts:
        h = (h ^ np.asarray(p, np.int64 if not isinstance(p, np.ndarray) else None).astype(np.uint64)) * _ODD
        h = h ^ (h >> np.uint64(32))
    return h.astype(np.int64)


class Spans:
    """Hashes of a text's substrings [i, j), each in constant time."""

    def __init__(self, text: str) -> None:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.size = len(codes)
        self.up, self.down = _powers(self.size + 2)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * self.up[: self.size], dtype=np.uint64)])

    def of(self, i, j) -> np.ndarray:
        return ((self.sums[np.atleast_1d(j)] - self.sums[np.atleast_1d(i)]) * self.down[np.atleast_1d(i)]).astype(np.int64)

    def without_one(self) -> np.ndarray:
        """Hashes of the whole text without its letter at each place."""
        at = np.arange(self.size)
        rest = self.of(at + 1, np.full(self.size, self.size)).astype(np.uint64)
        return (self.of(np.zeros(self.size, int), at).astype(np.uint64) + rest * self.up[at]).astype(np.int64)


def edit_keys(text: str, kind: int, short: bool) -> np.ndarray:
    """Keys under which a text of one side meets the other side's texts that are exactly one such edit away, or equal."""
    s = Spans(text)
    if kind == 0:
        at = np.arange(s.size)
        return mix(0, at, s.of(np.zeros(s.size, int), at), s.of(at + 1, np.full(s.size, s.size)))
    if (kind == 1) == short:
        return mix(kind, s.of(0, s.size))
    return np.unique(mix(kind, s.without_one()))


def leaf_keys(text: str, role: int, edits: int) -> set[int]:
    """All keys of a short window."""
    n, short = len(text), role == SHORT
    if edits == 1:
        return {int(k) for kind in ((0, 1) if short else (role,)) for k in edit_keys(text, kind, short)}
    out: set[tuple] = set()
    if short or role == 0:  # two letters changed, or one moved
        out |= {(0, p, q, text[:p], text[p + 1 : q], text[q + 1 :]) for q in range(n) for p in range(q)} if n > 1 else {(0, n)}
        out |= {(1, text[:p] + text[p + 1 :]) for p in range(n)}
    if short or role == 1:  # one letter more and another changed
        for t in [text] if short else {text[:p] + text[p + 1 :] for p in range(n)}:
            out |= {(2, p, t[:p], t[p + 1 :]) for p in range(len(t))} or {(2,)}
    if short:
        out.add((3, text))
    elif role == 2:
        out |= {(3, text[:p] + text[p + 1 : q] + text[q + 1 :]) for q in range(n) for p in range(q)}
    return {xxhash.xxh3_64_intdigest(repr(k).encode("utf-8", "surrogatepass")) - (1 << 63) for k in out}


def _cuts(row) -> tuple[list[int], int]:
    """Where the shorter line's window is cut, and how many letters this one has more."""
    more = 0 if row.role == SHORT else row.role
    length = len(row.w) - more
    return [length * k // PARTS for k in range(PARTS + 1)], more


def _shifts(row, a: int, b: int) -> list[int]:
    """Shifts of what lies between an edit in part ``a`` and one in part ``b``."""
    return [0] if row.role == SHORT else sorted({s for s, t in KINDS if s + t == row.role})


def _rests(row, spans: Spans) -> Iterator[tuple]:
    """Each choice of two parts, with the shift between them and a hash of all that lies outside."""
    at, more = _cuts(row)
    for a in range(PARTS):
        for b in range(a + 1, PARTS):
            for s in _shifts(row, a, b):
                if at[b] + s >= at[a + 1] + s >= at[a]:
                    outside = mix(row.ctx, a, b, spans.of(0, at[a]), spans.of(at[a + 1] + s, at[b] + s), spans.of(at[b + 1] + more, spans.size))
                    yield int(outside[0]), a, b, s


def _two_parts(row, need) -> Iterator[tuple]:
    """For each needed choice the two parts: (place, kind, text) of either, and the choice."""
    at, more = _cuts(row)
    for a, b, s in ((n["a"], n["b"], n["s"]) for n in need):
        if row.role == SHORT:
            yield (a, SHORT, row.w[at[a] : at[a + 1]]), (b, SHORT, row.w[at[b] : at[b + 1]]), (a, b, s)
        else:
            yield (a, s, row.w[at[a] : at[a + 1] + s]), (b, more - s, row.w[at[b] + s : at[b + 1] + more]), (a, b, s)


def _content(ctx: int, part: tuple) -> int:
    place, kind, text = part
    return int(mix(ctx, place, kind, Spans(text).of(0, len(text)))[0])


def _each(f, names: str, most: int = 20_000):
    """A function of rows to tuples as one of pandas batches, given out as frames of some ``most`` tuples: a
    line has hundreds of keys, and those of all lines of a batch take hundreds of MB."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            held: list[tuple] = []
            for row in x.itertuples(index=False):
                held += f(row)
                if len(held) >= most:
                    yield pd.DataFrame(held, columns=names.split())
                    held = []
            if held:
                yield pd.DataFrame(held, columns=names.split())

    return run


def stars(rows: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that link all lines of one side of a key (``key, hash, short``) with the smallest of the other.

    Keys' smallest lines are aggregated, on either side of the shuffle, and joined back: a key with very
    many lines is split like any skewed join key.
    """
    rows = materialize(rows, "keys")
    smallest = lambda on: F.min(F.when(on, F.col("hash")))
    ends = rows.groupBy("key").agg(smallest(F.col("short")).alias("x"), smallest(~F.col("short")).alias("y")).filter("x is not null and y is not null")
    return _pairs(rows.join(ends, "key").select("hash", F.when(F.col("short"), F.col("y")).otherwise(F.col("x")).alias("other")))


def _pairs(met: DataFrame) -> DataFrame:
    return met.filter("hash <> other").select(F.least("hash", "other").alias("a"), F.greatest("hash", "other").alias("b"))


def _grouped(rows: DataFrame, key: str, most: int) -> DataFrame:
    """The rows of keys with lines of both sides, two different ones at least. ``crowded`` says whether over
    ``most`` are the shorter ones; where not, ``met`` lists those, with their parities. No task holds the lines of a crowded key."""
    rows, short = materialize(rows, "grouped"), F.col("role") == SHORT
    ends = rows.groupBy(key).agg(F.count_if(short).alias("_x"), F.count_if(~short).alias("_y"), F.min("hash").alias("_low"), F.max("hash").alias("_high"))
    ends = ends.filter("_x > 0 and _y > 0 and _low < _high").select(key, "_x")
    few = rows.filter(short).join(ends.filter(F.col("_x") <= most).select(key), key, "left_semi").groupBy(key).agg(F.collect_list(F.struct("hash", "odd")).alias("met"))
    return rows.join(ends, key).join(few, key, "left").select(*rows.columns, (F.col("_x") > most).alias("crowded"), "met")


def _calm(grouped: DataFrame, edits: int) -> DataFrame:
    """Pairs of the keys that are not crowded; lines that share a key and whose parities lie too far apart make none."""
    near = F.filter("met", lambda x: may_be_near(x["odd"], F.col("odd"), edits))
    return _pairs(grouped.filter(~F.col("crowded") & (F.col("role") != SHORT)).select("hash", F.explode(near).alias("x")).select("hash", F.col("x.hash").alias("other")))


def two_places(state: DataFrame, edits: int, most: int, tasks: int) -> list[DataFrame]:
    """Pairs with one edit in each of two parts of their windows; at most ``tasks`` run Python at a time."""
    rests = state.mapInPandas(_each(lambda r: [(k, r.hash, r.odd, r.role, r.ctx, a, b, s) for k, a, b, s in _rests(r, Spans(r.w))], "key hash odd role ctx a b s"), "key long, hash long, odd int, role int, ctx long, a int, b int, s int")
    rests = materialize(_grouped(rests, "key", most), "rests")
    need = rests.filter("crowded").groupBy("hash", "role", "ctx").agg(F.collect_set(F.struct("a", "b", "s")).alias("need"))
    work = materialize(state.join(need, ["hash", "role", "ctx"]), "work")
    if work.isEmpty():
        return [_calm(rests, edits)]

    def parts(row) -> Iterator[tuple]:
        for part in {p for one, other, _ in _two_parts(row, row.need) for p in (one, other)}:
            yield row.hash, row.role, row.ctx, _content(row.ctx, part), int(mix(row.ctx, part[0])[0]), part[1], part[2]

    def keys(row) -> Iterator[tuple]:
        plain, short = int(Spans(row.text).of(0, len(row.text))[0]), row.kind == SHORT
        for kind in (-1, 0, 1) if short else (row.kind,):
            for k in edit_keys(row.text, kind, short):
                yield row.content, int(mix(row.place, k)[0]), kind, short, plain

    named = materialize(work.coalesce(tasks).mapInPandas(_each(parts, "hash role ctx content place kind text"), "hash long, role int, ctx long, content long, place long, kind int, text string"), "parts")
    contents = named.select("content", "place", "kind", "text").dropDuplicates(["content"])
    keyed = contents.coalesce(tasks).mapInPandas(_each(keys, "content edit kind short plain"), "content long, edit long, kind int, short boolean, plain long")
    keyed = materialize(keyed, "edits")
    ends = keyed.groupBy("edit").agg(F.min("plain").alias("_low"), F.max("plain").alias("_high"), F.max("short").alias("_one"), F.min("short").alias("_all"))
    alive = keyed.join(ends.filter("_low < _high and _one and not _all").select("edit"), "edit", "left_semi")
    hits = materialize(alive.groupBy("content").agg(F.collect_set(F.struct("kind", "edit")).alias("hits")), "hits")
    found = named.select("hash", "role", "ctx", "content").join(hits, "content").groupBy("hash", "role", "ctx").agg(F.collect_list(F.struct("content", "hits")).alias("found")).filter(F.size("found") > 1)

    def combine(row) -> Iterator[tuple]:
        known = {f["content"]: [(h["kind"], h["edit"]) for h in f["hits"]] for f in row.found}
        outside = {(a, b, s): k for k, a, b, s in _rests(row, Spans(row.w))}
        for one, other, choice in _two_parts(row, row.need):
            first, second = known.get(_content(row.ctx, one)), known.get(_content(row.ctx, other))
            if first and second:
                for s, x in first:
                    for t, y in second:
                        if (s, t) in KINDS:
                            yield int(mix(outside[choice], s, t, x, y)[0]), row.hash, row.role == SHORT

    combined = work.join(found, ["hash", "role", "ctx"]).coalesce(tasks).mapInPandas(_each(combine, "key hash short"), "key long, hash long, short boolean")
    out = materialize(stars(combined), "stars")
    discard(work, named, keyed, hits)
    return [_calm(rests, edits), out]


def one_place(state: DataFrame) -> DataFrame:
    """The parts of every window, as windows of which all else is equal."""

    def cut(row) -> Iterator[tuple]:
        at, more = _cuts(row)
        spans = Spans(row.w)
        for a in range(PARTS):
            ctx = mix(row.ctx, a, spans.of(0, at[a]), spans.of(at[a + 1] + more, spans.size))
            yield row.hash, row.odd, row.role, int(ctx[0]), row.edits, row.w[at[a] : at[a + 1] + more]

    return state.mapInPandas(_each(cut, "hash odd role ctx edits w"), _STATE)


def crowd_pairs(lines: DataFrame, allowed, edits: int, most: int) -> DataFrame:
    """Pairs ``a, b`` of the lines ``hash, line, n``, the links among them: a superset of all pairs within
    ``allowed(n)`` edits, n being the shorter length, but for stars in place of crowds and without pairs whose letters' parities rule them out.

    ``edits`` is 2 at most. The number of levels grows with the logarithm of the longest line and ends
    where no group is crowded; each is written to the shared folder.
    """
    ship(lines.sparkSession)
    lines = lines.select("hash", "n", "line", F.arrow_udf(letter_parities, "int")("line").alias("odd"))
    n = F.col("n") - F.col("more")
    longer = lines.select("*", F.explode(F.array(*[F.lit(i) for i in range(edits + 1)])).alias("more")).filter(allowed(n) >= F.greatest("more", F.lit(1)))
    longer = longer.select("hash", "odd", F.col("more").alias("role"), F.xxhash64(n).alias("ctx"), allowed(n).alias("edits"), F.col("line").alias("w"))
    shorter = lines.filter(allowed(F.col("n")) > 0).select("hash", "odd", F.lit(SHORT).alias("role"), F.xxhash64("n").alias("ctx"), allowed(F.col("n")).alias("edits"), F.col("line").alias("w"))
    crowd, found = materialize(shorter.union(longer), "windows"), []  # lines of one length, which share nothing yet
    short_window = F.char_length("w") - F.when(F.col("role") == SHORT, 0).otherwise(F.col("role")) <= LEAF
    while n_rows := crowd.count():
        tasks = max(8, n_rows // 500)  # few rows are not dealt out to many Python workers
        crowd = crowd.coalesce(tasks)
        leaves = crowd.filter(short_window).mapInPandas(_each(lambda r: [(int(mix(r.ctx, k)[0]), r.hash, r.role == SHORT) for k in leaf_keys(r.w, r.role, r.edits)], "key hash short"), "key long, hash long, short boolean")
        if not crowd.filter(short_window).isEmpty():
            found.append(materialize(stars(leaves), "stars"))
        rest = crowd.filter(~short_window)
        found += two_places(rest, edits, most, tasks)
        parts = materialize(_grouped(one_place(rest), "ctx", most), "parts")
        found.append(_calm(parts, edits))
        discard(crowd)
        crowd = materialize(parts.filter("crowded").select("hash", "odd", "role", "ctx", "edits", "w"), "crowd")
    if not found:
        return lines.select(F.col("hash").alias("a"), F.col("hash").alias("b")).limit(0)
    out = found[0]
    for df in found[1:]:
        out = out.union(df)
    return out
