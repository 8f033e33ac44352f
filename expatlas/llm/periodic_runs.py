"""Periodic runs of words, found in a grammar that Re-Pair makes of a document's word numbers."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from expatlas.llm.positional_index import Numbering
from expatlas.scratch import ship

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 6, 4


def fragments(flat: np.ndarray, borders: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that hold every run, as first places and places behind the last word.

    Of the triples of words in a run of four periods and six words each occurs there three times at
    least. Pairs that occur too seldom are never replaced by a grammar, and no run crosses them: the
    sequence is cut where all triples over a place occur under three times in their stretch, as often
    as that helps. Counts by hash only ever keep too much.
    """
    n = len(flat) - 2
    if n < 1:
        return []
    of = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    alive = np.flatnonzero(of[:-2] == of[2:])
    part, odd = of[alive], np.uint64(0x9E3779B97F4A7C15)
    w = flat.astype(np.uint64)
    with np.errstate(over="ignore"):
        triple = ((w[:-2] * odd + w[1:-1]) * odd + w[2:]) * odd
    while len(alive):
        bits = max(8, int(4 * len(alive)).bit_length())
        with np.errstate(over="ignore"):
            slot = ((triple[alive] + part.astype(np.uint64)) * odd) >> np.uint64(64 - bits)
        keep = np.bincount(slot.astype(np.int64), minlength=1 << bits)[slot.astype(np.int64)] >= 3
        seldom = len(alive) - np.count_nonzero(keep)
        alive, part = alive[keep], part[keep]
        fresh = np.concatenate([[True], (np.diff(alive) > 1) | (np.diff(part) > 0)]) if len(alive) else keep[keep]
        part = np.cumsum(fresh) if len(alive) else part
        if seldom < 0.1 * (len(alive) + seldom):
            break
    if not len(alive):
        return []
    heads = np.flatnonzero(fresh)
    first, last = alive[heads], alive[np.concatenate([heads[1:] - 1, [len(alive) - 1]])]
    long = last - first + 3 >= LEAST
    return list(zip(first[long].tolist(), (last[long] + 3).tolist(), strict=True))


def re_pair(sequences: list[list[int]], terminals: int) -> tuple[list[tuple[int, int]], list[int], list[int], list[list[tuple[int, int]]]]:
    """Replace the most frequent pair of neighbours by a new symbol until none occurs twice.

    Of pairs that are equally frequent the one that stands for fewest words comes first, so that rules
    stay balanced. Occurrences do not overlap and are taken from the left. Gives the rules, numbered
    from ``terminals`` on, the number of words and one place (in the joined sequences) of each, and
    what is left of every sequence as pairs of symbol and place.
    """
    symbol: list[int] = []
    after: list[int] = []
    before: list[int] = []
    pairs: dict[tuple[int, int], list[int]] = defaultdict(list)
    starts = []
    for s in sequences:
        base, m = len(symbol), len(s)
        starts.append(base if s else -1)
        symbol += s
        after += [*range(base + 1, base + m), -1][:m]
        before += [-1, *range(base, base + m - 1)][:m]
        for i, pair in enumerate(zip(s, s[1:], strict=False), base):
            pairs[pair].append(i)
    rules: list[tuple[int, int]] = []
    sizes: list[int] = []
    places: list[int] = []
    size = lambda x: 1 if x < terminals else sizes[x - terminals]
    heap = [(-len(at), 2, pair) for pair, at in pairs.items() if len(at) > 1]
    heapify(heap)
    while heap:
        count, words, pair = heappop(heap)
        a, b = pair
        found, upto = [], -1
        for i in pairs[pair]:
            if symbol[i] == a and i != upto and (j := after[i]) >= 0 and symbol[j] == b:
                found.append(i)
                upto = j
        if len(found) < -count:
            if len(found) > 1:
                heappush(heap, (-len(found), words, pair))
            continue
        del pairs[pair]
        new = terminals + len(rules)
        rules.append(pair)
        sizes.append(words)
        places.append(found[0])
        fresh = set()
        for i in found:
            j = after[i]
            k, h = after[j], before[i]
            symbol[i], symbol[j] = new, -1
            after[i] = k
            if k >= 0:
                before[k] = i
                pairs[new, symbol[k]].append(i)
                fresh.add((new, symbol[k]))
            if h >= 0:
                pairs[symbol[h], new].append(h)
                fresh.add((symbol[h], new))
        for pair in fresh:
            if len(pairs[pair]) > 1:
                heappush(heap, (-len(pairs[pair]), size(pair[0]) + size(pair[1]), pair))
    left = []
    for i in starts:
        rest = []
        while i >= 0:
            rest.append((symbol[i], i))
            i = after[i]
        left.append(rest)
    return rules, sizes, places, left


def _prefixes(t) -> list[int]:
    """How many words from each place on are those at the beginning."""
    n = len(t)
    z = [n] * n
    a = b = 0
    for i in range(1, n):
        k = min(b - i, z[i - a]) if i < b else 0
        while i + k < n and t[k] == t[i + k]:
            k += 1
        z[i] = k
        if i + k > b:
            a, b = i, i + k
    return z


def _alike(s, t) -> int:
    """Length of the longest common prefix."""
    done, step, n = 0, 8, min(len(s), len(t))
    while done < n and s[done : done + step] == t[done : done + step]:
        done, step = done + step, step * 2
    if done >= n:
        return n
    while step > 1:
        step //= 2
        if s[done : done + step] == t[done : done + step]:
            done += step
    return min(done, n)


def _right(u, v) -> Iterator[tuple[int, int, int]]:
    """Runs over the border of ``u`` and ``v`` with two periods or more in ``v``: words in ``u``, words in ``v``, period."""
    if len(v) < 2 or (v[0] != v[1] and (v.find(v[:2], 1) < 0 if isinstance(v, str) else False)):
        return
    z, upto = _prefixes(v), 0
    back = None
    for q in range(1, len(v) // 2 + 1):
        if z[q] >= q and 2 * q > upto:  # else a shorter period holds that long and divides this one
            upto = q + z[q]
            if back is None:
                back = u[::-1]
            whole = v[:q][::-1] + back
            k = _alike(back, whole)
            if k + upto >= max(LEAST, TIMES * q):
                yield k, upto, q


def crossing(u, v) -> list[tuple[int, int, int]]:
    """Runs that hold the last word of ``u`` and the first of ``v``, as words in ``u``, words in ``v`` and period.

    A run of four periods has two of them on one side of the border at least.
    """
    found = [r for r in _right(u, v) if r[0]]
    return found + [(b, a, q) for a, b, q in _right(v[::-1], u[::-1]) if a]


def runs_of(sequences: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """Maximal runs of each sequence of word numbers as ``(start, length, period)``.

    A run lies in one least node of the derivation and crosses the border of that node's two sides:
    each rule's border is looked at once, in one of the rule's places, and what is found there is
    carried to all places of the rule. What a grammar leaves of a sequence is halved into nodes of one
    place each. Parts of longer runs that rules near the bottom give are merged into them.
    """
    numbers = Numbering()
    coded = [[numbers[x] for x in s] for s in sequences]
    rules, sizes, places, left = re_pair(coded, len(numbers))
    joined = [x for s in coded for x in s]
    text = "".join(map(chr, joined)) if len(numbers) < 0x110000 else joined
    base = len(numbers)
    own: list[list[tuple[int, int, int]]] = []
    wanted: list[bool] = []
    for (a, b), size, p in zip(rules, sizes, places, strict=True):
        cut = p + (sizes[a - base] if a >= base else 1)
        own.append([(cut - p - i, cut - p + j, q) for i, j, q in crossing(text[p:cut], text[cut : p + size])])
        wanted.append(bool(own[-1]) or any(x >= base and wanted[x - base] for x in (a, b)))
    derived: list[list[int]] = [[] for _ in rules]
    found: set[tuple[int, int, int]] = set()
    for s, rest in zip(coded, left, strict=True):
        begin = rest[0][1] if rest else 0
        bounds = [p for _, p in rest] + [begin + len(s)]
        for x, p in rest:
            if x >= base and wanted[x - base]:
                derived[x - base].append(p)
        halves = [(0, len(rest))]
        while halves:
            low, high = halves.pop()
            if high - low < 2:
                continue
            middle = (low + high) // 2
            cut = bounds[middle]
            found.update((cut - i, cut + j, q) for i, j, q in crossing(text[bounds[low] : cut], text[cut : bounds[high]]))
            halves += [(low, middle), (middle, high)]
    for x in range(len(rules) - 1, -1, -1):
        if derived[x]:
            a, b = rules[x]
            shift = sizes[a - base] if a >= base else 1
            for p in derived[x]:
                found.update((p + i, p + j, q) for i, j, q in own[x])
            if a >= base and wanted[a - base]:
                derived[a - base] += derived[x]
            if b >= base and wanted[b - base]:
                derived[b - base] += [p + shift for p in derived[x]]
    least: dict[tuple[int, int], int] = {}
    last = (0, 0, 0)
    for q, low, high in sorted((q, low, high) for low, high, q in found):
        if last[0] == q and low + q <= last[2]:
            last = (q, last[1], max(last[2], high))
        else:
            last = (q, low, high)
        least[q, last[1]] = last[2]
    shortest: dict[tuple[int, int], int] = {}
    for (q, low), high in sorted(least.items()):
        shortest.setdefault((low, high), q)
    out: list[list[tuple[int, int, int]]] = []
    ordered, at, begin = sorted(shortest.items()), 0, 0
    for s in coded:
        part = []
        while at < len(ordered) and ordered[at][0][0] < begin + len(s):
            (low, high), q = ordered[at]
            part.append((low - begin, high - low, q))
            at += 1
        out.append(sorted(part, key=lambda r: (r[0], r[2])))
        begin += len(s)
    return out


def _documents(bodies: list[bytes]) -> Iterator[tuple[int, list, bytes]]:
    """Number of words, runs and kept words of every text."""
    numbers = Numbering()
    words = [b.split() for b in bodies]
    borders = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    flat = np.concatenate([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]) if words else np.zeros(0, np.int64)
    parts: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for low, high in fragments(flat, borders):
        parts[int(np.searchsorted(borders, low, "right")) - 1].append((low, high))
    for d, w in enumerate(words):
        runs = []
        if d in parts:
            stretches = runs_of([flat[low:high].tolist() for low, high in parts[d]])
            runs = [(low - int(borders[d]) + s, n, q) for (low, _), part in zip(parts[d], stretches, strict=True) for s, n, q in part]
            runs.sort(key=lambda r: (r[0], r[2]))
            drop = np.zeros(len(w) + 1, np.int64)
            for s, n, q in runs:
                drop[s + q] += 1
                drop[s + n] -= 1
            w = [x for x, k in zip(w, np.cumsum(drop).tolist(), strict=False) if not k]
        yield int(borders[d + 1] - borders[d]), runs, b" ".join(w)


def periodic_runs(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", batch_bytes: int = 4 << 20) -> DataFrame:
    """Runs of repeating words of every whole text, and the text without the repeats: ``doc_id, n_words, runs, collapsed``.

    Words are runs of anything but ASCII white space. ``runs`` holds ``start, length, period`` in words,
    by start and then period: stretches of six words and four periods at least whose words are equal
    to those ``period`` words on, for no shorter period, and which go no further. ``collapsed`` is the
    words outside of runs and in each run's first period, with single spaces. A null text counts as
    empty; repeated rows stay; no other columns are carried. One pass over the texts without a shuffle;
    a task holds some ``batch_bytes`` of them at a time, more only where one text is longer.
    """
    ship(documents.sparkSession)
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    columns = ["doc_id", "n_words", "runs", "collapsed"]
    shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
            edges = [0, *(np.flatnonzero(np.diff(sizes // batch_bytes)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                part = batch.slice(a, b - a)
                found = list(_documents(part.column("text").to_pylist()))
                lists = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for _, runs, _ in found], shape)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([n for n, _, _ in found], pa.int64()), lists, pa.array([x for _, _, x in found], pa.binary())], columns)

    found = rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
