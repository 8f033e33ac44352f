"""Suffix sorting by induction in numpy, with queues that can lie on disk."""

from __future__ import annotations

import tempfile

import numpy as np


class Queues:
    """One queue of suffix places for each first byte; what exceeds ``memory`` bytes waits in a file of the task."""

    def __init__(self, count: int, memory: int) -> None:
        self.held: list[list] = [[] for _ in range(count)]
        self.free, self.file = memory, None

    def put(self, bucket: int, places: np.ndarray) -> None:
        if places.nbytes <= self.free:
            self.free -= places.nbytes
            self.held[bucket].append(places)
            return
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        self.held[bucket].append((self.file.tell(), len(places), places.dtype))
        self.file.write(places.tobytes())

    def take(self, bucket: int) -> list[np.ndarray]:
        out = []
        for x in self.held[bucket]:
            if isinstance(x, tuple):
                self.file.seek(x[0])
                x = np.frombuffer(self.file.read(x[1] * x[2].itemsize), x[2])
            else:
                self.free += x.nbytes
            out.append(x)
        self.held[bucket] = []
        return out


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last byte, a unique smallest one, counts as such."""
    n = len(text)
    differs = np.where(text[:-1] != text[1:], np.arange(n - 1), n)
    differs = np.minimum.accumulate(differs[::-1])[::-1]
    rising = np.ones(n, bool)
    rising[:-1] = text[differs] < text[differs + 1]
    return rising


def _groups(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys, each place's first place with the same keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _refine(name: np.ndarray, members: np.ndarray, key: np.ndarray) -> None:
    """Split classes by a further key. A name is a class's first place in the order; classes come whole."""
    order = np.lexsort((key, name[members]))
    members, key = members[order], key[order]
    old = name[members]
    name[members] = old + _groups(old, key) - _groups(old)


def sort_seeds(text: np.ndarray, rising: np.ndarray, depth: int) -> np.ndarray:
    """Places that begin a rise after a fall, in the order of their suffixes to ``depth`` bytes.

    Their substrings, up to the next such place, get names in order (seven bytes with their types at a
    time). Then the same is done with the string of names instead of the string of bytes, pairs of
    names giving names of twice the reach, until all differ or reach over ``depth`` bytes.
    """
    seeds = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    if len(seeds) < 2:
        return seeds
    reach = np.append(seeds[1:], seeds[-1]) - seeds + 1
    symbols = np.concatenate([text.astype(np.int64) * 2 + rising, np.zeros(8, np.int64)])

    def key(members: np.ndarray, r: int) -> np.ndarray:
        out = np.zeros(len(members), np.int64)
        for q in range(7):
            at = 7 * r + q
            inside = at < reach[members]
            out = (out << 9) | np.where(inside, symbols[np.minimum(seeds[members] + at, len(symbols) - 1)], 0)
        return out

    first = key(np.arange(len(seeds)), 0)
    order = np.argsort(first, kind="stable")
    name = np.empty(len(seeds), np.int64)
    name[order] = _groups(first[order])
    for r in range(1, depth // 7 + 2):
        members = np.flatnonzero(reach > 7 * r)
        if not len(members):
            break
        _refine(name, members, key(members, r))
    step = 1
    while step < depth:
        count = np.bincount(name, minlength=len(name))
        far = seeds[np.minimum(np.arange(len(seeds)) + step, len(seeds) - 1)] - seeds
        members = np.flatnonzero((count[name] > 1) & (far < depth))
        if not len(members):
            break
        after = members + step
        _refine(name, members, np.where(after < len(name), name[np.minimum(after, len(name) - 1)], -1))
        step *= 2
    return seeds[np.argsort(name, kind="stable")]


def induced_suffix_order(text: np.ndarray, depth: int = 200, memory: int = 256 << 20) -> np.ndarray:
    """All suffixes of ``text`` (bytes ending in a single 0) in order, right to ``depth`` bytes at least.

    The sorted seeds give the order of all falling suffixes: bucket by bucket, smallest first byte
    first, every suffix puts its falling predecessor into the queue of the predecessor's first byte.
    These in turn give all rising suffixes, largest first. A bucket's predecessors are dealt out all
    at once, and those that stay in the bucket form its next wave.
    """
    rising = suffix_types(text)
    seeds = sort_seeds(text, rising, depth).astype(np.int32 if len(text) < 1 << 31 else np.int64)
    bounds = np.searchsorted(text[seeds], np.arange(257))
    falling_of = []

    def deal(queues: Queues, places: np.ndarray, bucket: int, want_rising: bool) -> np.ndarray:
        before = places[places > 0] - 1
        before = before[rising[before] == want_rising]
        first = text[before]
        order = np.argsort(first, kind="stable")
        first, before = first[order], before[order]
        cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
        stay = before[:0]
        for part in np.split(before, cuts) if len(before) else []:
            byte = int(text[part[0]])
            if byte == bucket:
                stay = part
            else:
                queues.put(byte, part)
        return stay

    queues = Queues(256, memory)
    for bucket in range(256):
        waves = queues.take(bucket)
        wave = np.concatenate(waves) if waves else seeds[:0]
        whole = [wave]
        while len(wave):
            wave = deal(queues, wave, bucket, False)
            whole.append(wave)
        deal(queues, seeds[bounds[bucket] : bounds[bucket + 1]], bucket, False)
        falling_of.append(np.concatenate(whole))
    queues, rising_of = Queues(256, memory), [None] * 256
    for bucket in range(255, -1, -1):
        waves = queues.take(bucket)
        wave = np.concatenate(waves) if waves else seeds[:0]
        whole = [wave]
        while len(wave):
            wave = deal(queues, wave, bucket, True)
            whole.append(wave)
        deal(queues, falling_of[bucket][::-1], bucket, True)
        rising_of[bucket] = np.concatenate(whole)[::-1]
    rising_of[0] = np.array([len(text) - 1], seeds.dtype)
    return np.concatenate([x for pair in zip(falling_of, rising_of, strict=True) for x in pair])


def share_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int = 200) -> np.ndarray:
    """Whether the suffixes at ``a`` and ``b`` share their first ``depth`` bytes (a multiple of 8), word by word."""
    words = np.ndarray((len(text) - 7,), "<u8", np.ascontiguousarray(text), strides=(1,))
    alive = np.arange(len(a))
    for at in range(0, depth, 8):
        alive = alive[words[a[alive] + at] == words[b[alive] + at]]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def repeated_starts(pieces: list[bytes], reach: list[int], depth: int = 200, memory: int = 256 << 20) -> np.ndarray:
    """For the first ``reach`` places of each piece, one after another, whether the ``depth`` bytes there occur at another of these places.

    Each of those places has ``depth`` bytes in its piece. Bytes 254 and 255 must not occur.
    """
    sizes = np.array([len(p) + 1 for p in pieces])
    text = np.frombuffer(b"\xfe".join(pieces) + b"\xfe\xff", np.uint8) + np.uint8(1)  # 255 ends pieces, 0 ends all
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    reach_ = np.asarray(reach)
    firsts = np.concatenate([[0], np.cumsum(reach_)[:-1]])
    starts = np.repeat(begins - firsts, reach_) + np.arange(reach_.sum())
    number = np.full(len(text), -1, np.int64)
    number[starts] = np.arange(len(starts))
    order = induced_suffix_order(text, depth, memory)
    order = order[number[order] >= 0]
    same = share_prefix(text, order[:-1], order[1:], depth)
    out = np.zeros(len(starts), bool)
    out[number[order[:-1][same]]] = True
    out[number[order[1:][same]]] = True
    return out
