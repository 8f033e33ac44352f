"""Decontamination, alignment of tokenizers and periodic runs against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from expatlas.llm import alignment, periodic_runs, positional_index
from expatlas.llm.queries import op13_periodic_runs, vocabulary_path

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_words long, segment string, n string, places string, ids string, runs string, pairs string"
PHRASE = "the quick brown fox jumps over the lazy dog near the river bank while the old miller counts his sacks of grain "
ODD = [(1, None), (2, ""), (3, "   \n\n"), (4, PHRASE * 40), (5, PHRASE * 40), (6, "12 34 !!"), (7, "one"), (None, "no id here at all, just words"), (7, "one"), (8, "x" * 70_000), (9, "été Ünï\x00日本 日本 日本 日本 日本 日本"), (10, " lead\n\nand  trail ")]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame([(i, t, "clash", "clash", 1, *["clash"] * 6) for i, t in ODD], DOCS)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOCS)


# -- positional index --------------------------------------------------------------------------------


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def phrase_hits(docs, items, window=10):
    wanted = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if w else ():
            wanted.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in wanted}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return Counter(out)


def told(df):
    return Counter((r.doc_id, r.n_words, sum(x.high - x.low for x in r.ranges), tuple(r["items"])) for r in df.collect())


@pytest.mark.parametrize(("segment", "block"), [(1 << 21, 4 << 20), (40, 60)])
def test_phrases_by_brute_force(spark, segment, block):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("a b c d e Ä the, THE f.".split()) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 12, 25]))) for i in range(14)] + [(3, "again a"), (None, "c c c c"), (77, None), (78, "a b c d e ä the the f a b c d e ä the the f")]
    docs = [(i, text(rng.randrange(0, 60)) + rng.choice(["", " " + items[rng.randrange(14)][1]])) for i in range(60)] + [(0, None), (0, items[17][1] * 3)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = positional_index.build_index(table, segment_words=segment)
    for window in (10, 3):
        assert told(positional_index.phrase_matches(index, bench, window, block_bytes=block)) == phrase_hits(docs, items, window)
    assert index.filter("term is not null").groupBy("term").sum("n").count() == len({w for _, t in docs for w in words(t)})
    places = {(r.segment, bytes(r.term)): np.cumsum(positional_index.unpack(bytes(r.places))) for r in index.filter("term is not null").collect()}
    for r in index.filter("term is null").collect():
        flat = [w for d in r["sizes"] for w in [None] * d]
        for (s, term), at in places.items():
            if s == r.segment:
                for i in at:
                    flat[i] = term.decode()
        assert None not in flat


def test_proximity_by_brute_force(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(0, 80)))) for i in range(60)]
    items = [(i, " ".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(1, 5)))) for i in range(12)]
    index = positional_index.build_index(spark.createDataFrame(docs, "doc_id long, text string"), segment_words=200)
    got = {r.doc_id: (list(r["items"]), {p for x in r.ranges for p in range(x.low, x.high)}) for r in positional_index.proximity_matches(index, spark.createDataFrame(items, "item_id long, text string"), 6).collect()}
    for doc, text in docs:
        w, found, cover = text.split(), set(), set()
        for item, query in items:
            terms = set(query.split())
            spans = [(a, b) for a in range(len(w)) for b in range(a + 1, min(len(w), a + 6) + 1) if terms <= set(w[a:b])]
            least = [(a, b) for a, b in spans if not any((c, d) != (a, b) and a <= c and d <= b for c, d in spans)]
            for a, b in least:
                found.add(str(item))
                cover.update(range(a, b))
        assert got[doc] == (sorted(found), cover)


def test_packed_places():
    rng = np.random.default_rng(1)
    values = np.concatenate([[0, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28 - 1, 2**28, 2**32 - 1], rng.integers(0, 1 << 32, 1000), rng.integers(0, 200, 1000)])
    packed, sizes = positional_index.pack(values)
    assert sizes.sum() == len(packed) and (positional_index.unpack(packed.tobytes()) == values).all()
    assert len(positional_index.unpack(b"")) == 0 and len(positional_index.pack(np.zeros(0, int))[0]) == 0


def test_contamination_edges(spark, odd, empty):
    items = spark.createDataFrame([("x", PHRASE), ("y", "one"), ("z", "日本 日本"), ("n", None), ("m", "clash clash")], "item_id string, text string")
    got = positional_index.contamination(odd, items).collect()
    assert len(got) == len(ODD)
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[(4, 880)].n_hit == 880 and by[(4, 880)]["items"] == ["x"] and by[(7, 1)]["items"] == ["y"] and sum(r["items"] == ["y"] for r in got) == 2
    assert by[(9, 8)]["items"] == ["z"] and by[(9, 8)].n_hit == 6 and not by[(1, 0)].contaminated
    assert positional_index.contamination(empty, items).count() == 0
    assert all(not r.contaminated for r in positional_index.contamination(odd, items.limit(0)).collect())


# -- alignment ---------------------------------------------------------------------------------------


def aligned(texts):
    """What the libraries give for whole texts, aligned and counted in the plainest way."""
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    symbol = {c: i for i, c in enumerate(alignment.byte_symbols())}
    out, pairs = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(symbol[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
        if not text or not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
            out.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(x) for x in part]).tolist(), range(len(part)), strict=True)) for part in (bytes_a, bytes_b)]
        groups, links, i, j = [], [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(map(str, ids_a[i:p])) + "|" + ",".join(map(str, ids_b[j:q])))
            links.append((ids_a[p - 1], ids_b[q - 1]))
            i, j = p, q
        pairs.update(links)
        out.append((len(ids_a), len(ids_b), groups, links))
    high = Counter()
    for (_, q), n in pairs.items():
        high[q] = max(high[q], n)
    rows = []
    for x in out:
        if x is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = x
            rows.append((n_a, n_b, len(groups), len(links), sum(pairs[k] == high[k[1]] for k in links), sum(pairs[k] for k in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return rows


BITS = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "word", "Été", "日本語", "😀", "<|endoftext|>", "<s>", "▁", "'s", "123", "\x00", " ", "　", "\r\n", "\x1c", "...", "don't", "_", "́", "İ", "<0x0A>", "https://x.y/z?a=1"]


@pytest.mark.parametrize("segment", [4 << 20, 300])
def test_alignment_by_brute_force(spark, segment):
    rng = random.Random(7)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(0, 25))) for _ in range(600)]
    texts += [r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").select("text").limit(20).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = alignment.align_documents(docs, vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"), segment_chars=segment).collect()
    assert [tuple(r[1:]) for r in sorted(got, key=lambda r: r.doc_id)] == aligned(texts)


def test_alignment_edges(odd, empty):
    paths = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    got = alignment.align_documents(odd, *paths).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *x) for (i, _), x in zip(ODD, aligned([t or "" for _, t in ODD]), strict=True))
    assert alignment.align_documents(empty, *paths).count() == 0 and alignment.token_links(empty, *paths).count() == 0


def test_links_are_products_of_incidence_matrices(spark):
    rng = np.random.default_rng(8)
    for _ in range(40):
        n = int(rng.integers(1, 40))
        ends = [np.unique(np.append(rng.integers(1, n + 1, size=rng.integers(1, 12)), n)) for _ in range(2)]
        dense = [np.array([[low <= x < high for x in range(n)] for low, high in zip([0, *e[:-1]], e, strict=True)], int) for e in ends]
        overlaps, together, groups_a, groups_b = alignment.align(*ends)
        product = np.zeros((len(ends[0]), len(ends[1])), int)
        product[overlaps.rows(), overlaps.columns] = overlaps.values
        assert (product == dense[0] @ dense[1].T).all()
        assert [(i, j) for i, j in zip(overlaps.rows()[together], overlaps.columns[together], strict=True)] == [(i, j) for i, a in enumerate(ends[0]) for j, b in enumerate(ends[1]) if a == b]
        shared = groups_a.transposed().times(groups_b)
        common = np.intersect1d(*ends)
        of = [np.searchsorted(common, e) for e in ends]
        assert list(zip(shared.rows().tolist(), shared.columns.tolist(), strict=True)) == [(i, j) for i, g in enumerate(of[0]) for j, h in enumerate(of[1]) if g == h]
    x, y = rng.integers(0, 3, (7, 5)), rng.integers(0, 3, (5, 6))
    sparse = [alignment.Csr(np.concatenate([[0], np.cumsum((m > 0).sum(axis=1))]), np.nonzero(m)[1], m.shape[1], m[m > 0]) for m in (x, y)]
    product, out = sparse[0].times(sparse[1]), np.zeros((7, 6), int)
    out[product.rows(), product.columns] = product.values
    assert (out == x @ y).all()
    docs = spark.createDataFrame([(1, "tokenization of läufe"), (2, None)], "doc_id long, text string")
    paths = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    found = {k: {(r.a_at, r.b_at) for r in alignment.token_links(docs, *paths, kind=k).collect()} for k in ("overlap", "together", "group")}
    assert found["together"] <= found["overlap"] <= found["group"] and found["together"]


# -- periodic runs -----------------------------------------------------------------------------------


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted([(s, e - s, q) for (s, e), q in found.items()], key=lambda r: (r[0], r[2]))


def repetitive(rng):
    k, n = rng.choice([1, 2, 2, 3, 5, 30]), rng.randrange(0, 90)
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(0, 3) if n > 3 else 0):
        a = rng.randrange(n)
        p, e = rng.randrange(1, max(2, (n - a) // 3 + 1)), rng.randrange(a, n + 1)
        w[a:e] = [w[a + (i - a) % p] for i in range(a, e)]
    return w


def test_runs_by_brute_force(spark, odd, empty):
    rng = random.Random(9)
    rows = [repetitive(rng) for _ in range(1500)]
    for w in rows:
        assert periodic_runs.runs_of([w, w[:7], []]) == [plain_runs(w), plain_runs(w[:7]), []]
    docs = [(i, " \n".join(f"w{x}" for x in w)) for i, w in enumerate(rows)] + [(i, t) for i, t in ODD]
    for size in (4 << 20, 500):
        got = periodic_runs.periodic_runs(spark.createDataFrame(docs, "doc_id long, text string"), batch_bytes=size).collect()
        want = []
        for i, t in docs:
            w = (t or "").encode().split()
            runs = plain_runs(w) if len(w) < 2000 else None
            drop = {p for s, n, q in runs for p in range(s + q, s + n)}
            want.append((i, len(w), tuple(runs), b" ".join(x for p, x in enumerate(w) if p not in drop).decode()))
        assert Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in got) == Counter(want)
    assert periodic_runs.periodic_runs(odd).count() == len(ODD) and periodic_runs.periodic_runs(empty).count() == 0


def test_grammar_gives_the_words_back():
    rng = random.Random(10)
    for _ in range(300):
        parts = [repetitive(rng) for _ in range(3)]
        rules, sizes, _, left = periodic_runs.re_pair(parts, 100)

        def spell(x, rules=rules):
            return [x] if x < 100 else spell(rules[x - 100][0]) + spell(rules[x - 100][1])

        assert [[y for x, _ in rest for y in spell(x)] for rest in left] == parts
        assert all(len(spell(100 + i)) == n for i, n in enumerate(sizes))
        pairs = Counter()
        for rest in left:
            last = None
            for a, b in zip(rest, rest[1:], strict=False):
                pair = (a[0], b[0])
                pairs[pair] += pair != last
                last = pair if pair[0] == pair[1] and pair != last else None
        assert all(n < 2 for n in pairs.values())


def test_fragments_hold_all_runs():
    rng = random.Random(11)
    for _ in range(300):
        parts = [repetitive(rng) for _ in range(4)]
        borders = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        held = periodic_runs.fragments(np.array([x for p in parts for x in p], np.int64), borders)
        for p, base in zip(parts, borders, strict=False):
            assert all(any(low <= base + s and base + s + n <= high for low, high in held) for s, n, _ in plain_runs(p))


@pytest.mark.parametrize("w", [[0] * 50_000, [i % 9_000 for i in range(50_000)], [random.Random(1).randrange(2) for _ in range(20_000)], ([0] * 500 + [1]) * 60], ids=["one", "long", "two", "nested"])
def test_long_runs_take_little_time(w):
    got = periodic_runs.runs_of([w])[0]
    assert all(w[s : s + n - q] == w[s + q : s + n] and n >= max(6, 4 * q) for s, n, q in got)
    if w[:2] == [0, 1] or len(set(w)) == 1:
        assert len(got) == 1 and got[0][1] == len(w)


def test_planted_runs_are_found(spark):
    got = op13_periodic_runs(spark, DIR).collect()
    assert len(got) == spark.read.parquet(f"{DIR}/documents.parquet").count() and sum(r.n_runs > 0 for r in got) > 3
