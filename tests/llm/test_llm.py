"""The ten operators against brute force, round trips and held-out accuracy, and their edge cases."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from expatlas.llm import embedding_dedup, encoding, language_id, line_dedup, mixing, sharding, shingle_join, simhash, suffix_dedup, suffix_sort, token_counts, topk
from expatlas.llm.queries import vocabulary_path
from expatlas.llm.vocabulary import Vocabulary

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string, spans string"
PHRASE = "the quick brown fox jumps over the lazy dog near the river bank while the old miller counts his sacks of grain "
ODD = [
    (1, None, "en", "a"), (2, "", None, None), (3, "   \n\n", "en", "a"), (4, PHRASE * 40, "en", "b"), (5, PHRASE * 40, "en", "b"), (6, "12 34 !!", "en", "a"),
    (7, "one", "fr", "c"), (None, "no id here at all, just words", "de", "b"), (7, "one", "fr", "c"), (8, "x" * 70_000, "en", "a"),
]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame([(i, t, la, s, 0, 1, "clash", "clash") for i, t, la, s in ODD], DOCS)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def test_jump_hash_moves_only_to_the_new_shard(spark, odd, empty):
    rows = spark.range(3000).select(sharding.jump_shard(F.col("id"), 16).alias("a"), sharding.jump_shard(F.col("id"), 17).alias("b")).collect()
    assert all(r.a == r.b or r.b == 16 for r in rows) and 100 < sum(r.b == 16 for r in rows) < 260
    got = sharding.shard_documents(odd).collect()
    assert len(got) == len(ODD) and sharding.shard_documents(empty).count() == 0
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))


def bit_reversed(t, bits):
    return int(f"{t:0{bits}b}"[::-1], 2)


def test_mixing_meets_targets(spark, odd, empty, docs):
    for slots in (64, 1 << 16):
        got = mixing.mix_sources(docs, slots=slots).collect()
        for source, rows in itertools.groupby(sorted(got, key=lambda r: r.source), lambda r: r.source):
            rows = list(rows)
            assert sum(r.taken for r in rows) == int(rows[0].target)
            assert all(r.taken <= 3 * r["size"] for r in rows)
            assert all((r.first_slot is None) == (r.taken == 0) for r in rows)
    assert len(mixing.mix_sources(odd).collect()) == len(ODD)
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_schedule_decides_the_slots(spark, monkeypatch):
    quotas = [500, 0, 210, 90, 3]
    targets = spark.createDataFrame([(i, q) for i, q in enumerate(quotas)], "src long, quota long")
    got = sorted((r.slot, r.src, r["rank"]) for r in mixing.block_schedule(targets, 256).collect())
    ends = np.cumsum([0, *quotas])
    want, seen = [], Counter()
    for t in range(256):
        src = max(i for i in range(5) if quotas[i] and ends[i] * 256 <= bit_reversed(t, 8) * ends[-1])
        want.append((t, src, seen[src]))
        seen[src] += 1
    want += [(256 + i, i, seen[i]) for i in range(5) if quotas[i]]
    assert got == want
    for upto in (16, 64, 200):  # every stretch of slots is mixed as the whole is
        counts = Counter(src for _, src, _ in got[:upto])
        assert all(abs(counts[i] - upto * quotas[i] / ends[-1]) <= 4 for i in range(5))

    rows = [(i, "w " * (1 + i % 9), "abc"[i % 3]) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = {r.doc_id: r.first_slot for r in mixing.mix_sources(table).collect()}
    slots = {r.doc_id: r.slots for r in mixing.mix_sources(table).collect()}
    assert all((v[0] if v else None) == first[k] and v == sorted(v) for k, v in slots.items())
    mix, times, order = [r.doc_id for r in mixing.mixed_documents(table).collect()], Counter(), []
    for k in mix:  # every repeat stands at the slot of its own pass
        order.append(slots[k][times[k]])
        times[k] += 1
    assert order == sorted(order) and max(times.values()) == 3
    assert not any(a == b for a, b in zip(mix, mix[1:], strict=False))
    taken = {r.doc_id: -(-r.taken // r["size"]) for r in mixing.mix_sources(table).collect()}
    assert Counter(r.doc_id for r in mixing.mixed_documents(table).collect()) == Counter({k: v for k, v in taken.items() if v})
    plain = mixing.block_schedule
    monkeypatch.setattr(mixing, "block_schedule", lambda t, n: plain(t, n).withColumn("slot", F.col("src") * 10**6 + F.col("rank")))
    assert {r.doc_id: r.first_slot for r in mixing.mix_sources(table).collect()} != first
    by_source = [r.source for r in mixing.mixed_documents(table).collect()]
    assert by_source == sorted(by_source) and Counter(r.doc_id for r in mixing.mixed_documents(table).collect()) == times  # the schedule alone decides the order


def test_language_held_out(docs, odd, empty):
    model = language_id.fit(docs)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = [r for r in language_id.identify(docs, model).collect() if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in got) >= 0.97 * len(got)
    found = language_id.identify(odd, model).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert all(r.lang_pred == "und" for r in found if r.doc_id in (1, 2, 3, 6))
    assert language_id.fit(empty) is None and language_id.identify(empty, None).count() == 0
    assert language_id.identify(odd, model, carry=True).columns == [*odd.columns, "_lang_pred", "_score"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        diagonal, row[0] = row[0], i
        for j in range(1, len(b) + 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (a[i - 1] != b[j - 1]))
    return row[-1]


def edited(rng, text, n):
    s = list(text)
    for _ in range(n):
        p = int(rng.integers(0, len(s) + 1))
        kind = rng.integers(3)
        if kind == 0:
            s.insert(p, "abc"[rng.integers(3)])
        elif p < len(s):
            s[p : p + 1] = [] if kind == 1 else ["abc"[rng.integers(3)]]
    return "".join(s)


def test_edit_distance_and_line_links(spark, odd, empty):
    rng = np.random.default_rng(0)
    for _ in range(4000):
        a = "".join(rng.choice(list("abc"), rng.integers(0, 14)))
        b = edited(rng, a, int(rng.integers(0, 5)))
        for most in (1, 2, 3):
            assert line_dedup.edits_within(a, b, most) == (distance(a, b) <= most)
    for a, b in (("x" * 300_000, "x" * 299_999 + "y"), ("ab" * 50_000, "ba" * 50_000)):
        assert line_dedup.edits_within(a, b, 2) and not line_dedup.edits_within(a, b[:-3] + "zzz", 2)
    kept = {(r.doc_id, r.text): r for r in line_dedup.dedup_lines(odd).collect()}
    assert kept[(1, None)]["_n_lines"] == 0 and (5, "") in kept and (3, "   \n\n") in kept
    assert line_dedup.dedup_lines(empty).count() == 0


def near(a, b):
    return distance(a, b) <= min(2, min(len(a), len(b)) // 8)


def components(items, linked):
    """Smallest place of each item's component."""
    root = list(range(len(items)))
    for a, b in itertools.combinations(range(len(items)), 2):
        if root[a] != root[b] and linked(items[a], items[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("most", [32, 1])
def test_lines_by_brute_force(spark, most):
    rng = np.random.default_rng(7)
    lines = []
    for n in [*range(1, 61, 3), 7, 8, 15, 16, 17, 23, 24, 25, 48, 60]:
        base = "".join(rng.choice(list("abc d"), n))
        lines += [base, *[edited(rng, base, int(rng.integers(1, 4))) for _ in range(5)]]
    template = "".join(rng.choice(list("abcdefgh "), 60))
    for _ in range(60):  # one place of a common line changed, in a letter or in more
        p, k = int(rng.integers(0, 55)), int(rng.choice([1, 1, 4]))
        lines.append(template[:p] + "".join(rng.choice(list("xyz"), k)) + template[p + k :])
    lines = [x.replace("\n", "") for x in lines]
    cuts = sorted({0, len(lines), *rng.integers(0, len(lines), 40).tolist()})
    docs = [(i, "\n".join(lines[a:b])) for i, (a, b) in enumerate(itertools.pairwise(cuts))]
    flat = [(i, x) for i, t in docs for x in t.split("\n")]
    kept = [(i, at) for i, t in docs for at in range(len(t.split("\n")))]
    real = [k for k in range(len(flat)) if flat[k][1].strip()]
    root = components([flat[k][1] for k in real], lambda a, b: a == b or near(a, b))
    gone = {real[k] for k in range(len(real)) if root[k] != k}
    want = {i: "\n".join(x for k, (j, x) in enumerate(flat) if j == i and k not in gone) for i, _ in docs}
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), most=most).collect()
    assert len(kept) == len(flat) and {r.doc_id: r.text for r in got} == want
    assert sum(r._n_removed for r in got) == len(gone) and sum(r._n_lines for r in got) == len(real)


def test_crowded_segment_makes_few_pairs(spark):
    rng = np.random.default_rng(8)
    shared = "".join(rng.choice(list("abcdefgh "), 50))
    lines = [shared + "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 20)) for _ in range(1200)]
    lines += [x[:60] + "#" + x[61:] for x in lines[:300]] + [x[:3] + "%" + x[3:65] + x[66:] for x in lines[:300]] + [shared + f"{i:04d}" for i in range(500)]
    table = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("hash", F.xxhash64("line"))
    assert line_dedup.candidate_pairs(table, 2, 8, 32).count() < 40 * len(lines)
    name = {r.hash: r.line for r in table.collect()}
    links = [(name[r.a], name[r.b]) for r in line_dedup.line_links(table).collect()]
    assert all(distance(a, b) <= 2 for a, b in links[:2000:7])
    root = {x: x for x in lines}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[top(a)] = top(b)
    for i in range(300):  # three versions each of 300 lines
        assert top(lines[i]) == top(lines[1200 + i]) == top(lines[1500 + i])
    assert len({top(x) for x in lines[:1200]}) == 1200 and len({top(x) for x in lines[1800:]}) == 1


HARD = ["", " ", "a  b", "a \n b\n\nc  ", "Σ ΣΑΣ İ", "x<|endoftext|> y <|startoftext|>", "\x1c a\x1fb", "don't I'LL 're", "ééé é ﬁ", "日本語 𝔘𝔫𝔦", "1234 ١٢٣ ½", "!!!...", "a" * 3000, "🤦🏽‍♂️", "a b", "<|endoftext|>"]


def test_tokens_as_the_library_gives_them(docs, odd, empty):
    from tokenizers import Tokenizer

    word, byte = vocabulary_path("word_bpe_49k.json"), vocabulary_path("byte_bpe_50k.json")
    texts = HARD + [r.text for r in docs.limit(60).collect()]
    for path, make in ((word, encoding.Encoder), (byte, token_counts.Counter)):
        with open(path, encoding="utf-8") as f:
            mine = make(Vocabulary(f.read()))
        library = Tokenizer.from_file(path)
        for t in texts:
            ids = library.encode(t, add_special_tokens=False).ids
            if path == word:
                assert np.frombuffer(mine.encode(t), "<u4").tolist() == ids
                assert mine.decode(mine.encode(t)) == library.decode(ids, skip_special_tokens=False)
            else:
                assert mine.count(t) == len(ids)
    got = encoding.encode_documents(odd, word).collect()
    assert len(got) == len(ODD) and all(len(r.ids) == r.n_tokens for r in got)
    digest = {r.doc_id: r.ids_sha256 for r in encoding.encode_documents(odd, word, digests=True).collect()}
    assert digest[1] == hashlib.sha256(b"").hexdigest()
    assert token_counts.count_tokens(odd, byte).filter("doc_id = 1").first().n_tokens == 0
    assert encoding.encode_documents(empty, word).count() == 0 and token_counts.count_tokens(empty, byte).count() == 0


def test_code_points_as_the_library_has_them():
    """All that the tables name, their neighbours, and every 13th other code point, alone and beside marks that combine."""
    from tokenizers import Tokenizer

    from expatlas.llm import vocabulary as V

    named = [c for listed in (V.NEWER_LETTERS, V.NEWER_NUMBERS, V.UNCOMBINED) for a, b in V.code_points(listed) for c in (a - 1, a, (a + b) // 2, b, b + 1)]
    points = [c for c in sorted({*named, *encoding._LOWER, *range(0x3000), *range(0x3000, 0x34000, 13)}) if not 0xD800 <= c <= 0xDFFF]
    texts = [f(chr(c)) for c in points for f in (lambda x: f"a{x}b", lambda x: f"x{x}\u0316\u0301 {x}{x}1!")]
    for name, make in (("word_bpe_49k.json", encoding.Encoder), ("byte_bpe_50k.json", token_counts.Counter)):
        with open(vocabulary_path(name), encoding="utf-8") as f:
            mine = make(Vocabulary(f.read()))
        for t, e in zip(texts, Tokenizer.from_file(vocabulary_path(name)).encode_batch(texts, add_special_tokens=False), strict=True):
            assert (np.frombuffer(mine.encode(t), "<u4").tolist() == e.ids) if name[0] == "w" else (mine.count(t) == len(e.ids)), ascii(t)


def repeats(texts, length):
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        out.append((len(t), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def test_induced_order():
    rng = np.random.default_rng(1)
    for trial in range(120):
        t = bytes(rng.choice(list(b"ab" if trial % 2 else b"abcd"), rng.integers(1, 50)).astype(np.uint8)) * (1 + trial % 3)
        text = np.frombuffer(t + b"\0", np.uint8)
        assert suffix_sort.induced_suffix_order(text, memory=40 if trial % 3 else 1 << 20).tolist() == sorted(range(len(text)), key=lambda i: bytes(text[i:]))


@pytest.mark.parametrize("limits", [{}, {"hot_pieces": 2}, {"shard_bytes": 1000}])
def test_repeated_passages(spark, docs, odd, empty, limits):
    texts = [r.text for r in docs.filter("length(text) < 3000").orderBy("doc_id").limit(60).collect()]
    texts += [texts[0] + texts[1], "start " + texts[2][:250] + " end", texts[3][:400] * 3, "ab" * 300]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r)[1:] for r in suffix_dedup.remove_repeats(table, **limits).orderBy("doc_id").collect()]
    assert got == repeats([t.encode() for t in texts], 200)
    if not limits:
        found = {r.doc_id: r for r in suffix_dedup.remove_repeats(odd, keep_bytes=True).collect()}
        assert found[4].kept == b"" and found[1].n_bytes == 0 and found[8].n_removed == 70_000
        assert suffix_dedup.remove_repeats(empty).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(300, 8)), np.repeat(rng.normal(size=(1, 8)), 40, axis=0)])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (950, [float("nan")] * 8), (None, [1.0] * 8), (1000, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = np.floor(256 * x.astype(np.float32).astype(np.float64))
    scores = v @ v.T
    for options in ({}, {"per_block": 16, "per_chunk": 3, "pivots": 5}):
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.exact_top_k(table, **options).collect())
        want = [(q, k + 1, i, int(scores[q, i])) for q in range(0, 340, 50) for k, i in enumerate(sorted((i for i in range(340) if i != q), key=lambda i: (-scores[q, i], i))[:5])]
        assert got == want
    assert topk.exact_top_k(table.filter("false")).count() == 0


def test_top_k_of_repeated_ids(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(90, 4)), 2)
    ids = [i // 3 * 25 for i in range(90)]  # three rows an id, every second id asks
    table = spark.createDataFrame([(i, [float(v) for v in r], "clash", 1) for i, r in zip(ids, x, strict=True)], "vec_id long, embedding array<double>, row string, size int")
    v = np.floor(256 * x)
    scores = v @ v.T
    want = []
    for q in range(90):
        if ids[q] % 50 == 0:
            best = sorted((i for i in range(90) if i != q), key=lambda i: (-scores[q, i], ids[i]))[:5]
            want += [(ids[q], k + 1, ids[i], int(scores[q, i])) for k, i in enumerate(best)]
    got = topk.exact_top_k(table, per_block=8, per_chunk=4, pivots=3, meet_bytes=300)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_embedding_links(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 6))
    x = np.concatenate([base + rng.normal(scale=0.25, size=base.shape) for _ in range(5)] + [np.repeat(base[:1], 30, axis=0)]).astype(np.float32)
    rows = [(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)] + [(900, None, 1), (901, [0.0] * 6, 1), (902, [float("inf")] * 6, 1), (903, [1.0] * 6, None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (np.arange(len(x))[:, None] % 2 == np.arange(len(x)) % 2)
    np.fill_diagonal(near, False)
    low = np.arange(len(x))
    for _ in range(len(x)):
        low = np.minimum(low, np.where(near, low[None, :], len(x)).min(axis=1))
    for per_block in (16, 1024):
        got = {r.vec_id: r for r in embedding_dedup.embedding_duplicates(table, per_block=per_block).collect()}
        assert len(got) == len(rows) and all(got[i].n_links == 0 and got[i].kept for i in range(900, 904))
        assert all((got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), low[i], low[i] == i) for i in range(len(x)))
    assert embedding_dedup.embedding_duplicates(table.filter("false")).count() == 0


def test_axes_tell_apart_what_shares_a_direction(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(800, 8)) * np.array([1, 1, 1, 0.1, 0.1, 0.1, 0.1, 0.1]) * 0.3 + np.r_[np.zeros(7), 3.0]
    nodes = spark.createDataFrame([(i, 1, "a", [float(v) for v in r]) for i, r in enumerate(x)], "node long, copies long, label string, vector array<double>")
    blocks = embedding_dedup.grid_blocks(nodes, 0.9995, per_block=20)
    n = blocks.count()
    side = 0.0316
    rows = blocks.select("low", "high").collect()
    near = sum(sum(max(0, a.low[k] - b.high[k], b.low[k] - a.high[k]) ** 2 for k in range(6)) <= side**2 for a in rows for b in rows)
    assert near < 0.7 * n * n


def slow_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_by_brute_force(spark, docs):
    texts = [r.text for r in docs.orderBy("doc_id").limit(80).collect()] + ["", None, "A b", "a B", "one two three four " * 30_000, "\u2003x\u00a0y z", "x\x1cy \x0b z"]
    texts += [t[:-3] + "zzz" for t in texts[:40] if t]
    fps = [slow_fingerprint(t or "") for t in texts]
    root = components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.near_duplicates(table).select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fp"), "component_id").collect()}
    assert all((got[i].fp, got[i].component_id) == (f"{fps[i]:016x}", root[i]) for i in range(len(texts)))
    kept = [r.doc_id for r in simhash.keep_one(table).collect()]
    assert sorted(kept) == sorted(set(root))


def test_language_of_many_families(spark):
    rng = np.random.default_rng(11)
    langs = ["en", "de", "fr", "es", "ru", "pl", "fi", "hu", "tr", "xx"]
    words = {la: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 8))) for _ in range(60)] for la in langs}
    rows = [(i, " ".join(rng.choice(words[la], 60)), la) for i, la in enumerate(langs * 40)] + [(9000, "lone example of its own class here", "zz")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(table, language_id.fit(table)).collect()}
    held = [i for i, _, _ in rows[:-1] if got[i].held_out]
    assert sum(got[i].lang_pred == rows[i][2] for i in held) >= 0.95 * len(held) and len(held) > 60
    single = table.filter("lang = 'en'")
    assert {r.lang_pred for r in language_id.identify(single, language_id.fit(single)).collect()} == {"en"}


@pytest.mark.parametrize("segments", [8, 16])
def test_hamming_links(spark, segments):
    rng = np.random.default_rng(4)
    base = rng.integers(-(2**63), 2**63 - 1, 60)
    flips = np.array([sum((1 << int(b)) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for _ in range(240)], np.uint64)
    fps = sorted({int(v) for v in np.concatenate([base, (np.tile(base, 4).view(np.uint64) ^ flips).view(np.int64)])} | {0, 1, 3, -1})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = sorted((min(r.a, r.b), max(r.a, r.b)) for r in simhash.hamming_links(nodes, segments).collect())
    assert got == [(a, b) for a, b in itertools.combinations(fps, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 2]


def test_simhash_edges(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD) and {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert [r.component_id for r in got if r.doc_id == 5] == [4]
    kept = [r.doc_id for r in simhash.keep_one(odd).collect()]
    assert sorted(kept, key=str) == sorted([1, 4, 6, 7, 8, None], key=str)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("at_once", [0, 10_000])
def test_long_chains(spark, at_once):
    from expatlas.llm.components import connected_components

    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long"), at_once).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[200] == got[150] == got[100] == 100
    assert connected_components(spark.createDataFrame([], "a long, b long"), at_once).count() == 0


def test_pipeline(spark, odd, empty):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, odd, empty):
            assert stage(spark, table, DIR).columns == table.columns, name
    first = corpus_pipeline.language_id(spark, docs, DIR)
    assert first.count() >= 0.98 * docs.count()
    rows = corpus_pipeline.run(spark, DIR)
    assert rows.count() > 0 and rows.filter("size(ids) <> n_tokens").count() == 0


def test_pipeline_stages_by_brute_force(spark):
    """Each stage on what the one before it kept, against a plain computation."""
    from tokenizers import Tokenizer

    import corpus_pipeline
    from expatlas.llm import shingle_join

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{DIR}/documents.parquet").orderBy("doc_id").limit(90)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    known = stages["language_id"](spark, docs, DIR)
    assert {r.doc_id for r in known.collect()} == {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}

    rows = sorted(known.collect(), key=lambda r: r.doc_id)
    flat = [(k, x) for k, r in enumerate(rows) for x in r.text.split("\n")]
    names = sorted({x for _, x in flat if x.strip()}, key=[x for _, x in flat].index)
    letters = np.array([np.bincount([ord(c) % 64 for c in x], minlength=64) for x in names])

    def close(i, j):
        return np.abs(letters[i] - letters[j]).sum() <= 4 and near(names[i], names[j])

    root = components(range(len(names)), close)
    seen, want = set(), {}
    for k, r in enumerate(rows):
        kept = []
        for x in r.text.split("\n"):
            name = root[names.index(x)] if x.strip() else None
            if name is None or name not in seen:
                kept.append(x)
            if name is not None:
                seen.add(name)
        if any(x.strip() for x in kept):
            want[r.doc_id] = "\n".join(kept)
    lines = stages["line_dedup"](spark, known, DIR)
    assert {r.doc_id: r.text for r in lines.collect()} == want

    rows = sorted(lines.collect(), key=lambda r: r.doc_id)
    sets = [set(shingle_join.shingle_set(r.text, 5).tolist()) for r in rows]
    root = components(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    single = stages["simhash"](spark, lines, DIR)
    assert sorted(r.doc_id for r in single.collect()) == [r.doc_id for k, r in enumerate(rows) if root[k] == k]

    mixed = stages["mixing"](spark, single, DIR)
    taken = {r.doc_id: -(-r.taken // r["size"]) for r in mixing.mix_sources(single).collect() if r.taken}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(taken)

    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in mixed.collect()}
    out = stages["bpe"](spark, mixed, DIR).collect()
    assert len(out) == sum(taken.values())
    for r in out:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.decoded == library.decode(r.ids, skip_special_tokens=False)


def _changed(text, rng, share):
    return " ".join(w if rng.random() > share else f"new{rng.integers(10**6)}" for w in text.split())


@pytest.mark.parametrize("often", [64, 2])
def test_stage_drops_near_copies_by_jaccard(spark, monkeypatch, often):
    import corpus_pipeline
    from expatlas.llm import shingle_join

    monkeypatch.setattr(shingle_join, "OFTEN", often)
    monkeypatch.setattr(shingle_join, "SAMPLE", 1)
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(12):
        base = " ".join(f"w{x}" for x in rng.integers(0, 400, rng.integers(3, 300)))
        texts += [base, base.upper(), *[_changed(base, rng, share) for share in (0.01, 0.02, 0.03, 0.05, 0.1) for _ in range(3)]]
    texts += ["a b c", "A  b c", "a b", None, "", "  "]
    sets = [set(shingle_join.shingle_set(t or "", 5).tolist()) for t in texts]
    root = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    docs = spark.createDataFrame([(i, t, "en", "a", 0, 1, "", "") for i, t in enumerate(texts)], DOCS)
    got = sorted(r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, DIR).collect())
    assert got == sorted(set(root))


def test_similar_prefixes_meet():
    from expatlas.llm import shingle_join

    rng = np.random.default_rng(6)
    for n in (1, 4, 5, 9, 10, 50, 333):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.sort(np.concatenate([a[rng.permutation(n)[: -(-8 * n // 10)]]]))
        last = np.sort(a[: n // 3])
        for order in (last, last[:0]):
            assert set(shingle_join.prefix(a, 0.8, order).tolist()) & set(shingle_join.prefix(b, 0.8, order).tolist())


def test_family_of_similar_texts_meets_in_blocks(spark):
    """Two thousand texts, most pairs of which are similar by 0.5 to 0.95, link as all pairs do, whatever the blocks."""
    rng = np.random.default_rng(12)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(400):
        share = rng.choice([0.005, 0.02, 0.05])
        texts.append((i, " ".join(w if rng.random() > share else f"n{rng.integers(10**6)}" for w in base)))
    texts += [(400 + i, " ".join(f"u{i}.{j}" for j in range(40))) for i in range(40)]
    sets = [set(shingle_join.shingle_set(t, 5).tolist()) for _, t in texts]
    root = components(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for options in ({}, {"crowd": 2, "per_block": 7}, {"crowd": 2, "block_bytes": 5000}):
        found = {r.doc_id: r.component for r in shingle_join.similar_documents(docs, **options).collect()}
        groups, want = {}, {}
        for i, _ in texts:
            groups.setdefault(found[i], set()).add(i)
            want.setdefault(root[i], set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_overlaps_of_sets():
    rng = np.random.default_rng(13)
    for _ in range(20):
        sets = [[np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(n)] for n in (5, 7)]
        got = shingle_join.overlaps(*sets, stretch=int(rng.integers(1, 50)))
        assert (got == [[len(np.intersect1d(a, b)) for b in sets[1]] for a in sets[0]]).all()


def test_top_k_of_equal_vectors(spark):
    rng = np.random.default_rng(14)
    values = rng.normal(size=(6, 8))
    rows = [(i, values[0 if i % 3 else i % 6].tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = np.floor(256 * np.array([r[1] for r in rows]))
    scores = (v @ v.T).astype(int)
    got = {}
    for r in topk.exact_top_k(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in range(0, 900, 50):
        want = sorted((-scores[q, j], j) for j in range(900) if j != q)[:5]
        assert sorted(got[q]) == [(k + 1, j, -s) for k, (s, j) in enumerate(want)]
    assert len(got) == 18


def test_lines_of_other_letters_are_no_candidates(spark):
    """Every pair within two edits stays a candidate; lines that share a segment and little else are none."""
    rng = np.random.default_rng(21)
    letters = list("abcdefghij \u00e9\u4e2d\U0001f600")
    lines = []
    for _ in range(30):
        base = "".join(rng.choice(letters, 40))
        lines.append(base)
        for _ in range(4):
            x = list(base)
            for _ in range(rng.integers(1, 3)):
                i = int(rng.integers(len(x)))
                x[i : i + 1] = [[], [str(rng.choice(letters))], [x[i], str(rng.choice(letters))]][rng.integers(3)]
            lines.append("".join(x))
    start = "".join(rng.choice(letters, 20))
    apart = [start + "".join(rng.choice(list("klmnopqrstuvwxyz"), 20)) for _ in range(20)]
    names = sorted({*lines, *apart})
    df = spark.createDataFrame(list(enumerate(names)), "hash long, line string")
    got = {(r.a, r.b) for r in line_dedup.candidate_pairs(df, 2, 8, 32).collect()}
    within = {(i, j) for i, j in itertools.combinations(range(len(names)), 2) if line_dedup.edits_within(names[i], names[j], 2)}
    assert within and within <= got
    far = [names.index(x) for x in apart]
    assert len([p for p in got if set(p) <= set(far)]) < 40  # of 190 that share a segment


def test_crowds_of_other_letters_make_no_pairs(spark):
    """Lines of one long frame, in which each of five words is one of a few, crowd every segment; only those within two edits meet."""
    from expatlas.llm import edit_stars

    rng = np.random.default_rng(22)
    words = ["abcdefg", "hijklmn", "opqrstu", "vwxyzab", "cegikmo", "dfhjlnp"]
    frame = [f"{i}{'-' * 12}" for i in range(5)]
    names = sorted({"".join(f + str(rng.choice(words)) for f in frame) for _ in range(150)})
    names = sorted({*names, *(x[:-1] + "!" for x in names[:40])})
    df = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(names)], "hash long, line string, n int")
    got = {(r.a, r.b) for r in edit_stars.crowd_pairs(df, lambda n: line_dedup.allowed(n, 2, 8), 2, 8).collect()}
    within = {(i, j) for i, j in itertools.combinations(range(len(names)), 2) if line_dedup.edits_within(names[i], names[j], 2)}
    assert within
    assert components(range(len(names)), lambda i, j: (i, j) in got and (i, j) in within) == components(range(len(names)), lambda i, j: (i, j) in within)
    far = [(i, j) for i, j in got if (i, j) not in within]
    odd = edit_stars.letter_parities(pa.array(names)).to_pylist()
    assert not [p for p in far if ((odd[p[0]] ^ odd[p[1]]) & 0xFFFFFFFF).bit_count() > 4]


def test_documents_without_near_copies_are_not_shuffled(spark):
    """Documents that are alone in their component are a branch of their own beside the join; what is kept stays the same."""
    base = " ".join(f"w{i}" for i in range(60))
    texts = [(i, " ".join(f"u{i}.{j}" for j in range(30))) for i in range(40)] + [(50, base), (51, base + " end"), (51, base + " end"), (40, base), (None, base), (60, None), (61, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kept = simhash.keep_one(docs, 5, 0.8)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(41), 60]
    assert str(kept._jdf.queryExecution().optimizedPlan()).startswith("Union")


def test_smaller_sets_share_an_early_element():
    from math import ceil

    from expatlas.llm import shingle_join

    rng = np.random.default_rng(23)
    for n in (1, 4, 5, 9, 10, 50, 333):
        for _ in range(20):
            both = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            more = np.unique(rng.integers(0, 2**63, n // 4).astype(np.uint64))
            cut = int(rng.integers(0, len(more) + 1))
            a, b = sorted((np.union1d(both, more[:cut]), np.union1d(both, more[cut:])), key=len)
            if n >= 0.8 * len(np.union1d(a, b)):
                early = a[: len(a) - ceil(1.6 / 1.8 * len(a) - 1e-9) + 1]
                assert set(early.tolist()) & set(shingle_join.prefix(b, 0.8, a[:0]).tolist())


def test_keys_of_a_batch_come_in_small_frames():
    import pandas as pd

    from expatlas.llm import edit_stars

    batch = pd.DataFrame({"x": range(3000)})
    frames = list(edit_stars._each(lambda r: [(r.x, i) for i in range(50)], "x i")(iter([batch, batch.head(0)])))
    assert max(map(len, frames)) <= 20_050
    assert pd.concat(frames).reset_index(drop=True).equals(pd.DataFrame([(x, i) for x in range(3000) for i in range(50)], columns=["x", "i"]))


def test_rarer_shingles_stand_first(spark):
    """What many sets share stands behind what few share, so that prefixes seldom meet by it."""
    from expatlas.llm import shingle_join

    hashes, last = np.arange(1, 11, dtype=np.uint64), np.array([1, 2, 3, 9], np.uint64)
    assert shingle_join.prefix(hashes, 0.1, last, np.array([5, 2, 9, 3])).tolist() == [4, 5, 6, 7, 8, 10, 2, 9, 1, 3]
    common = " ".join(f"c{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"{common} " + " ".join(f"u{i}.{j}" for j in range(12))) for i in range(400)], "doc_id long, text string")
    last = shingle_join._often(docs, 5, "doc_id", "text")
    seen = shingle_join._sketches(docs, 5, 0.8, last, "doc_id", "text").selectExpr("explode(prefix) h").groupBy("h").count()
    assert len(last[0]) >= 36 and seen.filter("count > 1").count() == 0


def test_pairs_of_blocks_are_not_shuffled(spark):
    from expatlas.llm import shingle_join

    rng = np.random.default_rng(24)
    sets = [np.unique(rng.integers(0, 40, 30)).astype(np.uint64) for _ in range(60)]
    rows = [(10 * b, [10 * b + i for i in range(10)], [len(x) for x in sets[10 * b : 10 * b + 10]], b"".join(x.tobytes() for x in sets[10 * b : 10 * b + 10])) for b in range(6)]
    blocks = spark.createDataFrame(rows, "block bigint, nodes array<bigint>, sizes array<bigint>, items binary")
    pairs = spark.createDataFrame([(a, b) for a in range(0, 60, 10) for b in range(a + 10, 60, 10)], "block_a bigint, block_b bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = [shingle_join._block_links(blocks, 0.6), shingle_join._block_links(blocks, 0.6, pairs)]
        plan = found[1]._jdf.queryExecution().sparkPlan().toString()
        assert "CartesianProduct" in plan and "SortMergeJoin" not in plan
        links = {(r.a, r.b) for df in found for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert components(range(60), lambda i, j: (i, j) in links or (j, i) in links) == components(sets, lambda a, b: len(np.intersect1d(a, b)) >= 0.6 * len(np.union1d(a, b)))


def test_sets_of_a_batch_are_made_a_few_at_a_time():
    import pyarrow as pa

    from expatlas.llm import shingle_join

    batch = pa.RecordBatch.from_arrays([pa.array(range(1000))], ["x"])
    parts = list(shingle_join._few(iter([batch, batch.slice(0, 0), batch.slice(0, 3)])))
    assert max(p.num_rows for p in parts) <= 256 and [x for p in parts for x in p.column("x").to_pylist()] == [*range(1000), *range(3)]
