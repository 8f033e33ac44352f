"""Queries of the operators over the whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from expatlas.llm.alignment import align_documents
from expatlas.llm.common import WORD
from expatlas.llm.embedding_dedup import embedding_duplicates
from expatlas.llm.encoding import encode_documents
from expatlas.llm.language_id import fit, identify
from expatlas.llm.line_dedup import dedup_lines
from expatlas.llm.mixing import mix_sources
from expatlas.llm.periodic_runs import periodic_runs
from expatlas.llm.positional_index import contamination
from expatlas.llm.sharding import shard_documents
from expatlas.llm.simhash import fingerprint_text, near_duplicates
from expatlas.llm.suffix_dedup import remove_repeats
from expatlas.llm.token_counts import count_tokens
from expatlas.llm.topk import exact_top_k
from expatlas.scratch import table


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when the sources are mixed 5 : 2 : 1, and the slot it first comes in."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of 200 bytes that occur elsewhere."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 16, and of 17, by jump consistent hashing."""
    return shard_documents(table(spark, sf_dir, "documents"), 16)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    documents = table(spark, sf_dir, "documents")
    return identify(documents, fit(documents))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many repeat earlier lines within two edits, and what is kept."""
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    return encode_documents(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), digests=True)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest rows, by integer inner product, of every fiftieth vector."""
    return exact_top_k(table(spark, sf_dir, "embeddings"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors at cosine 0.93 within their labels."""
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprint_text(found["fp"]).alias("fingerprint"), "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of ten words of benchmark items, and those items."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), ids.alias("items_sha256"), "contaminated")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers fit together in every document."""
    return align_documents(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """A tenth of the documents, by the CRC of their ids, repeat a stretch of theirs up to the end."""
    words, h = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)), F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    a = F.pmod(g, F.greatest(F.size("_w"), F.lit(1)))
    p = 1 + F.floor((F.size("_w") - F.col("_a")) / (3 + F.pmod(g, F.lit(8))))
    moved = F.transform("_w", lambda x, i: F.when(i < F.col("_a"), x).otherwise(F.get("_w", (F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p"))).cast("int"))))
    planted = documents.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_w")).withColumn("_a", a).withColumn("_p", p)
    return planted.select("doc_id", F.when(F.size("_w") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some of them planted, and what is left without the repeats."""
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.floor(F.lit(1000) * F.col("_b.length") / -F.col("_b.period")).cast("long")
    return rows.select("doc_id", "n_runs", (-F.col("_b.start")).alias("start"), F.col("_b.length").alias("length"), (-F.col("_b.period")).alias("period"), exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_bpe": op4_bpe,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sharding": op6_sharding,
    "op7_topk": op7_topk,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_simhash": op9_simhash,
    "op10_token_counts": op10_token_counts,
    "op11_decontamination": op11_decontamination,
    "op12_alignment": op12_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op11_decontamination": r"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        c AS (SELECT item, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS g FROM c),
        sizes AS (SELECT DISTINCT l FROM windows),
        e AS (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, sizes WHERE len(w) >= l),
        met AS (SELECT r, i, e.l, item FROM e JOIN windows ON windows.l = e.l AND windows.g = array_to_string(w[i:i + e.l - 1], ' ')),
        hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS p FROM met) GROUP BY r),
        items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)""",
    "op13_periodic_runs": r"""
        WITH RECURSIVE crc AS (SELECT i, 0 AS r, CAST(i AS BIGINT) AS c FROM range(256) t(i)
            UNION ALL SELECT i, r + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE r < 8),
        crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE r = 8),
        d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                     xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda x: CAST('0x' || x AS BIGINT)), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295)) AS h
              FROM documents, crc_table),
        e AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM d),
        f AS (SELECT *, 1 + (len(w) - a) // (3 + (coalesce(h, 0) // 10) % 8) AS p FROM e),
        words AS (SELECT r, i, CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END AS x FROM (SELECT r, w, a, p, unnest(range(len(w))) AS i FROM f)),
        same AS (SELECT u.r, u.i, v.i - u.i AS q FROM words u JOIN words v ON u.r = v.r AND u.x = v.x AND u.i < v.i),
        stretches AS (SELECT r, q, min(i) AS s, count(*) + q AS n FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM same) GROUP BY r, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
        runs AS (SELECT r, s, n, min(q) AS q FROM stretches GROUP BY r, s, n),
        told AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines, min((-n, s, q)) AS best FROM runs GROUP BY r),
        dropped AS (SELECT DISTINCT r, unnest(range(s + q, s + n)) AS i FROM runs),
        kept AS (SELECT words.r, string_agg(x, ' ' ORDER BY words.i) AS t FROM words ANTI JOIN dropped ON words.r = dropped.r AND words.i = dropped.i GROUP BY words.r)
        SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best[2] AS BIGINT) AS start, CAST(-best[1] AS BIGINT) AS length, CAST(best[3] AS BIGINT) AS period,
               CAST(1000 * -best[1] // best[3] AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
        FROM f LEFT JOIN told USING (r) LEFT JOIN kept USING (r)""",
    "op7_topk": """
        WITH v AS (SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(256.0::DOUBLE * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.n, q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score FROM v q JOIN v x ON q.n <> x.n AND len(q.v) = len(x.v) WHERE q.vec_id % 50 = 0),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 5""",
    "op8_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        n AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS u FROM v),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_inner_product(a.u, b.u) >= 0.93),
        r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS low FROM r GROUP BY a),
        k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(c.low, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(c.low, vec_id)) AS kept
        FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN k ON k.a = vec_id""",
    "op1_mixing": r"""
        WITH d AS (SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM s),
        w AS (SELECT *, CASE src % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM n),
        l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                     / CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM w),
        t AS (SELECT source, src, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM l),
        q AS (SELECT *, CAST(floor(target) AS BIGINT) AS quota FROM t),
        e AS (SELECT source, src, quota, coalesce(sum(quota) OVER (ORDER BY src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(quota) OVER () AS total FROM q),
        g AS (SELECT source, src, CAST((before * 65536 + total - 1) // total AS BIGINT) AS first, CAST(((before + quota) * 65536 + total - 1) // total AS BIGINT) AS stop FROM e WHERE quota > 0),
        points AS (SELECT source, unnest(range(first, stop)) AS point FROM g),
        slots AS (SELECT source, CAST(list_sum(list_transform(range(16), lambda i: ((point >> i) & 1) << (15 - i))) AS BIGINT) AS slot FROM points),
        ranks AS (SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank FROM slots UNION ALL SELECT source, src + 65536, stop - first FROM g),
        p AS (SELECT d.doc_id, d.source, d.size, q.source_size, q.target, q.quota, greatest(1, CAST(((SELECT sum(quota) FROM q) + 65535) // 65536 AS BIGINT)) AS block,
                     coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.size), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
              FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
        amounts AS (SELECT *, CAST(CASE WHEN size = 0 THEN 0 ELSE size * (quota // source_size) + greatest(0, least(size, quota % source_size - start)) END AS BIGINT) AS taken FROM p),
        b AS (SELECT amounts.*, row_number() OVER () AS n FROM amounts),
        spans AS (SELECT n, source, block, pass * source_size + start AS low, least(pass * source_size + start + size, quota) AS high FROM b, range(3) r(pass) WHERE size > 0 AND pass * source_size + start < quota),
        firsts AS (SELECT n, min(slot) AS first_slot FROM (SELECT n, source, unnest(range(CAST(low // block AS BIGINT), CAST((high - 1) // block AS BIGINT) + 1)) AS rank FROM spans) x JOIN ranks ON ranks.source IS NOT DISTINCT FROM x.source AND ranks.rank = x.rank GROUP BY n)
        SELECT doc_id, size, source_size, target, taken, first_slot FROM b LEFT JOIN firsts USING (n)""",
    "op6_sharding": r"""
        WITH RECURSIVE n AS (SELECT unnest([16, 17]) AS n),
        keys AS (SELECT DISTINCT coalesce(doc_id, 0) AS key FROM documents),
        jump AS (
            SELECT key, n, CASE WHEN key < 0 THEN CAST(key AS HUGEINT) + 18446744073709551616 ELSE CAST(key AS HUGEINT) END AS k, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j FROM keys, n
            UNION ALL
            SELECT key, n, k2, j, CAST(floor(CAST(j + 1 AS DOUBLE) * (2147483648.0::DOUBLE / CAST(k2 // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
            FROM (SELECT key, n, j, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS k2 FROM jump WHERE j < n)),
        shard AS (SELECT key, n, max(b) AS shard FROM jump GROUP BY key, n),
        crc AS (SELECT i, 0 AS r, CAST(i AS BIGINT) AS c FROM range(256) t(i)
            UNION ALL SELECT i, r + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE r < 8),
        crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE r = 8),
        d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
                     xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)),
                         lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295)) AS text_crc32
              FROM documents, crc_table)
        SELECT d.doc_id, d.size, d.text_crc32, 'key' AS law, CAST(a.shard AS INTEGER) AS shard,
               row_number() OVER (PARTITION BY a.shard ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.size, d.text_crc32) - 1 AS slot,
               CAST(g.shard AS INTEGER) AS grown_shard
        FROM d JOIN shard a ON a.key = coalesce(d.doc_id, 0) AND a.n = 16 JOIN shard g ON g.key = coalesce(d.doc_id, 0) AND g.n = 17""",
}
