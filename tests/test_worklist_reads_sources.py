"""Work-list algebra, reads, report scans and incremental ingest."""

import pytest
from pyspark.sql import functions as F

from expatlas.operators import reads as Q
from expatlas.operators import relational as R
from expatlas.sources import reports as S

BRIDGE = [("SRX1006261", s) for s in ("SRR1989213", "SRR1990132", "SRR1990908", "SRR1991445")] + [
    ("SRX1483043", "SRR3001912"), ("DRX000774", "DRR001177"), ("DRX000775", "DRR001178"), ("DRX000998", "DRR001444"), ("SRX262875", "SRR823324"), ("SRX262877", "SRR823326"),
]


@pytest.fixture()
def bridge(spark):
    return spark.createDataFrame(BRIDGE, "group_id string, item_id string")


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def test_work_list(spark, bridge):
    assert R.work_list(bridge).count() == 10
    groups, items = ids(spark, "DRX000774", "DRX000775", "DRX000998"), ids(spark, "DRR001177", "DRR001178", "DRR001444")
    for three in (groups, items):
        assert R.work_list(bridge, targets=three).count() == 3
        assert R.work_list(bridge, problems=three).count() == 7
        assert R.work_list(bridge, subset=three).count() == 3
    two = R.work_list(bridge, targets=ids(spark, "DRX000774", "DRX000775", "SRX1006261"), size=2)
    assert sorted(r.item_id for r in two.collect()) == ["DRR001177", "DRR001178"]


def test_partners(spark, bridge):
    found = {r.group_id: r.partners for r in R.partners(bridge, "group_id", "item_id").collect()}
    assert found["DRX000774"] == ["DRR001177"] and len(found["SRX1006261"]) == 4


def reads(spark, rows):
    return spark.createDataFrame(rows, "item_id string, mate int, read_no long, h1 string, seq string, h2 string, qual string")


def test_reads(spark):
    rows = [("a", 1, i, f"@a.{i}", "ACGT", "+", "IIII") for i in range(10)]
    bad = [("b", 1, 0, "@b.0", "ACGT", "+", "IIII"), ("b", 1, 1, "@b.1", "ACGT", "+", None), ("b", 1, 2, "@b.2", "ACGT", "+", "IIIII"), ("b", 1, 3, "@b.3", "AC\x01T", "+", "IIII")]
    got = {r.item_id: r for r in Q.read_summary(reads(spark, rows + bad)).collect()}
    assert got["a"].libsize == 10 and got["a"].avgLen_R1 == 4.0
    assert (got["b"].libsize, got["b"].incomplete, got["b"].unequal, got["b"].bad_encoding) == (1, 1, 1, 1)
    pair = rows + [("a", 2, i, f"@a.{i}", "ACG", "+", "III") for i in range(10)]
    assert Q.layout(reads(spark, pair)).first().layout == "PE"
    assert Q.layout(reads(spark, pair[:-1])).first().layout == "keep_R1"
    flags = Q.item_flags(reads(spark, [("c", 1, 0, "@c", "T1202", "+", "IIIII")])).first()
    assert flags.color_space and not flags.empty


def test_reports(spark, tmp_path):
    (tmp_path / "SRR1.align.txt").write_text("100 reads; of these:\n  100 (100.00%) were unpaired; of these:\n    10 (10.00%) aligned 0 times\n    80 (80.00%) aligned exactly 1 time\n    10 (10.00%) aligned >1 times\n90.00% overall alignment rate\n")
    r = S.ingest_align(spark, str(tmp_path / "*.align.txt")).first()
    assert (r.sample, r.num_reads, r.num_uniquely_aligned, r.per_alignment, r.num_reads_paired) == ("SRR1", 100, 80, 90, None)
    (tmp_path / "SRR2.screen.txt").write_text("#version\nGenome\t" + "\t".join(["x"] * 11) + "\ndm6\t100\t3\t3.0\t90\t90.0\t2\t2.0\t3\t3.0\t2\t2.0\n\n%Hit_no_genomes: 1.0\n")
    r = S.ingest_screen(spark, str(tmp_path / "*.screen.txt")).first()
    assert (r.sample, r.reference, r.reads_processed_count, r.one_hit_one_library_percent) == ("SRR2", "dm6", 100, 90.0)
    (tmp_path / "SRR3.metrics.txt").write_text("## METRICS CLASS\tx\nPF_BASES\tPCT\n12\t?\n\nnormalized_position\tAll\n0\t0.5\n1\t0.7\n")
    r = S.ingest_metrics_block(spark, str(tmp_path / "*.metrics.txt"), "PF_BASES", "PF_BASES BIGINT, PCT DOUBLE").first()
    assert (r.sample, r.PF_BASES, r.PCT) == ("SRR3", 12, None)
    assert [x.coverage for x in S.ingest_histogram(spark, str(tmp_path / "*.metrics.txt")).orderBy("position").collect()] == [0.5, 0.7]
    (tmp_path / "SRX9.counts.tsv").write_text("#c\nGene\tChr\tx.bam\nFBgn1\t2L\t5\nFBgn2\t2L\t0\n")
    assert sorted((x.sample, x.feature_id, x["count"]) for x in S.read_counts(spark, str(tmp_path / "*.counts.tsv")).collect()) == [("SRX9", "FBgn1", 5), ("SRX9", "FBgn2", 0)]
    (tmp_path / "f.gtf").write_text('#x\n2L\tsrc\texon\t1\t10\t.\t+\t.\tgene_id "FBgn1"; gene_symbol "a";\n')
    r = S.read_features(spark, str(tmp_path / "f.gtf")).first()
    assert (r.chrom, r.start, r.stop, r.attrs["gene_id"]) == ("2L", 1, 10, ["FBgn1"])
    (tmp_path / "SRR7_1.fastq").write_text("@a\nACGT\n+\nIIII\n@b\nAC\n+\nII\n")
    assert sorted((x.read_no, x.seq, x.qual) for x in S.read_reads(spark, str(tmp_path / "*.fastq")).collect()) == [(0, "ACGT", "IIII"), (1, "AC", "II")]


def test_increment(spark, tmp_path):
    from expatlas.streaming.increment import stream_counts

    folder, sink, state = tmp_path / "in", str(tmp_path / "sink"), str(tmp_path / "state")
    folder.mkdir()
    (folder / "SRX1.tsv").write_text("g1\t1\ng2\t2\n")
    stream_counts(spark, str(folder), sink, state).awaitTermination()
    (folder / "SRX1.again.tsv").write_text("g1\t7\n")
    (folder / "SRX2.tsv").write_text("g1\t3\n")
    stream_counts(spark, str(folder), sink, state).awaitTermination()
    assert sorted((r.sample, r.feature_id, r["count"]) for r in spark.read.parquet(sink).collect()) == [("SRX1", "g1", 1), ("SRX1", "g2", 2), ("SRX2", "g1", 3)]


def test_batches_read_their_own_files_only(spark, tmp_path):
    """Keys seen are state of the stream: what a batch reads does not grow with what is stored."""
    from expatlas.streaming.increment import stream_counts, stream_metrics

    folder, sink, state = tmp_path / "in", str(tmp_path / "sink"), str(tmp_path / "state")
    folder.mkdir()
    for round_ in range(3):
        for i in range(4):
            (folder / f"SRX{round_ * 2 + i}.{round_}.tsv").write_text(f"# head\ng1\t{round_}\r\ng2\tx\n")
        query = stream_counts(spark, str(folder), sink, state)
        query.awaitTermination()
        assert sum(p["numInputRows"] for p in query.recentProgress) == 4
    got = sorted((r.sample, r["count"]) for r in spark.read.parquet(sink).collect())
    assert got == [("SRX0", 0), ("SRX1", 0), ("SRX2", 0), ("SRX3", 0), ("SRX4", 1), ("SRX5", 1), ("SRX6", 2), ("SRX7", 2)]

    metrics, done = tmp_path / "metrics", spark.createDataFrame([("a",), ("b",)], "srr string")
    for i, rows in enumerate(([("a", 1), ("a", 1), ("c", 5)], [("a", 2), ("b", 3)])):
        spark.createDataFrame(rows, "srr string, n long").coalesce(1).write.mode("append").parquet(str(metrics))
        stream_metrics(spark, str(metrics), "srr string, n long", f"{sink}.m", f"{state}.m", done=done).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{sink}.m").collect()) == [("a", 1), ("b", 3)]


def test_report_files_are_written_by_many_tasks(spark):
    """Short reports of many samples are not joined into one task, which would open every file in turn."""
    from pathlib import Path

    from pyspark.sql import functions as F

    from expatlas.plans import ingest

    lines = spark.range(200).select(F.concat(F.lit("SRR"), "id").alias("sample"), F.lit(0).alias("at"), F.concat(F.lit("n="), "id").alias("value"))
    pattern = ingest._reports(lines, "many")
    files = list(Path(pattern.removesuffix("/*").removeprefix("file:")).glob("sample=*/part-*"))
    assert len(files) == 200 and len({f.name.split("-")[1] for f in files}) > 8
    assert sorted(f.read_text() for f in files) == sorted(f"n={i}\n" for i in range(200))


def test_packed_reports_read_like_files(spark, tmp_path):
    """The same reports as files and packed give the same rows, lines and checksums, in far fewer files than there are reports."""
    from pathlib import Path

    from expatlas.plans import ingest

    texts = {f"SRR{i}": ["# note", "Geneid\tChr\tx.bam", *[f"g{j}\t2L\t{i * j}" for j in range(i % 5)], ""] for i in range(60)}
    lines = spark.createDataFrame([(k, 7 * n, x) for k, v in texts.items() for n, x in enumerate(v)], "sample string, at long, value string")
    files, packed = ingest._reports(lines, "files"), ingest._packed(lines, "packed")
    assert len(list(Path(packed.removeprefix("file:")).glob("*.parquet"))) < 60
    as_rows = lambda df: sorted(map(tuple, df.collect()))
    for read in (
        lambda p: S.read_counts(spark, p, "srr"), lambda p: S._whole(spark, p, "srr").select("sample", "value"),
        lambda p: S.lines_of_files(spark, p, "srr").select("sample", "at", "value"),
        lambda p: S.checksum_manifest(spark, p).select(F.regexp_extract("file", r"sample=(\w+)", 1), "md5"),
        lambda p: S.parse_files(spark, p, lambda sample, found: [(sample, len(found))], "sample string, n int"),
    ):
        assert as_rows(read(files)) == as_rows(read(packed))
    before = set(Path(tmp_path.root, "tmp").glob("spark-*/*/reports/own-*/sample=*"))
    assert ingest.x01_own_parser(spark, "/root/testdata/sf0.001").count() > 0
    assert set(Path(tmp_path.root, "tmp").glob("spark-*/*/reports/own-*/sample=*")) == before
