"""Incremental ingest as file streams that take what is there and stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from expatlas.sources.reports import ACCESSIONS, PACKED_WHOLE, is_packed


def _named(df: DataFrame) -> Column:
    """A file's folder and name, the name first, as accessions stand in either."""
    parts = F.split(F.col("file" if "file" in df.columns else "_metadata.file_path"), "/")
    return F.concat_ws("/", F.element_at(parts, -1), F.try_element_at(parts, F.lit(-2)))


def _arriving(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """``value`` of each report that arrives: a text file each, or rows of packed reports, a row a report."""
    stream = spark.readStream if files_per_batch is None else spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return stream.schema(PACKED_WHOLE).parquet(folder) if is_packed(folder) else stream.text(folder, wholetext=True)


def first_of_key(stream: DataFrame, key: str) -> DataFrame:
    """The first row of every key that a stream ever brings.

    Keys seen are the stream's state: a batch looks up its own keys and writes its own changes, so that
    what it reads does not grow with what is stored, and a restart from the checkpoint neither loses nor
    repeats a key. State is dealt out by key; with ``spark.sql.streaming.stateStore.providerClass`` set to the
    RocksDB provider it lives on the executors' disks.
    """
    return stream.dropDuplicates([key])


def stream_counts(spark: SparkSession, folder: str, sink: str, checkpoint: str, kind: str = "srx", files_per_batch: int = 1000):
    """Count tables that arrive in a folder, a file a sample, appended once a sample: later files of a known sample are left out."""
    files = _arriving(spark, folder, files_per_batch)
    fresh = first_of_key(files.select(F.regexp_extract(_named(files), ACCESSIONS[kind], 1).alias("sample"), "value"), "sample")
    lines = fresh.select("sample", F.explode(F.split("value", r"\r?\n")).alias("value"))
    parts = F.split("value", "\t")
    rows = lines.filter(~F.col("value").startswith("#")).select("sample", parts[0].alias("feature_id"), F.element_at(parts, -1).try_cast("long").alias("count")).filter("count is not null")
    return _append(rows, sink, checkpoint)


def stream_metrics(spark: SparkSession, folder: str, schema: str, sink: str, checkpoint: str, key: str = "srr", done: DataFrame | None = None):
    """Metric rows that arrive as Parquet files, one row a key, only for keys that are done."""
    rows = spark.readStream.schema(schema).parquet(folder)
    return _append(first_of_key(rows if done is None else rows.join(done.select(key).distinct(), key, "left_semi"), key), sink, checkpoint)


def _append(rows: DataFrame, sink: str, checkpoint: str):
    return rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_flags(spark: SparkSession, folder: str, sink: str, checkpoint: str, kind: str = "srr"):
    """Flag files (item from the name, flag from the suffix, text inside) as ``item, flag, note, seen``."""
    files = _arriving(spark, folder)
    name = F.element_at(F.split(F.col("file" if "file" in files.columns else "_metadata.file_path"), "/"), -1)
    rows = files.select(F.regexp_extract(_named(files), ACCESSIONS[kind], 1).alias("item"), F.regexp_extract(name, r"\.([^.]+)$", 1).alias("flag"), F.trim("value").alias("note"), F.col("_metadata.file_modification_time").alias("seen"))
    return _append(rows, sink, checkpoint)


def latest_flags(flags: DataFrame) -> DataFrame:
    return flags.groupBy("item", "flag").agg(F.max_by("note", "seen").alias("note"), F.max("seen").alias("seen"))


def flag_from_logs(lines: DataFrame, phrase: str = "failed to resolve accession") -> DataFrame:
    """Items whose log holds the phrase; works on a batch or a stream of text lines."""
    item = F.regexp_extract(_named(lines), ACCESSIONS["srr"], 1)
    return lines.filter(F.contains("value", F.lit(phrase))).select(item.alias("item"), F.lit("download_bad").alias("flag"))
