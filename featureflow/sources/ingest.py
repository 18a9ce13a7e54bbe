"""Incremental ingest by a manifest of files, and CSV with a quarantine.

``ingest_files`` keeps a Parquet copy of a folder tree of CSV files: only new or
changed files are read, each file's rows are a partition of their own that is
replaced, and a manifest table remembers path, size, time and batch.

``quarantine_csv`` writes well-formed rows and rejects apart in one scan; every
reject keeps its file, its text and a reason, and too large a share of them is
an error.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from featureflow.plans.features import path_exists
from featureflow.sources.io import load_schema, read_csv, save_schema

MANIFEST = "file string, size long, modified timestamp, batch long, rows long, rejects long, removed boolean"
RECORD = "_record"              # the text of a rejected record; NULL in accepted rows


# ---------------------------------------------------------------- manifest
def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, file, size, modified) of all files below ``path`` (a file, folder or glob; any depth, hidden ones left out).

    Spark's own file listing; no content is read.  Empty when nothing is there.
    """
    if not _matches(spark, path):
        return spark.createDataFrame([], "path string, file string, size long, modified timestamp")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                    F.col("_metadata.file_modification_time").alias("modified")))


def _filesystem(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def _matches(spark: SparkSession, path: str) -> bool:
    p, fs = _filesystem(spark, path)
    return bool(fs.globStatus(p))


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of ``root``: one row per file and batch that read it (or saw it gone)."""
    path = f"{root}/manifest"
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def current_files(manifest: DataFrame) -> DataFrame:
    """The last entry of each file that is still there."""
    last = manifest.groupBy("file").agg(F.max(F.struct("batch", "size", "modified", "rows", "rejects", "removed")).alias("e"))
    return last.select("file", "e.*").filter(~F.col("removed")).drop("removed")


def _partition(file: str) -> str:
    """The partition of a file: md5 of its path, as Spark's md5 gives it."""
    return hashlib.md5(file.encode()).hexdigest()


def _drop_partitions(spark: SparkSession, data: str, files: list[str]) -> None:
    for file in files:
        for rejected in ("false", "true"):
            p, fs = _filesystem(spark, f"{data}/_rejected={rejected}/_file={_partition(file)}")
            fs.delete(p, True)


def _stored(spark: SparkSession, root: str, rejected: bool) -> DataFrame:
    """Accepted or rejected records below ``root`` with their ``_file``."""
    fields = [*load_schema(spark, f"{root}/schema").fields, StructField(RECORD, StringType()),
              StructField("_file", StringType()), StructField("_rejected", BooleanType())]
    if not path_exists(spark, f"{root}/data"):
        return spark.createDataFrame([], StructType(fields)).drop("_rejected")
    return (spark.read.schema(StructType(fields)).parquet(f"{root}/data")
            .filter(F.col("_rejected") == F.lit(rejected)).drop("_rejected"))


def ingest_files(spark: SparkSession, raw_path: str, root: str, schema: StructType | None = None,
                 types: dict | None = None, header: bool = True, prune: bool = False, quarantine: bool = False,
                 most_rejects: float | None = None) -> DataFrame:
    """The rows of all files ever ingested from ``raw_path``, after reading those that are new or changed.

    A file is changed when its size or time differs from the manifest; its rows
    are replaced, others are not touched.  Rows of files that are gone stay,
    unless ``prune``.  Data is committed file by file and the manifest last: a
    run that dies is repeated by the next one without losing or doubling a
    row.  Later files are read with the columns and types of the first ones.
    The names of files to read pass through the driver, as in any Spark read.

    Malformed records keep what could be read of them, NULL elsewhere; with
    ``quarantine`` they are rejected instead (``rejected_records``), and when
    more than the share ``most_rejects`` of the new files' records is,
    ``TooManyRejects`` is raised and these files count as not ingested.
    """
    data, manifest = f"{root}/data", read_manifest(spark, root)
    known, now = current_files(manifest), list_files(spark, raw_path)
    fresh = now.join(known.select("file", "size", "modified"), ["file", "size", "modified"], "left_anti").collect()
    gone = known.join(now, "file", "left_anti").collect() if prune else []
    stored = f"{root}/schema"
    if fresh or gone:
        _drop_partitions(spark, data, [r["file"] for r in gone])
        counts = {}
        if fresh:
            paths = [r["path"] for r in fresh]
            if path_exists(spark, f"{stored}/_SUCCESS"):
                schema = load_schema(spark, stored)
            else:
                schema = read_csv(spark, paths, schema, header, types).schema
                save_schema(spark, schema, stored)
            df = _with_record(spark, paths, schema, header)
            rejected = F.col(RECORD).isNotNull() if quarantine else F.lit(False)
            record = F.col(RECORD) if quarantine else F.lit(None).cast("string")
            # a changed file may have no rows now and write no partition: its old ones go first
            _drop_partitions(spark, data, [r["file"] for r in fresh])
            (df.select(*[F.col(f"`{f.name}`") for f in schema.fields], record.alias(RECORD), rejected.alias("_rejected"),
                       F.md5(F.col("_metadata.file_path")).alias("_file"))
             .write.mode("append").partitionBy("_rejected", "_file").parquet(data))
            counts = {(r["_rejected"], r["_file"]): r["n"] for r in
                      spark.read.schema("_rejected boolean, _file string").parquet(data)
                      .filter(F.col("_file").isin([_partition(r["file"]) for r in fresh]))
                      .groupBy("_rejected", "_file").agg(F.count(F.lit(1)).alias("n")).collect()}
            bad, every = sum(n for (rejects, _), n in counts.items() if rejects), sum(counts.values())
            if most_rejects is not None and bad > most_rejects * every:
                raise TooManyRejects(f"{bad} of {every} records rejected, more than {most_rejects:.2%}: see {data}")
        batch = (manifest.agg(F.max("batch")).first()[0] or 0) + 1
        entries = [(r["file"], r["size"], r["modified"], batch, counts.get((False, _partition(r["file"])), 0),
                    counts.get((True, _partition(r["file"])), 0), False) for r in fresh]
        entries += [(r["file"], 0, None, batch, 0, 0, True) for r in gone]
        spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    if not path_exists(spark, f"{stored}/_SUCCESS"):
        raise ValueError(f"no file to ingest at {raw_path}")
    return _stored(spark, root, False).drop(RECORD, "_file")


def rejected_records(spark: SparkSession, root: str) -> DataFrame:
    """(file, record, reason) of the records that ``ingest_files`` rejected, from the files as they are now."""
    files = current_files(read_manifest(spark, root)).select("file", F.md5("file").alias("_file"))
    reason = reject_reason(F.col(RECORD), load_schema(spark, f"{root}/schema"))
    return (_stored(spark, root, True).select("_file", RECORD, reason.alias("reason")).join(files, "_file")
            .select("file", F.col(RECORD).alias("record"), "reason"))


# ---------------------------------------------------------------- quarantine
class TooManyRejects(ValueError):
    """More rows were rejected than allowed; they are in the quarantine folder."""


_ABSENT = "\x01"        # what no field holds: tells a missing field from an empty one


def reject_reason(record: Column, schema: StructType, options: dict | None = None) -> Column:
    """Why a CSV record does not fit the schema: too many or too few fields, or the first field with a wrong value."""
    names = [f"f{i}" for i in range(len(schema.fields) + 1)]
    fields = F.from_csv(record, ", ".join(f"{n} string" for n in names),
                        {**(options or {}), "nullValue": _ABSENT, "emptyValue": ""})
    reason = F.when(fields[names[-1]].isNotNull(), F.lit("too many fields")).when(
        fields[names[-2]].isNull(), F.lit("too few fields"))
    for name, field in zip(names, schema.fields, strict=False):
        if not isinstance(field.dataType, StringType):
            text = fields[name]
            reason = reason.when((text != "") & text.try_cast(field.dataType).isNull(),
                                 F.lit(f"{field.name} is no {field.dataType.simpleString()}"))
    return reason.otherwise(F.lit("malformed"))


def _with_record(spark: SparkSession, path, schema: StructType, header: bool, options: dict | None = None) -> DataFrame:
    """CSV rows with the text of malformed records in ``_record`` (NULL for well-formed ones)."""
    if any(f.name in (RECORD, "_rejected", "_source", "_file") for f in schema.fields):
        raise ValueError("_record, _rejected, _source and _file are names of the ingest")
    return (spark.read.options(**(options or {})).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RECORD)
            .schema(StructType([*schema.fields, StructField(RECORD, StringType())])).csv(path))


def quarantine_csv(spark: SparkSession, path, out_dir: str, schema: StructType, header: bool = True,
                   most_rejects: float | None = 0.01, options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files, written apart below ``out_dir`` in one scan.

    ``rows`` has the schema's columns; ``rejects`` is (file, record, reason).
    Together they are every record of the input.  When more than the share
    ``most_rejects`` is rejected, ``TooManyRejects`` is raised after writing, so
    the rejects can be looked at; None allows any share.
    """
    read_as = StructType([*schema.fields, StructField(RECORD, StringType())])
    raw = _with_record(spark, path, schema, header, options)
    (raw.select("*", F.col("_metadata.file_path").alias("_source"), F.col("_record").isNotNull().alias("_rejected"))
     .write.mode("overwrite").partitionBy("_rejected").parquet(out_dir))
    written = spark.read.schema(StructType([*read_as.fields, StructField("_source", StringType()),
                                            StructField("_rejected", BooleanType())])).parquet(out_dir)
    rows = written.filter(~F.col("_rejected")).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    rejects = written.filter("_rejected").select(F.col("_source").alias("file"), F.col("_record").alias("record"),
                                                 reject_reason(F.col("_record"), schema, options).alias("reason"))
    if most_rejects is not None:
        bad, good = written.filter("_rejected").count(), rows.count()       # partition by partition, from the footers
        if bad > most_rejects * (bad + good):
            raise TooManyRejects(f"{bad} of {bad + good} records rejected, more than {most_rejects:.2%}: see {out_dir}")
    return rows, rejects
