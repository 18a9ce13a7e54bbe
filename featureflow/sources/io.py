"""Sources and sinks.

Everything goes through Spark's readers and writers, so any Hadoop file
system works; schema sidecars are written with Spark too (never ``open()``
on the driver's local disk).
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from featureflow.plans.features import path_exists


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             header: bool = True, types: dict | None = None) -> DataFrame:
    """CSV (glob and .bz2/.gz accepted).  With a schema no inference pass runs.

    ``types`` gives the types of some columns by name, all others are text:
    only the header line is read to build the schema.  Text that is no value
    of a column's type is NULL.
    """
    reader = spark.read.option("header", header)
    if schema is None and types is not None:
        names = spark.read.option("header", header).csv(path).columns
        schema = StructType([StructField(n, DataType.fromDDL(types.get(n, "string"))) for n in names])
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet, with the stored schema enforced when given (only its columns are read)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              partition_by=None) -> None:
    w = df.write.mode(mode).option("header", header)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.csv(path)


def save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    """Schema JSON as a one-line text file, written by Spark."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> StructType:
    text = spark.read.text(path).first()["value"]
    return StructType.fromJson(json.loads(text))


def fingerprint(spark: SparkSession, path: str) -> str:
    """Digest of the names, sizes and modification times of the files at ``path`` (a glob, file or folder); "" for none."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    found = []
    for s in fs.globStatus(p) or []:
        for f in fs.listStatus(s.getPath()) if s.isDirectory() else [s]:
            found.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest() if found else ""


def ingest_cached(spark: SparkSession, raw_path: str, parquet_path: str, schema_path: str,
                  schema: StructType | None = None, types: dict | None = None) -> DataFrame:
    """Read Parquet if this raw input was ingested before, else CSV -> Parquet (+ schema and source sidecars).

    The copy is used only when it is finished (``_SUCCESS``) and was made from
    the same files (path, size, modification time); the sidecars are written
    last.  A finished copy whose raw files are gone is used as well.
    """
    source_path = f"{schema_path}_source"
    now = fingerprint(spark, raw_path)
    if all(path_exists(spark, f"{p}/_SUCCESS") for p in (parquet_path, schema_path, source_path)):
        if not now or spark.read.text(source_path).first()["value"] == now:
            return read_parquet(spark, parquet_path, load_schema(spark, schema_path))
    df = read_csv(spark, raw_path, schema, types=types)
    df.write.mode("overwrite").parquet(parquet_path)
    save_schema(spark, df.schema, schema_path)
    spark.createDataFrame([(now,)], "value string").coalesce(1).write.mode("overwrite").text(source_path)
    return read_parquet(spark, parquet_path, df.schema)


def validate_dataset(df: DataFrame, label: str | None = None, mode: str = "train") -> DataFrame:
    """Reject an empty table, and a training table without its label column."""
    if df.isEmpty():
        raise ValueError(f"no row to {mode} with; columns found: {df.columns}")
    if mode == "train" and label is not None and label not in df.columns:
        raise ValueError(f"cannot train without the label column {label!r}; columns found: {df.columns}")
    return df
