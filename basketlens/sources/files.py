"""File sources and sinks: raw CSV, clean CSV, the order table."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Quotes are doubled inside quoted fields, as other CSV programs write and read them.
QUOTING = {"quote": '"', "escape": '"'}


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_raw_csv(
    spark: SparkSession, path: str, names: list[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """Scan a CSV with header; every column is text, typed later by expressions.

    With ``names`` the header is not sampled; without, it is read and nothing is inferred.  ``multi_line`` reads
    quoted line breaks as text; a file is then one task, so leave it off where no field has any.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False).option("inferSchema", False)
    reader = reader.option("multiLine", multi_line).options(**QUOTING)
    if names is not None:
        reader = reader.schema(text_schema(names))
    return reader.csv(path)


MALFORMED = "_malformed"


def read_raw_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """As ``read_raw_csv``, and ``_malformed``: the whole record of a line with fewer or more fields than the header, else null.

    Every field is parsed, whatever columns are used: fields that are left out could not be counted.
    """
    names = read_raw_csv(spark, path, multi_line=multi_line).columns
    schema = text_schema([*names, MALFORMED])
    return (
        spark.read.option("header", True).option("multiLine", multi_line).option("mode", "PERMISSIVE").option("columnPruning", False)
        .option("columnNameOfCorruptRecord", MALFORMED).options(**QUOTING).schema(schema).csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).options(**QUOTING).csv(path)


def read_clean_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", multi_line).options(**QUOTING).schema(schema).csv(path)


# Names that other readers of the folder pass over.
CURRENT, VERSIONS = "_CURRENT", "_versions"


def _files(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, at, at.getFileSystem(conf)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version that the table at ``path`` points to; null if there is none."""
    jvm, _, at, fs = _files(spark, path)
    pointer = jvm.org.apache.hadoop.fs.Path(at, CURRENT)
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def stage_table(df: DataFrame, path: str) -> str:
    """Write ``df`` as a further version of the table at ``path``; readers do not see it before ``publish_version``."""
    version = f"version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path.rstrip('/')}/{VERSIONS}/{version}")
    return version


def read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{VERSIONS}/{version}")


def drop_version(spark: SparkSession, path: str, version: str) -> None:
    jvm, _, at, fs = _files(spark, path)
    fs.delete(jvm.org.apache.hadoop.fs.Path(at, f"{VERSIONS}/{version}"), True)


def publish_version(spark: SparkSession, path: str, version: str) -> None:
    """Let the table at ``path`` be ``version``: one rename of a small file.

    The version before stays, as readers may still be at work on it; what is older goes.
    """
    jvm, conf, at, fs = _files(spark, path)
    hadoop, before = jvm.org.apache.hadoop.fs, current_version(spark, path)
    drawn = hadoop.Path(at, f"{CURRENT}-{uuid.uuid4().hex}")
    out = fs.create(drawn, True)
    out.write(bytearray(version.encode()))
    out.close()
    kinds = getattr(hadoop, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kinds, 1)
    overwrite[0] = kinds.OVERWRITE
    source, target = fs.makeQualified(drawn), fs.makeQualified(hadoop.Path(at, CURRENT))
    hadoop.FileContext.getFileContext(target.toUri(), conf).rename(source, target, overwrite)
    for status in fs.listStatus(hadoop.Path(at, VERSIONS)):
        name = status.getPath().getName()
        if name < version and name != before:
            fs.delete(status.getPath(), True)


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table at ``path`` (Parquet): a new version beside the old one, then the pointer moves.

    Whatever fails before the pointer has moved, the old version stays the table.
    """
    publish_version(df.sparkSession, path, stage_table(df, path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table, or plain Parquet files where nothing points to one."""
    version = current_version(spark, path)
    return spark.read.parquet(path) if version is None else read_version(spark, path, version)
