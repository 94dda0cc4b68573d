"""Delimited files as sources and sink: all text, typed, and many files whose headers differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_columns(spark: SparkSession, path: str | list[str], sep: str = ";", names: list[str] | None = None) -> DataFrame:
    """Every column as text; an empty and a missing entry are null.

    ``names`` are the header's where they are known; else the first file's header counts for all files.
    """
    reader = spark.read.option("sep", sep).option("header", True).option("enforceSchema", False)
    return (reader.schema(", ".join(f"`{n}` string" for n in names)) if names else reader).csv(path)


def read_typed(spark: SparkSession, path: str | list[str], types: dict[str, str], sep: str = ",", overrides: dict[str, str] | None = None) -> DataFrame:
    """Columns of the given types, some of them overridden; an entry that is not of its type raises."""
    schema = ", ".join(f"`{n}` {t}" for n, t in (types | (overrides or {})).items())
    return spark.read.option("sep", sep).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").schema(schema).csv(path)


def headers(spark: SparkSession, pattern: str) -> DataFrame:
    """(header, files) of all files of a pattern: one row per different first line."""
    lines = spark.read.text(pattern).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))
    return first.groupBy("header").agg(F.collect_list("file").alias("files"))


def read_many(spark: SparkSession, pattern: str, sep: str = ";") -> DataFrame:
    """All files of a pattern by the names of their own headers, as text; columns a file lacks are null.

    Files of one header are one scan; the driver sees the different headers and the files' paths, never rows.
    """
    parts = [read_text_columns(spark, r["files"], sep, [n.strip('"') for n in r["header"].removeprefix("\ufeff").split(sep)]) for r in sorted(headers(spark, pattern).collect(), key=lambda r: r["header"])]
    if not parts:
        raise FileNotFoundError(pattern)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    """One file with a header per task; the order of rows is kept only inside sorted partitions."""
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)
