"""Watchlist and landed listing files."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import published
from ..schemas import LANDED_LISTING, LISTING, REQUIRED_KEYS


def watchlist(lines: DataFrame, column: str = "value") -> DataFrame:
    """`code`: the distinct first words of lines that are neither blank nor begin with ``#``."""
    word = F.split(F.trim(F.regexp_replace(column, r"\s+", " ")), " ")[0]
    return lines.where((F.trim(F.regexp_replace(column, r"\s+", " ")) != "") & ~F.startswith(F.col(column), F.lit("#"))).select(word.alias("code")).distinct()


def read_watchlist(spark: SparkSession, path: str) -> DataFrame:
    return watchlist(spark.read.text(path))


def read_listing(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Listing rows of JSON arrays of ``{"disclosureBasic": {...}}``; strict: one malformed file fails the job."""
    reader = spark.read.schema(LANDED_LISTING).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return reader.json(path, multiLine=True).select("disclosureBasic.*")


def read_lists(spark: SparkSession, path: str, days: tuple[datetime.date, datetime.date] | None = None) -> DataFrame:
    """Listing rows with `file`, the path of their list; of a list that can't be read one row, with `failed`. A row of
    which only a value can't be read has nulls, see `quarantine`.

    days: only lists in folders ``day=yyyy-MM-dd`` of this closed range; others are not opened.
    """
    schema = T.StructType([*LANDED_LISTING.fields, T.StructField("_failed", T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_failed")
    rows = reader.json(path, multiLine=True).select("*", F.col("_metadata.file_path").alias("file"))
    if days is not None:
        rows = rows.where(F.col("day").between(*[F.lit(d) for d in days]))
    return rows.select("disclosureBasic.*", "file", (F.col("_failed").isNotNull() & F.col("disclosureBasic").isNull()).alias("failed"))


def failed_lists(lists: DataFrame) -> DataFrame:
    """`file` of every list of `read_lists` that can't be read."""
    return lists.where("failed").select("file").distinct()


def write_by_day(listing: DataFrame, path: str) -> None:
    """Appends listing rows (LISTING) to folders by the day of publication; rows without one go to the null folder."""
    listing.withColumn("day", published(F.col("publishDate")).cast("date")).write.mode("append").partitionBy("day").parquet(path)


def read_by_day(spark: SparkSession, path: str, first: datetime.date, last: datetime.date) -> DataFrame:
    """Listing rows of the days of a closed range; folders of other days are not read."""
    return spark.read.schema(T.StructType([*LISTING.fields, T.StructField("day", T.DateType())])).parquet(path).where(F.col("day").between(F.lit(first), F.lit(last))).drop("day")


def quarantine(listing: DataFrame, required: tuple[str, ...] = REQUIRED_KEYS) -> tuple[DataFrame, DataFrame]:
    """Rows with all required values, and the others."""
    whole = F.lit(True)
    for c in required:
        whole = whole & F.col(c).isNotNull()
    return listing.where(whole), listing.where(~whole)


def stream_listing(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """The listing files of a folder as a stream, in the order in which they land."""
    reader = spark.readStream.schema(LANDED_LISTING).option("multiLine", True).option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).select("disclosureBasic.*")
