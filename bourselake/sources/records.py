"""The finished records as JSON Lines: one object per line, nulls kept, times as ``yyyy-MM-dd HH:mm:ss``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RECORD

_TIMES = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "dateFormat": "yyyy-MM-dd"}


def record_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false", **_TIMES})


def write_records(records: DataFrame, path: str, mode: str = "append", by: str | None = None) -> None:
    """Appends records; with `by`, into one folder per value of it."""
    writer = records.write.mode(mode).options(ignoreNullFields="false", **_TIMES)
    (writer.partitionBy(by) if by else writer).json(path)


def read_records(spark: SparkSession, path: str, schema: StructType = RECORD) -> DataFrame:
    """Records of a folder and of the folders below it."""
    return spark.read.schema(schema).options(recursiveFileLookup="true", **_TIMES).json(path)


def read_all_ranges(spark: SparkSession, path: str, schema: StructType, key: str = "disclosure_index") -> DataFrame:
    """All range outputs together, each key once; the range is a column if `schema` has it."""
    return spark.read.schema(schema).options(**_TIMES).json(path).dropDuplicates([key])


def written_keys(lines: DataFrame, key: str = "disclosure_index", column: str = "value") -> DataFrame:
    """The key at the head of each written line, without parsing the record; either JSON writer's spacing."""
    head = F.regexp_extract(column, rf'^\{{"{key}": ?(\d+)', 1)
    return lines.select(head.try_cast("long").alias(key)).where(F.col(key).isNotNull())


def write_batch(records: DataFrame, path: str, run: str, batch: int) -> None:
    """The records of one batch of a run, in a folder of their own; a batch that is done again replaces them."""
    write_records(records, f"{path}/run={run}/batch={batch}", mode="overwrite")


def read_written_keys(spark: SparkSession, path: str | list[str], key: str = "disclosure_index") -> DataFrame:
    """Keys that are written already; none where nothing is written yet."""
    try:
        lines = spark.read.text(path, recursiveFileLookup=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{key} long")
    return written_keys(lines, key)
