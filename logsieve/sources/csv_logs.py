"""CSV access-log source (header line, declared schema, no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from logsieve.schema import CORRUPT_RECORD_COLUMN, LOG_COLUMNS, LOG_SCHEMA, TIMESTAMP_FORMAT


def parse_timestamp(text: F.Column, fmt: str = TIMESTAMP_FORMAT, ntz: bool = False) -> F.Column:
    """Parse text with a fixed pattern; text that does not match gives null.

    `try_to_timestamp` keeps bad rows droppable under ANSI mode (the strict
    parser raises instead). With `ntz=True` the wall-clock value is kept as
    TIMESTAMP_NTZ, independent of the session time zone.
    """
    parsed = F.try_to_timestamp(text, F.lit(fmt))
    if not ntz:
        return parsed
    # The strict NTZ parser only runs on text the lenient one accepted.
    return F.when(parsed.isNotNull(), F.to_timestamp_ntz(text, F.lit(fmt)))


def read_logs(
    spark: SparkSession,
    path: str | list[str],
    *,
    timestamp_format: str = TIMESTAMP_FORMAT,
    ntz: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read header CSV log file(s): a file, glob, directory or URI, or a list.

    Malformed fields become null (PERMISSIVE); rows are not dropped here. With
    `keep_corrupt=True` the raw text of malformed lines (bad field, too few or
    too many fields) is kept in `_corrupt_record`.
    """
    schema = LOG_SCHEMA
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = StructType(LOG_SCHEMA.fields + [StructField(CORRUPT_RECORD_COLUMN, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD_COLUMN)
    df = reader.schema(schema).csv(path)
    return df.withColumn("timestamp", parse_timestamp(F.col("timestamp"), timestamp_format, ntz))


def write_logs_csv(df: DataFrame, path: str, *, timestamp_format: str = TIMESTAMP_FORMAT) -> None:
    """Write log rows as header CSV in the layout `read_logs` expects."""
    out = df.select(
        *[
            F.date_format("timestamp", timestamp_format).alias(c) if c == "timestamp" else F.col(c)
            for c in LOG_COLUMNS
        ]
    )
    out.write.mode("overwrite").option("header", "true").csv(path)
