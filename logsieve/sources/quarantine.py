"""Quarantine: every CSV line is kept, either as a valid row or with its raw
text and the reasons why it is none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from logsieve.operators.quality import drop_invalid
from logsieve.schema import CORRUPT_RECORD_COLUMN, LOG_COLUMNS, LOG_SCHEMA, MANDATORY_COLUMNS, TIMESTAMP_FORMAT
from logsieve.sources.csv_logs import parse_timestamp

VALID, QUARANTINE = "valid", "quarantine"

#: Bit k of a reason mask is the k-th of these: a mandatory field without a
#: value, a field whose text cannot be read, then a line of too few or too many fields.
REASONS = (
    *(f"missing {c}" for c in MANDATORY_COLUMNS),
    *(f"unreadable {f.name}" for f in LOG_SCHEMA.fields if f.name == "timestamp" or not isinstance(f.dataType, StringType)),
    "too short", "too long",
)


@dataclass(frozen=True)
class Routed:
    """Where `write_routed` put the rows, and how many went each way and for each reason."""

    path: str
    valid: int
    quarantined: int
    reasons: dict[str, int]


def field_count(raw: Column) -> Column:
    """Fields of a CSV line: quoted stretches, in which a backslash escapes, hold no separator."""
    bare = F.regexp_replace(raw, r'"(?:[^"\\]|\\.)*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_routed(
    spark: SparkSession, path: str | list[str], *, timestamp_format: str = TIMESTAMP_FORMAT, ntz: bool = False,
    strict: bool = False, header: bool = True,
) -> DataFrame:
    """The log columns as `read_logs` gives them, and for each line `raw`,
    `reason_mask` (bits as in REASONS), `reasons` and `route`.

    A row is valid if `drop_invalid` keeps it, so valid rows are those of
    `read_logs` and `drop_invalid`; a valid row may still have reasons (an
    unreadable user, a field too many) and then keeps its raw text too. With
    `strict` any reason sends it to quarantine. raw is null for lines without
    a reason. It is the line as it stands if the reader found it malformed,
    else the line made again from its fields.

    Everything is one pass over the lines: nothing is joined or shuffled. Empty
    fields are null, as in `read_logs`. Empty lines are no rows.
    """
    schema = StructType([*LOG_SCHEMA.fields, StructField(CORRUPT_RECORD_COLUMN, StringType())])
    reader = spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE")
    lines = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD_COLUMN).csv(path)
    return route_rows(lines, timestamp_format=timestamp_format, ntz=ntz, strict=strict)


def route_rows(lines: DataFrame, *, timestamp_format: str = TIMESTAMP_FORMAT, ntz: bool = False, strict: bool = False) -> DataFrame:
    """The second half of `read_routed`: log columns with the timestamp still
    text, and the raw text of malformed lines in `_corrupt_record`."""
    corrupt = F.col(CORRUPT_RECORD_COLUMN)
    parsed = parse_timestamp(F.col("timestamp"), timestamp_format, ntz)
    # only malformed lines are parsed again, as text
    texts = F.from_csv(corrupt, ", ".join(f"{c} string" for c in LOG_COLUMNS))

    def value(c: str) -> Column:
        return parsed if c == "timestamp" else F.col(c)

    def text(c: str) -> Column:
        return F.col("timestamp") if c == "timestamp" else texts[c]

    def has_text(c: str) -> Column:
        return text(c).isNotNull() & (text(c) != "")

    found: dict[str, Column] = {}
    for reason in REASONS[:-2]:
        kind, c = reason.split(" ")
        found[reason] = value(c).isNull() & (has_text(c) if kind == "unreadable" else ~F.coalesce(has_text(c), F.lit(False)))
    for c in MANDATORY_COLUMNS:
        # a well-formed line has its text in the field itself
        if f"unreadable {c}" not in found:
            found[f"missing {c}"] = value(c).isNull()
    n = field_count(corrupt)
    found["too short"], found["too long"] = n < len(LOG_COLUMNS), n > len(LOG_COLUMNS)

    mask = F.lit(0)
    for k, reason in enumerate(REASONS):
        mask = mask + F.when(found[reason], 1 << k).otherwise(0)
    line = F.to_csv(F.struct(*LOG_COLUMNS))
    rows = lines.withColumns({"reason_mask": mask, "_parsed": parsed})
    rows = rows.withColumn("raw", F.when(F.col("reason_mask") != 0, F.coalesce(corrupt, line)))
    rows = rows.withColumn("timestamp", F.col("_parsed")).drop("_parsed", CORRUPT_RECORD_COLUMN)
    names = F.array_compact(F.array(*[
        F.when(F.col("reason_mask").bitwiseAND(F.lit(1 << k)) != 0, reason) for k, reason in enumerate(REASONS)
    ]))
    complete = F.lit(True)
    for c in MANDATORY_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    good = (F.col("reason_mask") == 0) if strict else complete
    return rows.withColumns({"reasons": names, "route": F.when(good, VALID).otherwise(QUARANTINE)})


def write_routed(routed: DataFrame, path: str) -> Routed:
    """Write all rows once, under `{path}/route=valid` and `{path}/route=quarantine`.

    The counts are observed by that same write. The rows go where they are
    parsed; a task writes at most two files for each of its parts.
    """
    seen = Observation("routes")
    counts = [F.count_if(F.array_contains("reasons", r)).alias(f"r{k}") for k, r in enumerate(REASONS)]
    counted = routed.observe(seen, F.count_if(F.col("route") == VALID).alias("valid"), F.count_if(F.col("route") != VALID).alias("out"), *counts)
    counted.write.mode("overwrite").partitionBy("route").parquet(path)
    got = seen.get
    return Routed(path, got["valid"], got["out"], {r: got[f"r{k}"] for k, r in enumerate(REASONS)})


def read_valid(spark: SparkSession, path: str) -> DataFrame:
    """The valid rows, log columns only: the folder of the others is not read."""
    rows = spark.read.parquet(path).where(F.col("route") == VALID)
    return drop_invalid(rows.drop("route", "raw", "reason_mask", "reasons"))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The quarantined rows: raw text, reasons and whatever fields could be read."""
    return spark.read.parquet(path).where(F.col("route") == QUARANTINE).drop("route")
