"""Ledger files: CSV and Parquet in, eight text columns and a row number out.

Rows of CSV files that have too few or too many cells are not lines: they are set aside with their file,
row number and text, and the numbers of the others are those of their rows all the same.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions.text import number_as_identifier
from stallbook.schema import RAW_COLUMNS, require_columns
from stallbook.sources.numbering import (
    number_frame_rows,
    number_parquet_rows,
    number_text_rows,
)

ROW_NUMBER = "source_row"
REJECTED = "rejected record"
CSV, PARQUET = "csv", "parquet"
ENDINGS = {CSV: (".csv", ".csv.gz", ".csv.bz2", ".csv.zst"), PARQUET: (".parquet", ".parq")}


@dataclass(frozen=True)
class RawLedger:
    """Raw lines (eight text columns and source_row), the columns the source had, and rejected rows if any can be.

    stored lines lie in a table of their own, where reading them several times costs little.
    """

    lines: DataFrame
    column_names: list[str]
    rejects: DataFrame | None = None
    stored: bool = False


def _load(spark: SparkSession, path: str, form: str, **options: str) -> DataFrame:
    try:
        return spark.read.format(form).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Input workbook not found: {path}") from error
        raise


def in_zone(instant: Column, zone: str) -> Column:
    """What clocks of a zone showed at an instant, whatever the session's zone is."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    universal = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), universal)


def as_text(field: T.StructField, time_zone: str = "UTC") -> Column:
    """One source column as raw text; only null and the empty text are missing."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        column = in_zone(column, time_zone)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        # By way of its text, so that a float of 0.1 is not 0.10000000149011612.
        return number_as_identifier(column.cast("string").cast("double")).alias(field.name)
    text = column if isinstance(field.dataType, T.StringType) else column.cast("string")
    return F.when(text != "", text).alias(field.name)


def raw_columns(df: DataFrame, time_zone: str = "UTC") -> DataFrame:
    """The eight required columns as text; additional ones stop here."""
    require_columns(df.columns)
    kept = [as_text(df.schema[name], time_zone) for name in RAW_COLUMNS]
    if ROW_NUMBER in df.columns:
        kept.append(F.col(ROW_NUMBER).cast("bigint").alias(ROW_NUMBER))
    return df.select(*kept)


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> RawLedger:
    """CSV with a header; every cell stays text, so 00100 and NA survive.

    multi_line allows line breaks within quotes at the price of unsplittable files.
    """
    options = {
        "header": "true",
        "escape": '"',
        "multiLine": str(multi_line).lower(),
        # Files whose header differs from the first one's fail instead of being misread.
        "enforceSchema": "false",
        # A row is whole or not whichever columns a reader asks for.
        "columnPruning": "false",
    }
    named = _load(spark, path, CSV, **options)
    require_columns(named.columns)
    schema = T.StructType([*named.schema.fields, T.StructField(REJECTED, T.StringType())])
    df = spark.read.format(CSV).schema(schema).options(**options, columnNameOfCorruptRecord=REJECTED).load(path)
    df = df.withColumn("source_file", F.col("_metadata.file_path"))
    numbered = df if ROW_NUMBER in df.columns else number_text_rows(df)
    record = F.col(f"`{REJECTED}`")
    # Spark refuses to read the rejected text without a cell, so a cell is looked at as well.
    read = F.coalesce(F.length(RAW_COLUMNS[0]), F.lit(0)) >= 0
    lines = numbered.where(F.when(record.isNotNull(), False).otherwise(read))
    rejects = numbered.where(F.when(record.isNotNull(), read).otherwise(False))
    rejects = rejects.select("source_file", F.col(ROW_NUMBER).cast("bigint").alias(ROW_NUMBER), record.alias("record"))
    return RawLedger(raw_columns(lines), named.columns, rejects)


def read_parquet(spark: SparkSession, path: str, time_zone: str = "UTC") -> RawLedger:
    """Parquet of any column types; typed columns become text, instants in time_zone."""
    df = _load(spark, path, "parquet")
    require_columns(df.columns)
    numbered = df if ROW_NUMBER in df.columns else number_parquet_rows(df)
    return RawLedger(raw_columns(numbered, time_zone), df.columns)


def read_frame(df: DataFrame) -> RawLedger:
    """Any DataFrame with the required columns."""
    require_columns(df.columns)
    numbered = df if ROW_NUMBER in df.columns else number_frame_rows(df)
    return RawLedger(raw_columns(numbered), df.columns)


def form_of(spark: SparkSession, path: str) -> str:
    """CSV or Parquet, by the ending of the path or else of the files in it."""
    ended = [form for form, endings in ENDINGS.items() if path.rstrip("/").lower().endswith(endings)]
    if ended:
        return ended[0]
    files = _load(spark, path, "binaryFile", recursiveFileLookup="true").select(F.lower("path").alias("path"))
    counts = files.agg(*[F.count_if(F.rlike("path", F.lit(f"({'|'.join(map(re.escape, endings))})$"))).alias(form) for form, endings in ENDINGS.items()])
    found = [form for form, n in counts.first().asDict().items() if n]
    if len(found) != 1:
        raise ValueError(f"{path} has {' and '.join(found) or 'neither csv nor parquet'} files; name the form.")
    return found[0]


def read_ledger(
    spark: SparkSession, path: str, form: str | None = None, multi_line: bool = False, time_zone: str = "UTC"
) -> RawLedger:
    """A file or folder of CSV or Parquet files; without a form, the files' endings say which."""
    form = form or form_of(spark, path)
    if form not in ENDINGS:
        raise ValueError(f"no form of a ledger: {form}")
    return read_csv(spark, path, multi_line) if form == CSV else read_parquet(spark, path, time_zone)
