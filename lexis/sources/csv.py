"""CSV sources (A1-A4): header gate, schema-declared scan and full ingest.

Texts contain newlines, so files are read with ``multiLine``; that makes each
*file* one split, which is why writers here emit one file per partition and
readers get parallelism from the file count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.sources.corpus import ingest_frame

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# Spellings of a missing value in a text column.
NULL_SPELLINGS = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
                  "NaN", "None", "n/a", "nan", "null")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    (df.write.mode(mode).options(**{k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}).csv(path))
    return path


def headers(spark: SparkSession, path: str) -> list[list[str]]:
    """The distinct headers of all files of ``path``: the first line of each file
    (header names hold no line break), parsed by the CSV reader's rules."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "line").alias("value"))
    rows = first.select("value").distinct().limit(2).collect()  # two differing headers already fail the gate
    return [spark.read.options(header="true").csv(spark.sparkContext.parallelize([r.value], 1)).columns for r in rows]


def schema_validation(spark: SparkSession, path: str, expected: list[str]) -> bool:
    """A2: every file's header equals ``expected``, in order."""
    return headers(spark, path) == [list(expected)]


def csv_scan(spark: SparkSession, path: str, columns: list[str], types: dict | None = None) -> DataFrame:
    """A1: declared schema (strings unless typed), RFC-4180 quoting, multi-line records.
    A file whose header differs from ``columns`` fails the read; the spellings of
    a missing value become null."""
    types = types or {}
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType()), True) for c in columns])
    df = spark.read.schema(schema).options(**CSV_OPTIONS, enforceSchema="false").csv(path)
    strings = [c for c in columns if isinstance(types.get(c, T.StringType()), T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*NULL_SPELLINGS), F.col(c)) for c in strings})


def ingest(spark: SparkSession, path: str, expected_columns: list[str], text_columns: list[str] | None = None,
           target_column: str | None = None, value_true: str | None = None,
           value_false: str | None = None) -> DataFrame:
    """A3: gate -> load -> fill '' -> concatenate -> map label, as one lazy plan.
    Raises ValueError when the header does not match."""
    actual = headers(spark, path)
    if actual != [list(expected_columns)]:
        raise ValueError(f"schema mismatch: expected {expected_columns}, found {actual}")
    df = csv_scan(spark, path, expected_columns)
    return ingest_frame(df, text_columns, target_column, value_true, value_false)
