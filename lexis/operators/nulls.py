"""Null handling, text concatenation and label mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRATEGIES = ("empty_string", "drop", "placeholder")
PLACEHOLDER = "missing_data"


def handle_missing(df: DataFrame, columns: list[str] | None = None,
                   strategy: str = "empty_string") -> DataFrame:
    """B1-B3.  Fills apply to string columns (a string fill leaves numeric
    columns as they are, like pandas on a column without nulls); cast a numeric
    column to string first to fill it.  Unknown strategy raises ValueError."""
    cols = list(columns) if columns else list(df.columns)
    if strategy == "drop":
        return df.dropna(how="any", subset=cols)
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown missing-data strategy: {strategy!r}")
    fill = "" if strategy == "empty_string" else PLACEHOLDER
    return df.fillna(fill, subset=cols)


def concat_columns(df: DataFrame, columns: list[str], sep: str = " ") -> DataFrame:
    """Fills the source columns with '' and appends ``a_b`` = values joined by ``sep``."""
    out = handle_missing(df, columns, "empty_string")
    return out.withColumn("_".join(columns), F.concat_ws(sep, *[F.col(c) for c in columns]))


def map_binary(c: str | Column, value_true: str, value_false: str) -> Column:
    """value_true -> 1, value_false -> 0, anything else -> null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == value_true, F.lit(1)).when(col == value_false, F.lit(0)).cast(T.IntegerType())


def map_label(df: DataFrame, column: str, value_true: str, value_false: str) -> DataFrame:
    return df.withColumn(column, map_binary(column, value_true, value_false))


def is_removed(c: str | Column) -> Column:
    """Stripped text equals the moderator placeholder."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(F.regexp_replace(col, r"^[\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+$", "")) == "[removed]",
                      F.lit(False))


def is_deleted(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.instr(col, "[deleted]") > 0, F.lit(False))
