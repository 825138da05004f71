"""The ingested corpus: fill nulls -> concatenate text columns -> map the label.

``ingest_frame`` is the lazy plan of A3 applied to any post-shaped DataFrame;
``corpus`` applies it to the stand-in posts built from the driver's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexis.operators.nulls import concat_columns, handle_missing, map_label
from lexis.sources.tables import posts

TEXT_COLUMNS = ["title", "text"]
TARGET, VALUE_TRUE, VALUE_FALSE = "label_raw", "yes", "no"


def ingest_frame(df: DataFrame, text_columns: list[str] | None = TEXT_COLUMNS,
                 target_column: str | None = TARGET, value_true: str = VALUE_TRUE,
                 value_false: str = VALUE_FALSE) -> DataFrame:
    out = handle_missing(df, None, "empty_string")
    if text_columns:
        out = concat_columns(out, text_columns)
    if target_column:
        out = map_label(out, target_column, value_true, value_false).withColumnRenamed(target_column, "label")
    return out


def corpus(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """``user_id, text_id, title, text, label, title_text`` over every document."""
    return ingest_frame(posts(spark, sf_dir, gaps))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).where("label IS NOT NULL")
