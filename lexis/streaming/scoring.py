"""Blind scoring as Structured Streaming (F9 on a stream).

A fitted ``PipelineModel`` is stateless per row, so ``model.transform`` applies
unchanged to a streaming DataFrame: new files in the input folder are scored
micro-batch by micro-batch and appended to a Parquet sink.  The checkpoint
(offsets + commit log) lives below the shared folder, so a restarted query
resumes where it stopped and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def score_stream(spark: SparkSession, model: PipelineModel, input_path: str, schema: T.StructType,
                 output_path: str, checkpoint_path: str, id_col: str = "text_id",
                 max_files_per_trigger: int = 64) -> None:
    """Score every file currently in ``input_path`` (trigger ``availableNow``) and stop."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(input_path))
    scored = model.transform(stream).select(
        id_col, F.col("prediction").cast("int").alias("prediction"),
        F.round(vector_to_array("probability")[1], 4).alias("probability"))
    q = (scored.writeStream.format("parquet").option("path", output_path)
         .option("checkpointLocation", checkpoint_path).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_scores(spark: SparkSession, output_path: str) -> DataFrame:
    return spark.read.parquet(output_path)
