"""Apply a fitted feature stage and model to a stream of new fact rows.

The reference works in batch only; this module is the same scoring operator
(static preprocessing -> learned feature stage -> model) on a Structured
Streaming source.  Every step is stateless per row (the dimension join is a
stream-static join, the learned tables are literal lookups), so no state
store is involved and each micro-batch equals the batch result on its rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from featureflow.plans import features as feat
from featureflow.spec import FeatureSpec


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, file_glob: str | None = None) -> DataFrame:
    """File stream over the folder ``path`` (new files become new micro-batches)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def score_stream(stream: DataFrame, dim: DataFrame | None, spec: FeatureSpec, feature_model: feat.FeatureModel,
                 model: PipelineModel | str, output_columns) -> DataFrame:
    """Streaming DataFrame of ``output_columns + prediction``."""
    if isinstance(model, str):
        model = PipelineModel.load(model)
    scored = model.transform(feature_model.transform(feat.static_features(stream, dim, spec)))
    return scored.select(*[c for c in output_columns if c in scored.columns], "prediction")


def start_to_parquet(scored: DataFrame, out_path: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Parquet sink with its log in ``checkpoint``, a folder on shared storage
    that stays the same over restarts (exactly-once file output)."""
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(out_path)
