"""Applicants scored as a stream: the batch functions on a streaming frame, append only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from provisio.operators.scoring import score_batch


def read_applicants(spark: SparkSession, path: str, schema, pattern: str | None = None, max_files: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def score_stream(applicants: DataFrame, medians: dict[str, float], scorer) -> DataFrame:
    """Stateless scoring, each row once, no shuffle; invalid rows get tier 'Unknown' and the reason, as in a batch.

    ``scorer`` adds pd_raw and pd_calibrated to complete feature rows.
    """
    return score_batch(applicants, medians, scorer)


def write_stream(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run over all files that are there and stop; exactly once through the file sink."""
    return (
        scored.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
