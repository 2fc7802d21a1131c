"""Sinks: parquet tables, versioned stages, CSV reports, JSON state and text lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provisio.operators.woe import weight_maps


def write_table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return table_report(df.sparkSession, path)


def table_report(spark: SparkSession, path: str) -> DataFrame:
    """Rows, columns, files and bytes of a written table."""
    df = spark.read.parquet(path)
    files = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("bytes")
    )
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.lit(len(df.columns)).alias("column_count"),
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )


def write_version(df: DataFrame, root: str, stage: str) -> DataFrame:
    """A stage of the results in its own path: a table is never overwritten while it is read."""
    path = f"{root}/{stage}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per partition (reports are aggregates, so usually one)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_submission(df: DataFrame, path: str, key: str = "sk_id_curr", p: str = "pred_prob") -> None:
    df.select(F.col(key).cast("int").alias("SK_ID_CURR"), F.col(p).alias("TARGET")).write.mode(
        "overwrite"
    ).option("header", True).csv(path)


def write_weights(weights: DataFrame, path: str) -> None:
    weight_maps(weights).write.mode("overwrite").json(path)


def write_metrics(board: DataFrame, path: str) -> None:
    """One document {model: {metric: value}} from a leaderboard of a few rows."""
    cols = [c for c in board.columns if c != "model"]
    entry = F.struct("model", F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("double"))]))
    board.agg(F.map_from_entries(F.collect_list(entry)).alias("metrics")).write.mode("overwrite").json(path)


def write_feature_list(spark: SparkSession, features: Sequence[str], top: Sequence[tuple[str, float]], path: str) -> None:
    """Text list: count, the features most correlated with the target, then all names."""
    lines = [f"Total features: {len(features)}", "", "Top features by |correlation with target|:"]
    lines += [f"  {i:>2}. {name}: {r:.4f}" for i, (name, r) in enumerate(top, 1)]
    lines += ["", "All features:", *[f"  {f}" for f in features]]
    numbered = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    numbered.coalesce(1).sortWithinPartitions("i").select("value").write.mode("overwrite").text(path)
