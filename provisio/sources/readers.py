"""Scans: CSV with a given schema, parquet with pruned columns, fitted state from JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provisio.functions.semantics import nan_to_null


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None, encoding: str = "UTF-8",
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the file twice.

    A column subset reaches the reader, so other fields are not parsed.
    """
    reader = spark.read.option("header", True).option("encoding", encoding)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return nan_to_null(df.select(*columns) if columns else df)


def column_descriptions(dictionary: DataFrame) -> DataFrame:
    """Name and description of each column, picked by position (second and fifth)."""
    cols = dictionary.columns
    return dictionary.select(
        F.trim(F.col(f"`{cols[1]}`")).alias("column"), F.col(f"`{cols[4]}`").alias("description")
    ).dropDuplicates(["column"])


def describe_columns(names: DataFrame, descriptions: DataFrame) -> DataFrame:
    return names.join(descriptions, "column", "left").withColumn(
        "description", F.coalesce("description", F.lit("not found"))
    )


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def table_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the file footers."""
    return spark.read.parquet(path).columns


def read_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first of several tables that exists."""
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of {list(paths)} exists")


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Fitted weights written as one map per feature, back in long form."""
    state = spark.read.schema("feature string, weights map<string,double>").json(path)
    return state.select("feature", F.explode("weights").alias("bin", "woe"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Model-keyed metrics document: {model: {metric: value}}."""
    doc = spark.read.option("multiLine", True).schema("metrics map<string,map<string,double>>").json(path)
    return doc.select(F.explode("metrics").alias("model", "m")).select(
        "model", F.explode("m").alias("metric", "value")
    )
