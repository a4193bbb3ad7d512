"""File sources: header CSV with a fixed schema (A3) and Parquet (A4).

No schema inference: the schemas are fixed, so a scan never needs an extra pass and
Catalyst can prune columns and push filters into the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.schemas import BROWSING_SCHEMA, CATALOG_SCHEMA


def read_csv(spark: SparkSession, path: str, schema, mode: str = "PERMISSIVE") -> DataFrame:
    """Header CSV with ``schema``. Quoted and unquoted empty fields read as null;
    a field that does not fit its type is null in PERMISSIVE mode."""
    return spark.read.option("header", True).option("mode", mode).schema(schema).csv(path)


def read_browsing_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, BROWSING_SCHEMA)


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CATALOG_SCHEMA)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
