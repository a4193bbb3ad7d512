"""Report-ready tables over the Gold tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators.gold import price_segment_order
from cartwheel.session import delete_path, folders_in

GOLD_TABLES = ("funnel", "categories", "price_buckets")
_MANIFEST = T.StructType([T.StructField("build", T.StringType()), T.StructField("tables", T.ArrayType(T.StringType())),
                          T.StructField("version", T.LongType())])


class GoldMissingError(FileNotFoundError):
    """Gold tables were not built yet."""


def write_version(tables: dict[str, DataFrame], gold_path: str) -> int:
    """The tables of one build as the next version; its number.

    Every table goes into a folder of this build; the manifest, one small file that is
    renamed into place, comes last. A build that fails leaves the version before as it was,
    and readers never see tables of two builds. Two builds at once cannot take the same
    number: the second to write its manifest fails.
    """
    spark = next(iter(tables.values())).sparkSession
    root, build = gold_path.rstrip("/"), uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/builds/{build}/{name}")
    newest = _newest(spark, root)
    version = 1 if newest is None else newest["version"] + 1
    manifest = spark.createDataFrame([(build, list(tables))], T.StructType(_MANIFEST.fields[:2])).coalesce(1)
    manifest.write.mode("error").parquet(f"{root}/manifests/version={version}")
    return version


def _newest(spark: SparkSession, root: str) -> Row | None:
    try:
        manifests = spark.read.schema(_MANIFEST).parquet(f"{root}/manifests")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return manifests.orderBy(F.desc("version")).first()


def load_version(spark: SparkSession, gold_path: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The tables (all, or those of ``names``) of the newest complete version, or a
    clear error when there is none."""
    root = gold_path.rstrip("/")
    newest = _newest(spark, root)
    if newest is None:
        raise GoldMissingError(f"no complete version of the Gold tables at {root}; build the Gold tables first")
    missing = sorted(set(names or ()) - set(newest["tables"]))
    if missing:
        raise GoldMissingError(f"version {newest['version']} at {root} has no table {', '.join(missing)}")
    return {name: spark.read.parquet(f"{root}/builds/{newest['build']}/{name}") for name in names or newest["tables"]}


def clean_versions(spark: SparkSession, gold_path: str, keep: int = 2) -> int:
    """Remove the builds that are not in the last ``keep`` versions, those that failed included;
    their number. To be called when no build is being written."""
    root = gold_path.rstrip("/")
    if _newest(spark, root) is None:
        return 0
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifests").orderBy(F.desc("version")).limit(max(1, keep)).collect()
    kept = {r["build"] for r in rows}
    gone = [b for b in folders_in(spark, f"{root}/builds") if b not in kept]
    for build in gone:
        delete_path(spark, f"{root}/builds/{build}")
    return len(gone)


def write_gold_tables(funnel: DataFrame, categories: DataFrame, price_buckets: DataFrame, gold_path: str) -> int:
    """The three clickstream Gold tables as the next version."""
    return write_version(dict(zip(GOLD_TABLES, (funnel, categories, price_buckets))), gold_path)


def load_gold_tables(spark: SparkSession, gold_path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three clickstream Gold tables of the newest version, or a clear error when absent."""
    tables = load_version(spark, gold_path, GOLD_TABLES)
    return tuple(tables[name] for name in GOLD_TABLES)


def category_label() -> F.Column:
    """B26: 'unknown' -> 'Unknown', else the first 12 characters and an ellipsis."""
    return F.when(F.col("category") == "unknown", F.lit("Unknown")).otherwise(
        F.concat(F.substring("category", 1, 12), F.lit("…"))
    )


def top_categories(categories: DataFrame, k: int = 10) -> DataFrame:
    """V1 + F6: the ``k`` categories with most purchases (category breaks ties),
    labelled, then listed by purchases ascending (bar-chart order)."""
    top = categories.orderBy(F.desc("purchases"), F.asc("category")).limit(k)
    return top.select(
        category_label().alias("category_display"), "purchases", "purchase_per_view_rate", "category"
    ).orderBy(F.asc("purchases"), F.desc("category")).drop("category")


def funnel_stages(funnel: DataFrame) -> DataFrame:
    """V2 + B27: the one-row funnel as (Stage, Count) rows."""
    return funnel.select(
        F.col("total_sessions").alias("Sessions"),
        F.col("cart_sessions").alias("Added to cart"),
        F.col("purchase_sessions").alias("Purchased"),
    ).unpivot([], ["Sessions", "Added to cart", "Purchased"], "Stage", "Count")


def kpi_strip(funnel: DataFrame) -> DataFrame:
    """V3 + B28: four counts with thousands separators, three rates as 'x.xx%'."""
    def rate(c: str) -> F.Column:
        # an undefined rate stays null (format_string would print "null%")
        return F.when(F.col(c).isNotNull(), F.format_string("%.2f%%", F.col(c)))

    return funnel.select(
        F.format_number(F.col("total_events"), 0).alias("events"),
        F.format_number(F.col("total_sessions"), 0).alias("sessions"),
        F.format_number(F.col("total_products"), 0).alias("products"),
        F.format_number(F.col("purchases"), 0).alias("purchases"),
        rate("view_to_cart_rate").alias("view_to_cart"),
        rate("purchase_conversion_rate").alias("purchase_conversion"),
        rate("cart_to_purchase_rate").alias("cart_to_purchase"),
    )


def purchases_by_segment(price_buckets: DataFrame) -> DataFrame:
    """V4: price_segment (text), purchases, numeric segment order with unknown last."""
    return price_buckets.select(F.col("price_segment").cast("string"), "purchases").orderBy(
        *price_segment_order()
    )
