"""Contract checks (C11) and journey consistency (I11) as distributed queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.validation import UUID_PATTERN, contract_rules, flat, reasons
from cartwheel.schemas import DEVICES, RETAIL_CATEGORIES
from cartwheel.session import delete_path, folders_in


def contract_reasons(
    events: DataFrame,
    categories: Sequence[str] = RETAIL_CATEGORIES,
    devices: Sequence[str] = DEVICES,
    id_pattern: str | None = UUID_PATTERN,
) -> DataFrame:
    """Every event with ``violations``: the failed contract rules, comma separated
    in rule order; empty text when the event satisfies the contract."""
    rules = contract_rules(flat, categories, devices, id_pattern)
    return events.select("*", F.array_join(reasons(rules), ",").alias("violations"))


def contract_violations(events: DataFrame, **kwargs) -> DataFrame:
    """Rejected events only: event_id, session_id, violations."""
    return (
        contract_reasons(events, **kwargs)
        .filter(F.col("violations") != "")
        .select("event_id", "session_id", "violations")
    )


def split_by_contract(events: DataFrame, **kwargs) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) from one definition of the rules."""
    checked = contract_reasons(events, **kwargs)
    accepted = checked.filter(F.col("violations") == "").drop("violations")
    return accepted, checked.filter(F.col("violations") != "")


JOURNEY_RULES = (
    "first_event_not_view",
    "several_customers",
    "several_countries",
    "several_devices",
    "purchase_without_prior_cart",
)


def journey_parts(events: DataFrame) -> DataFrame:
    """One row per session with all that the journey rules need. Rows of the same session from
    several parts of the events merge (``merged_parts``) to the row of them all."""
    pos = F.struct(F.col("event_timestamp").alias("t"), F.col("event_id").alias("i"))
    first = F.struct(F.col("event_timestamp").alias("t"), F.col("event_id").alias("i"), F.col("event_type").alias("type"))
    return events.groupBy("session_id").agg(
        F.min(first).alias("first_event"),
        F.min("customer_id").alias("c_lo"),
        F.max("customer_id").alias("c_hi"),
        F.min("country").alias("k_lo"),
        F.max("country").alias("k_hi"),
        F.min("device").alias("d_lo"),
        F.max("device").alias("d_hi"),
        F.min(F.when(F.col("event_type") == "add_to_cart", pos)).alias("first_cart"),
        F.min(F.when(F.col("event_type") == "purchase", pos)).alias("first_purchase"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """Rows of ``journey_parts`` of any parts of the events, one row per session."""
    low = ("first_event", "c_lo", "k_lo", "d_lo", "first_cart", "first_purchase")
    return parts.groupBy("session_id").agg(
        *[F.min(c).alias(c) for c in low], *[F.max(c).alias(c) for c in ("c_hi", "k_hi", "d_hi")])


def broken_journeys(per_session: DataFrame) -> DataFrame:
    """Sessions that break a journey rule, with the rule names in the order of ``JOURNEY_RULES``."""
    broken = [
        F.coalesce(F.col("first_event.type") != "product_view", F.lit(True)),
        F.col("c_lo") != F.col("c_hi"),
        F.col("k_lo") != F.col("k_hi"),
        F.col("d_lo") != F.col("d_hi"),
        F.col("first_purchase").isNotNull()
        & (F.col("first_cart").isNull() | (F.col("first_cart") > F.col("first_purchase"))),
    ]
    names = F.filter(
        F.array(*[F.when(F.coalesce(b, F.lit(False)), F.lit(n)) for n, b in zip(JOURNEY_RULES, broken)]),
        lambda x: x.isNotNull(),
    )
    return (
        per_session.select("session_id", F.array_join(names, ",").alias("violations"))
        .filter(F.col("violations") != "")
    )


def journey_consistency(events: DataFrame) -> DataFrame:
    """Sessions breaking a journey rule, with the rule names (in the order of
    ``JOURNEY_RULES``). Event order is (event_timestamp, event_id).

    One aggregate per session: partial aggregation keeps a very long session from
    landing whole in one task's memory.
    """
    return broken_journeys(journey_parts(events))


class JourneyStore:
    """I11 kept up to date: per-session rows of each new part of Silver, appended and merged.

    A part is known by its number (a batch id, a day): adding it again replaces it, so a
    retried batch counts once. Checking reads the stored rows, not Silver.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, part: int, events: DataFrame) -> None:
        journey_parts(events).write.mode("overwrite").parquet(f"{self.path}/part={part}")

    def violations(self) -> DataFrame:
        return broken_journeys(merged_parts(self.spark.read.parquet(self.path).drop("part")))

    def merge(self, part: int) -> None:
        """All parts so far as one part, under a number above theirs; ``drop_merged`` removes
        them. The rows of a session merge to the same row however often they are read."""
        rows = merged_parts(self.spark.read.parquet(self.path).where(F.col("part") < part).drop("part"))
        rows.write.mode("overwrite").parquet(f"{self.path}/part={part}")

    def drop_merged(self, part: int) -> None:
        for name in folders_in(self.spark, self.path):
            if name.startswith("part=") and int(name[5:]) < part:
                delete_path(self.spark, f"{self.path}/{name}")
