"""Parsing and validation of raw JSON events (Silver rules C1-C15, contract C11).

Parse once. Filtering on fields of a ``from_json`` result lets Catalyst push the
filter below the projection and re-parse the JSON for every predicate. Wrapping the
check in ``explode(when(ok, array(event)))`` keeps a single ``from_json`` in the
plan: the generator is not a Filter, so nothing is pushed through it.

Malformed JSON and the literal ``null`` parse to a struct of nulls (not a null
struct), so they pass C1 and are rejected by the required-field rules; only null or
empty text gives a null struct.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartwheel.schemas import CLICK_SOURCE, DEVICES, EVENT_TYPES, RETAIL_CATEGORIES

Field = Callable[[str], Column]
CORRUPT = "_corrupt_record"

# Fixed value: the accepted textual UUID forms — 32 hex digits, the hyphenated
# 8-4-4-4-12 form, and that form in braces or after "urn:uuid:".
_UUID_HYPHENATED = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
UUID_PATTERN = rf"^(?:[0-9a-fA-F]{{32}}|(?:urn:uuid:)?{_UUID_HYPHENATED}|\{{{_UUID_HYPHENATED}\}})$"


def retail_rules(f: Field, key: Column) -> list[tuple[str, Column]]:
    """C14: the nine Silver conditions for retail events, as (reason, ok) pairs."""
    return [
        ("missing_event_id", f("event_id").isNotNull()),
        ("bad_event_type", f("event_type").isin(*EVENT_TYPES)),
        ("missing_event_timestamp", f("event_timestamp").isNotNull()),
        ("missing_session_id", f("session_id").isNotNull()),
        ("key_not_session", key == f("session_id")),
        ("missing_product_id", f("product_id").isNotNull()),
        ("bad_unit_price", f("unit_price") > 0),
        ("bad_quantity", f("quantity") > 0),
        ("bad_country", F.length(f("country")) == 2),
    ]


def click_rules(f: Field, key: Column, source: str = CLICK_SOURCE) -> list[tuple[str, Column]]:
    """The eight Silver conditions for clickstream events."""
    return [
        ("bad_source", f("source") == F.lit(source)),
        ("missing_source_event_id", f("source_event_id").isNotNull()),
        ("missing_session_id", f("session_id").isNotNull()),
        ("key_not_session", key == f("session_id")),
        ("bad_event_type", f("event_type").isin(*EVENT_TYPES)),
        ("missing_event_timestamp", f("event_timestamp").isNotNull()),
        ("missing_product_id", f("product_id").isNotNull()),
        ("bad_price_bucket", f("price_bucket").isNull() | f("price_bucket").between(1, 10)),
    ]


def contract_rules(
    f: Field,
    categories: Sequence[str] = RETAIL_CATEGORIES,
    devices: Sequence[str] = DEVICES,
    id_pattern: str | None = UUID_PATTERN,
) -> list[tuple[str, Column]]:
    """C11: the full retail event contract (stricter than Silver R).

    A missing quantity takes the default 1 before the check (a null and a missing
    JSON field cannot be told apart in a column); ids and names must be non-empty;
    a NaN price is rejected; the category and device enums are parameters.
    """
    def non_empty(name: str) -> Column:
        return f(name).isNotNull() & (F.length(f(name)) >= 1)

    rules = [
        ("bad_event_type", f("event_type").isin(*EVENT_TYPES)),
        ("missing_event_timestamp", f("event_timestamp").isNotNull()),
        ("empty_customer_id", non_empty("customer_id")),
        ("empty_session_id", non_empty("session_id")),
        ("empty_product_id", non_empty("product_id")),
        ("empty_product_name", non_empty("product_name")),
        ("bad_category", f("category").isin(*categories)),
        # NaN sorts above every number in Spark, so "> 0" alone would accept it
        ("bad_unit_price", (f("unit_price") > 0) & ~F.isnan(f("unit_price"))),
        ("bad_quantity", F.coalesce(f("quantity"), F.lit(1)) > 0),
        ("bad_country", F.length(f("country")) == 2),
        ("bad_device", f("device").isin(*devices)),
    ]
    if id_pattern is not None:
        rules.insert(0, ("bad_event_id", f("event_id").isNotNull() & f("event_id").rlike(id_pattern)))
    return rules


def all_ok(rules: list[tuple[str, Column]]) -> Column:
    """Conjunction with SQL three-valued logic folded to false (null -> rejected)."""
    ok = None
    for _, cond in rules:
        ok = cond if ok is None else ok & cond
    return F.coalesce(ok, F.lit(False))


def reasons(rules: list[tuple[str, Column]]) -> Column:
    """Array of the names of the failed rules (a null condition counts as failed)."""
    return F.filter(
        F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(None)).otherwise(F.lit(name)) for name, cond in rules]),
        lambda x: x.isNotNull(),
    )


def flat(name: str) -> Column:
    return F.col(name)


def parse_and_keep(
    bronze: DataFrame,
    schema: StructType,
    lineage: Sequence[str],
    rules_for: Callable[[Field, Column], list[tuple[str, Column]]],
) -> DataFrame:
    """C1 + rule check + ``event.*`` flatten with a single JSON parse."""
    parsed = bronze.select(*lineage, F.from_json("raw_json", schema).alias("event"))
    rules = rules_for(lambda n: F.col("event").getField(n), F.col("kafka_key"))
    keep = F.col("event").isNotNull() & all_ok(rules)
    checked = parsed.select(*lineage, F.explode(F.when(keep, F.array(F.col("event")))).alias("event"))
    return checked.select(*lineage, "event.*")


def parse_with_reasons(
    bronze: DataFrame,
    schema: StructType,
    lineage: Sequence[str],
    rules_for: Callable[[Field, Column], list[tuple[str, Column]]],
) -> DataFrame:
    """Every parsed row with ``reasons`` (empty = valid).

    Null or empty text gives 'unparsable'. Text that did not parse cleanly (not an
    object, broken JSON, or a field of the wrong type) is captured by the parser's
    corrupt-record column and gets 'malformed_json' before the failed rules; a
    partially parsed record that still passes every rule stays valid, as in Silver.
    Rejected rows keep their ``raw_json`` so a quarantine can be replayed later.
    """
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    parsed = bronze.select(
        *lineage,
        "raw_json",
        F.from_json("raw_json", with_corrupt, {"columnNameOfCorruptRecord": CORRUPT}).alias("event"),
    )
    rules = rules_for(lambda n: F.col("event").getField(n), F.col("kafka_key"))
    failed = reasons(rules)
    malformed = F.col("event").getField(CORRUPT).isNotNull()
    why = (
        F.when(F.col("event").isNull(), F.array(F.lit("unparsable")))
        .when(malformed & (F.size(failed) > 0), F.concat(F.array(F.lit("malformed_json")), failed))
        .otherwise(failed)
    )
    fields = [F.col(f"event.{f.name}").alias(f.name) for f in schema.fields]
    return parsed.select(*lineage, "raw_json", *fields, why.alias("reasons"))
