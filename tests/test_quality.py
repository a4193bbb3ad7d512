import datetime as dt

import pytest

from cartwheel.operators.quality import contract_violations, journey_consistency, split_by_contract
from pyspark.sql.types import StructField, StructType

from cartwheel.schemas import EVENT_SCHEMA

BASE = dict(event_id="7d1f0a52-93c4-4c1e-8b57-6e0f9a1b2c3d", event_type="remove_from_cart",
            event_timestamp=dt.datetime(2023, 6, 5, 7, 8), customer_id="c77", session_id="visit-5",
            product_id="sku-9", product_name="Wool scarf", category="accessory",
            unit_price=12.5, quantity=2, country="NL", device="desktop")


def events(spark, *overrides):
    rows = []
    for i, o in enumerate(overrides):
        r = dict(BASE, **o)
        rows.append(tuple(r[f] for f in EVENT_SCHEMA.fieldNames()))
    nullable = StructType([StructField(f.name, f.dataType, True) for f in EVENT_SCHEMA.fields])
    return spark.createDataFrame(rows, nullable)


@pytest.mark.parametrize("change, rule", [
    ({}, None),
    ({"unit_price": 0.0}, "bad_unit_price"),
    ({"unit_price": -3.0}, "bad_unit_price"),
    ({"quantity": -1}, "bad_quantity"),
    ({"event_type": "wish"}, "bad_event_type"),
    ({"event_timestamp": None}, "missing_event_timestamp"),
    ({"session_id": ""}, "empty_session_id"),
    ({"product_id": None}, "empty_product_id"),
    ({"product_name": ""}, "empty_product_name"),
    ({"category": "garden"}, "bad_category"),
])
def test_one_broken_field_breaks_one_rule(spark, change, rule):
    assert [r.violations for r in contract_violations(events(spark, change)).collect()] == ([rule] if rule else [])


def test_missing_quantity_defaults_to_one_and_reasons_are_ordered(spark):
    df = events(spark, {"quantity": None}, {"event_id": "x", "country": "FRA", "device": "tv", "customer_id": ""})
    out = {r.event_id: r.violations for r in contract_violations(df).collect()}
    assert out == {"x": "bad_event_id,empty_customer_id,bad_country,bad_device"}
    ok, bad = split_by_contract(df)
    assert ok.count() == 1 and bad.count() == 1


J = "session_id string, event_id string, event_type string, event_timestamp timestamp, customer_id string, country string, device string"


def test_journey_rules(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 10, m)
    rows = [
        ("good", "1", "product_view", t(0), "c", "FR", "mobile"),
        ("good", "2", "add_to_cart", t(1), "c", "FR", "mobile"),
        ("good", "3", "purchase", t(2), "c", "FR", "mobile"),
        ("cartless", "1", "product_view", t(0), "c", "FR", "mobile"),
        ("cartless", "2", "purchase", t(1), "c", "FR", "mobile"),
        ("late_cart", "1", "product_view", t(0), "c", "FR", "mobile"),
        ("late_cart", "2", "purchase", t(1), "c", "FR", "mobile"),
        ("late_cart", "3", "add_to_cart", t(2), "c", "FR", "mobile"),
        ("mixed", "1", "add_to_cart", t(0), "c", "FR", "mobile"),
        ("mixed", "2", "product_view", t(1), "d", "DE", "tablet"),
    ]
    out = {r.session_id: r.violations for r in journey_consistency(spark.createDataFrame(rows, J)).collect()}
    assert out == {
        "cartless": "purchase_without_prior_cart",
        "late_cart": "purchase_without_prior_cart",
        "mixed": "first_event_not_view,several_customers,several_countries,several_devices",
    }


def test_uuid_forms_and_nan_price(spark):
    plain = BASE["event_id"]
    forms = [plain.replace("-", "").upper(), "{" + plain + "}", "urn:uuid:" + plain]
    df = events(spark, *[{"event_id": f} for f in forms], {"event_id": "7d1f0a52-93c4"},
                {"unit_price": float("nan")})
    out = {r.event_id: r.violations for r in contract_violations(df).collect()}
    assert out == {"7d1f0a52-93c4": "bad_event_id", BASE["event_id"]: "bad_unit_price"}
