import pytest

from cartwheel.operators.gold import build_category_metrics, build_funnel, build_price_bucket_metrics
from cartwheel.operators.report import (
    GoldMissingError,
    funnel_stages,
    kpi_strip,
    load_gold_tables,
    purchases_by_segment,
    top_categories,
    write_gold_tables,
)

COLS = "session_id string, product_id string, category_hash string, price_bucket int, event_type string"


def events(spark):
    rows = []
    for i in range(14):
        cat = None if i == 13 else f"category_{i:02d}_long_hash"
        for j in range(i + 1):
            rows.append((f"s{i}-{j}", f"p{i}", cat, (i % 10) + 1 if i != 12 else None, "purchase"))
        rows.append((f"s{i}", f"p{i}", cat, 1, "product_view"))
    for k in range(1200):
        rows.append((f"bulk{k}", "px", "category_00_long_hash", 2, "product_view"))
    return spark.createDataFrame(rows, COLS)


def test_write_and_load_gold_then_reports(spark, tmp_dir):
    ev = events(spark)
    write_gold_tables(build_funnel(ev), build_category_metrics(ev), build_price_bucket_metrics(ev), f"{tmp_dir}/gold")
    funnel, categories, buckets = load_gold_tables(spark, f"{tmp_dir}/gold")
    top = top_categories(categories).collect()
    assert len(top) == 10
    assert [r.purchases for r in top] == sorted(r.purchases for r in top)
    assert top[-1].category_display == "Unknown"  # null category had the most purchases (14)
    assert top[0].category_display == "category_04_…"
    stages = {r.Stage: r.Count for r in funnel_stages(funnel).collect()}
    f = funnel.first()
    assert stages == {"Sessions": f.total_sessions, "Added to cart": 0, "Purchased": f.purchase_sessions}
    k = kpi_strip(funnel).first()
    assert k.sessions == f"{f.total_sessions:,}" and "," in k.events
    assert k.view_to_cart == "0.00%"
    segs = [r.price_segment for r in purchases_by_segment(buckets).collect()]
    assert segs[-1] == "unknown" and segs[:3] == ["1", "2", "3"]


def test_missing_gold_is_reported(spark, tmp_dir):
    with pytest.raises(GoldMissingError):
        load_gold_tables(spark, f"{tmp_dir}/nothing")
