"""A host's verdict does not depend on its share of the rows."""

import duckdb
import pytest

from cartwheel.llm import quality
from cartwheel.llm.oracle import OP5

GOOD = " ".join(f"word{k}" for k in range(60))


def table(bad_docs, fine_docs, hosts=20):
    """A bad host that fails 72 times in 100, and others that fail 30 times."""
    rows = [(i, "too short" if i % 100 < 72 else f"{GOOD} {i}", "bad") for i in range(bad_docs)]
    rows += [(10_000 + i, "too short" if (i // hosts) % 100 < 30 else f"{GOOD} {i}", f"fine{i % hosts}") for i in range(fine_docs)]
    return rows


def judged(spark, bad_docs, fine_docs):
    rows = table(bad_docs, fine_docs)
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep=["doc_id", "source"]).collect()
    return {name: any(r["__kept"] for r in got if r["source"] == name) for name in {r[2] for r in rows}}


@pytest.mark.parametrize("bad_docs, fine_docs", [(1000, 2000), (1000, 20_000)])
def test_a_bad_host_of_any_share_goes(spark, bad_docs, fine_docs):
    kept = judged(spark, bad_docs, fine_docs)
    assert not kept.pop("bad")
    assert all(kept.values())


def test_a_lone_host_stays(spark):
    assert judged(spark, 200, 0) == {"bad": True}


@pytest.mark.parametrize("bad_docs, fine_docs", [(1000, 2000), (1000, 20_000), (200, 0)])
def test_sql_says_the_same(spark, tmp_path, bad_docs, fine_docs):
    """OP5's SQL on tables with a bad host: the rule that the given tables never reach."""
    rows = table(bad_docs, fine_docs)
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.base_failed, r.kept) for r in quality.op5_quality_rules(spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = {(d, b, k) for d, b, k in db.execute(f"SELECT doc_id, base_failed, kept FROM ({OP5})").fetchall()}
    assert got == want
    assert any(not failed and not kept for _, failed, kept in got) == (fine_docs > 0)
