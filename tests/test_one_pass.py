"""The one-pass Silver writer: layers, lookups of earlier ids, restarts, hot ids, compaction."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.schemas import BRONZE_SCHEMA
from cartwheel.streaming import one_pass
from cartwheel.streaming.ledger import Ledger
from cartwheel.streaming.one_pass import OnePassSilver, click_family, routed, silver_of
from cartwheel.streaming.runner import run_to_completion
from cartwheel.streaming.silver import silver_click
from tests.test_streaming import BATCHES, T, click_json, ids, write_batches


def stream(spark, folder):
    return spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(folder)


def ran(spark, folder, out, dedup="watermark", **kwargs):
    writer = OnePassSilver(spark, out, click_family(), dedup, **kwargs)
    writer.run(stream(spark, folder), out + "-ckpt")
    return writer


@pytest.mark.parametrize("dedup, silver", [("watermark", ["A", "A", "B", "C", "E"]), ("exact", ["A", "B", "C", "E"])])
def test_layers_of_four_batches(spark, tmp_dir, dedup, silver):
    write_batches(f"{tmp_dir}/in", [*BATCHES[:3], [*BATCHES[3], ("wrong", click_json("W", T(12))), ("s1", "{bad")]])
    w = ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", dedup)
    assert ids(w.silver()) == silver
    assert ids(w.late()) == ["D"]
    rejected = {(r.raw_json == "{bad", tuple(r.reasons)[0]) for r in w.quarantine().collect()}
    assert rejected == {(True, "malformed_json"), (False, "key_not_session")}
    rows = {r.batch_id: r for r in w.batches().collect()}
    assert [rows[i].rows_in for i in range(4)] == [3, 1, 2, 3]
    assert [rows[i].duplicates for i in range(4)] == [1, 0, 0, int(dedup == "exact")]
    assert [rows[i].late for i in range(4)] == [0, 0, 1, 0]
    assert rows[0].watermark is None and rows[2].watermark == dt.datetime(2024, 1, 1, 11, 30)
    for r in rows.values():
        assert r.rows_in == r.silver + r.quarantine + r.late + r.duplicates


@pytest.mark.parametrize("dedup", ["watermark", "exact"])
def test_against_a_plain_model(spark, tmp_dir, dedup):
    """Random batches with repeats and late rows against the rules, row by row."""
    rng = random.Random(2)
    batches = []
    for n in range(5):
        batches.append([(f"e{rng.randrange(25)}", 10 + n // 2, rng.randrange(60)) for _ in range(12)])
    write_batches(f"{tmp_dir}/in", [[("s1", click_json(e, T(h, m))) for e, h, m in b] for b in batches])
    w = ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", dedup)
    kept, late, seen, latest = [], [], {}, None
    delay = dt.timedelta(minutes=30)
    for b in batches:
        mark = None if latest is None else latest - delay
        fresh = {}
        for e, h, m in b:
            t = T(h, m)
            if mark is not None and t <= mark:
                late.append((e, t))
            elif e not in fresh and not any(dedup == "exact" or s + delay > mark for s in seen.get(e, [])):
                fresh[e] = t
            latest = t if latest is None or t > latest else latest
        for e, t in fresh.items():
            seen.setdefault(e, []).append(t)
            kept.append((e, t))

    def rows(df):
        return sorted((r[0], r[1].replace(tzinfo=dt.timezone.utc)) for r in df.select("source_event_id", "event_timestamp").collect())

    assert rows(w.silver()) == sorted(kept)
    assert rows(w.late()) == sorted(late) and late


def test_equals_the_stateful_operator(spark, tmp_dir):
    """On batches whose times only go forward, Spark's operator keeps the same ids."""
    rng = random.Random(3)
    batches = [[("s1", click_json(f"e{rng.randrange(40)}", T(8 + n, rng.randrange(20)))) for _ in range(15)] for n in range(4)]
    write_batches(f"{tmp_dir}/in", batches)
    w = ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", "exact")
    run_to_completion(silver_click(stream(spark, f"{tmp_dir}/in"), dedup="exact"), f"{tmp_dir}/state", f"{tmp_dir}/state-ckpt")
    assert ids(w.silver()) == ids(spark.read.parquet(f"{tmp_dir}/state"))


def test_one_scan_and_one_parse(spark, tmp_dir):
    """All layers of a batch come from one read and one parse of Bronze."""
    write_batches(f"{tmp_dir}/in", BATCHES)
    bronze = spark.read.schema(BRONZE_SCHEMA).parquet(f"{tmp_dir}/in")
    plan = routed(bronze, click_family(), F.lit(None).cast("timestamp"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("Relation [") == 1


@pytest.mark.parametrize("step", ["layers", "marker"])
def test_a_killed_batch_leaves_nothing(spark, tmp_dir, monkeypatch, step):
    """A batch that dies before its marker is invisible, and is written anew on restart."""
    write_batches(f"{tmp_dir}/in", BATCHES)
    out, real = f"{tmp_dir}/out", (Ledger.stored, Ledger.commit)
    calls = {"n": 0}

    def dies(self, batch_id, **values):
        if batch_id == 2 and not calls["n"]:
            calls["n"] += 1
            raise RuntimeError("killed")
        return real[1](self, batch_id, **values)

    def dies_early(self, base, paths):
        paths = list(paths)
        if any("batch_id=2" in p for p in paths) and not calls["n"]:
            calls["n"] += 1
            raise RuntimeError("killed")
        return real[0](self, base, paths)

    monkeypatch.setattr(Ledger, "commit" if step == "marker" else "stored", dies if step == "marker" else dies_early)
    with pytest.raises(Exception, match="killed"):
        ran(spark, f"{tmp_dir}/in", out)
    w = OnePassSilver(spark, out, click_family())
    assert ids(w.silver()) == ["A", "B", "C"] and ids(w.late()) == [] and w.batches().count() == 2
    w = ran(spark, f"{tmp_dir}/in", out)
    assert ids(w.silver()) == ["A", "A", "B", "C", "E"] and ids(w.late()) == ["D"]
    ran(spark, f"{tmp_dir}/in", out)  # nothing new: nothing is written
    assert w.batches().count() == 4


def test_a_batch_that_comes_again_is_passed_over(spark, tmp_dir, monkeypatch):
    """Killed after the marker, before the query's own commit: the batch is not doubled."""
    write_batches(f"{tmp_dir}/in", BATCHES)
    real, calls = Ledger.commit, {"n": 0}

    def dies_after(self, batch_id, **values):
        marker = real(self, batch_id, **values)
        if batch_id == 1 and not calls["n"]:
            calls["n"] += 1
            raise RuntimeError("killed")
        return marker

    monkeypatch.setattr(Ledger, "commit", dies_after)
    with pytest.raises(Exception, match="killed"):
        ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    w = ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    assert ids(w.silver()) == ["A", "A", "B", "C", "E"]
    assert [r.batch_id for r in w.batches().orderBy("batch_id").collect()] == [0, 1, 2, 3]


def test_another_checkpoint_needs_another_folder(spark, tmp_dir):
    write_batches(f"{tmp_dir}/in", BATCHES[:1])
    ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    writer = OnePassSilver(spark, f"{tmp_dir}/out", click_family())
    with pytest.raises(Exception, match="needs a new folder"):
        writer.run(stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/other-ckpt")


def test_a_batch_without_valid_rows(spark, tmp_dir):
    write_batches(f"{tmp_dir}/in", [[("s1", "{bad")], [("s1", click_json("A", T(10)))], [("s1", None)]])
    w = ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    assert ids(w.silver()) == ["A"] and w.quarantine().count() == 2


def test_earlier_ids_are_pruned_by_date(spark, tmp_dir):
    """Only the folders of dates in which a repeat can lie are read."""
    days = [[("s1", click_json(f"e{d}", dt.datetime(2024, 1, d, 12, tzinfo=dt.timezone.utc)))] for d in range(1, 6)]
    write_batches(f"{tmp_dir}/in", days)
    for dedup, horizon, dates in (("watermark", None, 1), ("exact", 2, 3), ("exact", None, 5)):
        w = ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/{dedup}{horizon}", dedup, horizon_days=horizon)
        assert ids(w.silver()) == [f"e{d}" for d in range(1, 6)]
        mark = int(dt.datetime(2024, 1, 5, 11, 30, tzinfo=dt.timezone.utc).timestamp() * 1e6)
        earlier = w._earlier_ids(w.ledger, mark)
        assert earlier.count() == dates
        assert earlier._jdf.queryExecution().executedPlan().toString().count("event_date") >= 1
    scan = w._earlier_ids(w.ledger, mark)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source_event_id:string>" in scan


def test_hot_id_makes_no_heavy_task(spark, tmp_dir):
    """An id with a third of a batch reaches the shuffle as one row a task."""
    rows = [("s1", click_json("hot" if i % 3 == 0 else f"e{i}", T(10))) for i in range(3000)]
    write_batches(f"{tmp_dir}/in", [rows])
    bronze = spark.read.schema(BRONZE_SCHEMA).parquet(f"{tmp_dir}/in").repartition(6)
    one = routed(bronze, click_family(), F.lit(None).cast("timestamp"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") == 1
    assert one.where("source_event_id = 'hot'").select("copies").first()[0] == 1000
    assert one.count() == 2001


def test_compaction_switches_readers_at_once(spark, tmp_dir):
    write_batches(f"{tmp_dir}/in", BATCHES)
    w = ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    before, silver = w.silver(), ids(w.silver())
    counts = sorted(map(str, w.batches().collect()))
    assert w.ledger.compact() == 1 and w.ledger.compact() is None
    assert ids(before) == silver == ids(w.silver())  # a reader of before, and one of now
    # more batches after it, then a second version; the old files go
    write_batches(f"{tmp_dir}/more", [[("s1", click_json("F", T(13))), ("s1", click_json("C", T(12)))]])
    import os

    os.utime(f"{tmp_dir}/more/batch-000.parquet", (1_800_000_000, 1_800_000_000))
    os.rename(f"{tmp_dir}/more/batch-000.parquet", f"{tmp_dir}/in/batch-900.parquet")
    removed = w.ledger.clean()
    assert len(removed) >= 8 and not os.path.exists(f"{tmp_dir}/out/staged/batch_id=0")
    w = ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    assert ids(w.silver()) == [*silver, "F"] and ids(w.late()) == ["D"]  # C is found in the compacted version
    assert sorted(map(str, w.batches().where("batch_id < 4").collect())) == counts
    assert w.ledger.compact() == 2
    assert ids(w.silver()) == [*silver, "F"]
    assert ids(silver_of(spark, f"{tmp_dir}/out", click_family())) == [*silver, "F"]


def test_a_killed_compaction_changes_nothing(spark, tmp_dir, monkeypatch):
    write_batches(f"{tmp_dir}/in", BATCHES)
    w = ran(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    silver = ids(w.silver())
    # files of a compaction that died before its marker
    w.ledger._of_batches("silver", w.ledger.markers())[0].write.partitionBy("layer", "event_date").parquet(
        f"{tmp_dir}/out/compacted/version=1")
    assert ids(w.silver()) == silver
    assert w.ledger.compact() == 1 and ids(w.silver()) == silver


def test_unknown_mode(spark, tmp_dir):
    with pytest.raises(ValueError, match="unknown dedup mode"):
        one_pass.OnePassSilver(spark, tmp_dir, click_family(), "sometimes")
