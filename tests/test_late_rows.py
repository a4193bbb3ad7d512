"""Late rows of a bounded run of more micro-batches than Spark remembers."""

from cartwheel.schemas import BRONZE_SCHEMA
from cartwheel.streaming import silver
from tests.test_streaming import T, click_json, write_batches


def test_late_rows_of_more_than_100_batches(spark, tmp_dir):
    batches = [[("s1", click_json("first", T(12)))], [("s1", click_json("second", T(12)))]]
    batches += [[("s1", click_json(f"late{i}", T(9)))] for i in range(30)]
    batches += [[("s1", click_json(f"on{i}", T(12)))] for i in range(110)]
    write_batches(f"{tmp_dir}/in", batches)
    stream = spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(f"{tmp_dir}/in")
    late = silver.run_silver(silver.silver_click(stream), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 112
    assert late == 30
