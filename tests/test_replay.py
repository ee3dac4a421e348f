"""Replaying a table: its work is spread over files of bounded size."""

from pyspark.sql import functions as F

from sensorium.sources import replay


def test_batches_are_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "FILE_ROWS", 100)
    df = spark.range(0, 1000, 1, 1).select("id", (F.col("id") * 3 / 1000).cast("long").alias("batch"))
    out = replay.run_replay(df, lambda s: s, root=str(tmp_path))
    assert sorted(r.id for r in out.collect()) == list(range(1000))
    for folder in ("staged", "stream"):
        files = spark.read.parquet(f"{tmp_path}/{folder}").groupBy(F.input_file_name()).count().collect()
        assert len(files) >= 10 and max(r["count"] for r in files) <= 100
