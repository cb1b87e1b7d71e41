"""The stream's snapshots equal the table's."""

from pyspark.sql import functions as F

from tallyloom.streaming.snapshots import ticking_counts

PATH = "/root/testdata/sf0.001/events.parquet"


def test_stream_equals_table(spark, tmp_path):
    table = spark.read.parquet(PATH)
    timed = lambda d: d.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    want = sorted(tuple(r) for r in ticking_counts(timed(table), "ts", "user_id", "2 days", "1 day").collect())
    stream = timed(spark.readStream.schema(table.schema).parquet("/root/testdata/sf0.001/events*.parquet"))
    counts = ticking_counts(stream, "ts", "user_id", "2 days", "1 day")
    run = counts.writeStream.outputMode("complete").format("memory").queryName("ticks").trigger(availableNow=True)
    run.option("checkpointLocation", str(tmp_path)).start().awaitTermination(100)
    assert sorted(tuple(r) for r in spark.table("ticks").collect()) == want and len(want) > 100
