from zonelake.streaming import idempotent_sink

from tests.conftest import rows


def test_foreach_batch_sink_is_idempotent(spark, tmp_dir):
    src = tmp_dir + "/in"
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.parquet(src)
    table = tmp_dir + "/table"
    sink = idempotent_sink(table, ["id"], ["v"])
    for run in range(2):             # a replayed stream (same data, new checkpoint) adds nothing
        q = (spark.readStream.schema("id int, v string").parquet(src).writeStream
             .foreachBatch(sink).option("checkpointLocation", f"{tmp_dir}/ck{run}").trigger(availableNow=True).start())
        q.awaitTermination(120)
    assert rows(spark.read.parquet(table), "id") == [(1, "a"), (2, "b")]
