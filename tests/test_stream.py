"""Streams: stream == batch, restart from checkpoint adds nothing."""

from pyspark.sql import functions as F

from rivulet.operators.lake import LakeTable
from rivulet.session import work_path
from rivulet.sources import fixtures
from rivulet.sources.messages import encode_orders, write_message_files
from rivulet.streaming.orders import await_all, order_stream, start_upsert
from rivulet.streaming.table_tail import start_tail


def _orders_table(spark):
    return LakeTable(spark, work_path(spark, "orders"), key="user_id", precombine="ts",
                     partition="day", kind="mor", merge="precombine", tiebreak=("order_id",))


def test_stream_upsert_equals_batch_and_restart_is_noop(spark, sf_small):
    msgs = encode_orders(fixtures.order_msgs(spark, sf_small))
    src = write_message_files(msgs, work_path(spark, "msgs"), files=4)
    ckpt = work_path(spark, "ckpt")
    t = _orders_table(spark)
    await_all(spark, [start_upsert(order_stream(spark, src, max_files=1), t, ckpt, query_name="t_up_1")])
    first = sorted(tuple(r) for r in t.snapshot().select("user_id", "day", "order_id").collect())
    log_rows = t.log().count()
    assert t.log().select("_commit_time").distinct().count() == 4  # one commit per file / micro-batch

    # restart from the same checkpoint: nothing new to read, nothing written
    await_all(spark, [start_upsert(order_stream(spark, src, max_files=1), t, ckpt, query_name="t_up_2")])
    assert t.log().count() == log_rows

    # batch path over the same messages
    b = _orders_table(spark)
    from rivulet.operators.etl import order_etl
    b.write(order_etl(spark.read.parquet(src)), commit="20240101000000")
    batch = sorted(tuple(r) for r in b.snapshot().select("user_id", "day", "order_id").collect())
    assert first == batch


def test_table_tail_reads_every_commit(spark, sf_small):
    t = LakeTable(spark, work_path(spark, "trips"), key="uuid", precombine="ts",
                  partition="partitionpath", kind="mor", tiebreak=("event_id",))
    t.write(fixtures.trip_log(spark, sf_small), commit_col="commit_time", delete_col="is_delete")
    sink, ckpt = work_path(spark, "sink"), work_path(spark, "ckpt")
    await_all(spark, [start_tail(t, sink, ckpt, trigger="availableNow", max_files_per_trigger=8,
                                 query_name="t_tail")])
    got = spark.read.parquet(sink).groupBy("_commit_time").count()
    want = t.log().groupBy("_commit_time").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(sink).where(F.col("_op") == "D").count() > 0


def test_two_streams_into_one_table_keep_all_rows(spark, sf_small):
    orders = fixtures.order_msgs(spark, sf_small)
    t = LakeTable(spark, work_path(spark, "both"), key="order_id", precombine="ts", partition="day", kind="mor")
    for part in (0, 1):
        msgs = encode_orders(orders.where(F.col("event_id") % 2 == part))
        src = write_message_files(msgs, work_path(spark, "msgs"), files=3)
        q = start_upsert(order_stream(spark, src, max_files=1), t, work_path(spark, "ckpt"), query_name=f"t_part_{part}")
        await_all(spark, [q])
    assert t.snapshot().count() == orders.select("order_id").distinct().count()


def test_replayed_batch_goes_to_its_commit(spark):
    t = LakeTable(spark, work_path(spark, "replay"), key="k", precombine="v", partition="p", kind="mor")
    one = spark.createDataFrame([("a", 1, "p")], "k string, v int, p string")
    two = spark.createDataFrame([("b", 1, "p")], "k string, v int, p string")
    write, other = t.batch_writer("stream-1"), t.batch_writer("stream-2")
    write(one, 0)
    other(two, 0)
    write(one, 0)
    assert t.log().count() == 2 and t.log().select("_commit_time").distinct().count() == 2


def test_tail_follows_an_overwrite(spark):
    t = LakeTable(spark, work_path(spark, "turned"), key="k", precombine="v", partition="p", kind="mor")
    sink, ckpt = work_path(spark, "sink"), work_path(spark, "ckpt")
    rows = lambda k: spark.createDataFrame([(k, 1, "p")], "k string, v int, p string")
    t.write(rows("a"))
    await_all(spark, [start_tail(t, sink, ckpt, trigger="availableNow", query_name="t_turn_1")])
    t.overwrite(rows("b"))
    t.write(rows("c"))
    await_all(spark, [start_tail(t, sink, ckpt, trigger="availableNow", query_name="t_turn_2")])
    assert sorted(r.k for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_print_sinks(spark, sf_small):
    from rivulet.streaming.orders import active_queries, await_any, start_json_print

    src = write_message_files(encode_orders(fixtures.order_msgs(spark, sf_small), broken_every=10), work_path(spark, "msgs"))
    spark.streams.resetTerminated()
    q = start_json_print(spark, src, None, work_path(spark, "ckpt"), sink_format="memory", query_name="t_printed")
    assert await_any(spark, 120)
    await_all(spark, [q])
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    assert spark.table("t_printed").count() == events.where("event_id % 10 <> 0").count()
    assert "t_printed" not in active_queries(spark)
    await_all(spark, [start_json_print(spark, src, None, work_path(spark, "ckpt"), sink_format="console", query_name="t_console")])


def test_processing_time_trigger_and_active_queries(spark, sf_small):
    from rivulet.streaming.orders import active_queries

    msgs = encode_orders(fixtures.order_msgs(spark, sf_small))
    src = write_message_files(msgs, work_path(spark, "msgs"), files=2)
    t = _orders_table(spark)
    q = start_upsert(order_stream(spark, src, max_files=1), t, work_path(spark, "ckpt"),
                     query_name="t_continuous", trigger="1 second")
    try:
        assert "t_continuous" in active_queries(spark)
        q.processAllAvailable()
    finally:
        q.stop()
    assert t.log().select("_commit_time").distinct().count() == 2
    assert t.snapshot().count() == t.snapshot().select("day", "user_id").distinct().count() > 0
