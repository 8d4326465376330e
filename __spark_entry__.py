"""

Every query reads the given tables (or tables Spark writes from them) in
full; nothing is sampled or capped except where a limit is the feature (a
sample, a top-n, the first keys to delete).  Queries that write (lake tables,
catalog tables, stream sinks) write below the session's shared work folder
(``spark.checkpoint.dir``), each call into a fresh folder.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

import oracle_queries  # noqa: E402
from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from rivulet.functions.ipv4 import IP_RANGES, int_to_ipv4  # noqa: E402
from rivulet.functions.sql_labels import register_labels  # noqa: E402
from rivulet.operators import etl, reports, rides  # noqa: E402
from rivulet.operators.bucketed import BucketedTable  # noqa: E402
from rivulet.operators.ip_tally import tally, tally_ranges  # noqa: E402
from rivulet.operators.lake import COMMIT, LakeTable  # noqa: E402
from rivulet.plans import catalog  # noqa: E402
from rivulet.session import delete_path, ensure_work_dir, list_names, work_path  # noqa: E402
from rivulet.sources import fixtures  # noqa: E402
from rivulet.sources.delimited import read_delimited, split_rejected, write_delimited  # noqa: E402
from rivulet.sources.json_lines import read_json_drifting, read_json_lines, write_json_lines  # noqa: E402
from rivulet.sources.message_log import FORMAT as MESSAGE_LOG, append_messages, read_message_log  # noqa: E402
from rivulet.sources.tables import load  # noqa: E402
from rivulet.sources.messages import encode_orders, write_message_files  # noqa: E402
from rivulet.streaming.orders import (  # noqa: E402
    active_queries, await_all, await_any, drain, order_stream, start_copy, start_json_print, start_upsert, typed_order_stream,
)
from rivulet.streaming.progress import BatchLog  # noqa: E402
from rivulet.streaming.table_tail import start_changes, start_tail  # noqa: E402

try:  # the training-data operators and their pipeline may be absent
    import corpus_pipeline  # noqa: E402
    from rivulet.llm import queries as llm_queries  # noqa: E402
except ImportError:
    corpus_pipeline = llm_queries = None

SMOKE_SF = "/root/testdata/sf0.001"

# Parameters of the table queries.
AS_OF = "2024-01-15 00:00:00"  # dashed spelling; stored form is 20240115000000000
INCREMENTAL_BEGIN = "20240120000000"
DELETE_COMMIT = "20240201000000"
UPSERT_SPLIT = "20240115000000"


# ----------------------------------------------------------------- helpers
def _rides(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.rides(spark, sf)


def _trip_table(spark: SparkSession, sf: str, kind: str = "mor", name: str = "trips") -> LakeTable:
    """The trip change log written as a lake table: one commit per day,
    deletes where the event is an error."""
    t = LakeTable(
        spark, work_path(spark, name), key="uuid", precombine="ts", partition="partitionpath",
        kind=kind, tiebreak=("event_id",),
    )
    t.write(fixtures.trip_log(spark, sf), commit_col="commit_time", delete_col="is_delete")
    return t


def _with_commit(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(COMMIT, "commit_time")


# ----------------------------------------------------------------- reports
def q_ride_by_product(spark, sf):
    return reports.by_product(_rides(spark, sf))


def q_ride_by_type(spark, sf):
    return reports.by_type(_rides(spark, sf))


def q_ride_by_traffic(spark, sf):
    return reports.by_traffic(_rides(spark, sf))


def q_ride_by_traffic_raw(spark, sf):
    return reports.by_traffic_raw(_rides(spark, sf))


def q_ride_price_bands(spark, sf):
    return reports.price_bands(_rides(spark, sf))


def q_ride_price_bands_sql(spark, sf):
    return reports.price_bands_sql(_rides(spark, sf))


def q_ride_distance_bands(spark, sf):
    return reports.distance_bands(_rides(spark, sf))


def q_ride_by_weekday(spark, sf):
    return reports.by_weekday(_rides(spark, sf))


def q_ride_sample(spark, sf):
    return reports.sample(_rides(spark, sf), 20)


def q_ride_labels_sql(spark, sf):
    """The labelled reports as SQL text over SQL label functions, called by name."""
    register_labels(spark)
    view = f"rides_{uuid.uuid4().hex[:8]}"
    _rides(spark, sf).createOrReplaceTempView(view)
    counts = "SELECT {0} AS code, count(*) AS total FROM {1} GROUP BY {0}"
    parts = (
        ("product", "product_label(code)", "product_id"), ("type", "realtime_label(code)", "type"),
        ("traffic", "traffic_label_or(code, '未知')", "traffic_type"),
        ("weekday", "weekday_label_strict(code)", "dayofweek(departure_time)"),
    )
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{name}' AS report, {label} AS label, total FROM ({counts.format(code, view)})" for name, label, code in parts
    ))


# ----------------------------------------------------------------- ETL / scans
def q_ride_etl(spark, sf):
    return etl.ride_etl(_rides(spark, sf)).select("order_id", "departure_time", "partitionpath", "ts")


def q_scan_delimited(spark, sf):
    path = write_delimited(_rides(spark, sf), work_path(spark, "rides-tsv"))
    return read_delimited(spark, path)


def q_scan_delimited_inferred(spark, sf):
    path = write_delimited(_rides(spark, sf), work_path(spark, "rides-tsv"))
    found = read_delimited(spark, path, schema=None)
    return found.select(
        F.col("order_id").cast("long").alias("order_id"), F.col("traffic_type").cast("long").alias("traffic_type"),
        "pre_total_fee", "bubble_trace_id", F.date_format("departure_time", "yyyy-MM-dd HH:mm:ss").alias("departure_time"),
    )


# Four columns of the ride file, and a line in 17 that lacks one, has one more, or
# has text for a number.
_SMALL_RIDE = "order_id long, product_id int, pre_total_fee double, departure_time string"


def _ride_lines(spark, sf):
    rides = _rides(spark, sf)
    text = [F.col("order_id").cast("string"), F.col("product_id").cast("string"), F.col("pre_total_fee").cast("string"), F.col("departure_time")]
    kind = F.col("order_id") % 17
    line = (
        F.when(kind == 0, F.concat_ws("\t", *text[:3]))
        .when(kind == 1, F.concat_ws("\t", *text, F.lit("more")))
        .when(kind == 2, F.concat_ws("\t", text[0], F.lit("many"), *text[2:]))
        .otherwise(F.concat_ws("\t", *text))
    )
    return rides.select("order_id", line.alias("value"))


def q_scan_rejected(spark, sf):
    """Good rows, and the rejected lines as they stood, from one scan: counts of both and
    the lines by what they lack."""
    names = "\t".join(f.split()[0] for f in _SMALL_RIDE.split(", "))
    path = work_path(spark, "rides-lines")
    # lines as they are under a header line in every file
    lines = _ride_lines(spark, sf).select(F.col("value").alias(names))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = T.DataType.fromDDL(_SMALL_RIDE)
    good, rejected = split_rejected(read_delimited(spark, path, schema, rejects=True), work_path(spark, "rides-split"))
    blank = F.lit(None).cast("string")
    return good.select("order_id", "product_id", "pre_total_fee", "departure_time", blank.alias("line")).unionByName(
        rejected, allowMissingColumns=True
    )


def q_scan_delimited_mixed(spark, sf):
    """A folder whose files differ in the order of their columns."""
    path = work_path(spark, "rides-mixed")
    rides = _rides(spark, sf)
    for part, names in ((0, rides.columns), (1, rides.columns[::-1])):
        write_delimited(rides.where(F.col("order_id") % 2 == part).select(*names), f"{path}/half{part}")
    return read_delimited(spark, path).select("order_id", "product_id", "pre_total_fee", "departure_time", "year", "traffic_type")


def q_scan_json_drifting(spark, sf):
    """Trips of which a third came with the fare as text, a third with a field more and a
    few as broken lines: one schema for all, what does not fit kept beside."""
    log = fixtures.trip_log(spark, sf)
    kind = F.col("event_id") % 3
    n = F.col("event_id")
    shapes = (
        F.when(n % 50 == 0, F.concat(F.lit("{\"event_id\": "), n.cast("string")))
        .when(kind == 0, F.to_json(F.struct("event_id", "uuid", "fare")))
        .when(kind == 1, F.to_json(F.struct("event_id", "uuid", F.concat(n.cast("string"), F.lit(" EUR")).alias("fare"))))
        .otherwise(F.to_json(F.struct("event_id", "uuid", "fare", F.struct(n.alias("tip"), F.lit("card").alias("paid")).alias("extra"))))
    )
    path = work_path(spark, "trips-drifting")
    log.select(shapes.alias("value")).write.text(path)
    rows = read_json_drifting(spark, path, preferred={"fare": "double"})
    return rows.select(
        "event_id", "uuid", F.col("fare"), F.col("extra.tip").alias("tip"), F.col("extra.paid").alias("paid"),
        F.col("_unfit")["fare"].alias("unfit_fare"), F.col("_unfit")[""].alias("broken"),
    )


def q_scan_json_lines(spark, sf):
    log = fixtures.trip_log(spark, sf).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    path = write_json_lines(log, work_path(spark, "trips-json"))
    return read_json_lines(spark, path).select("uuid", "partitionpath", "driver", "rider", "fare", "event_id")


def q_ride_store(spark, sf):
    """Delimited file -> ETL -> keyed table (one version per order per day)."""
    src = write_delimited(_rides(spark, sf), work_path(spark, "rides-tsv"))
    table = rides.store_rides(spark, src, work_path(spark, "rides-table"), commit="20240101000000")
    return table.snapshot().groupBy("partitionpath").agg(
        F.count(F.lit(1)).alias("n"), F.sum("product_id").alias("product_sum")
    )


def q_ride_reports_stored(spark, sf):
    """All eight reports over the stored table: ``(report, label, total)``."""
    src = write_delimited(_rides(spark, sf), work_path(spark, "rides-tsv"))
    rows = rides.report_input(rides.store_rides(spark, src, work_path(spark, "rides-table"), commit="20240101000000"))

    def listed(name, report):
        label, total = report.columns
        return report.select(F.lit(name).alias("report"), F.col(label).cast("string").alias("label"), F.col(total).alias("total"))

    def bands(name, report):
        pairs = F.array(*(F.struct(F.lit(c).alias("label"), F.col(f"`{c}`").alias("total")) for c in report.columns))
        return report.select(F.lit(name).alias("report"), F.explode(pairs).alias("b")).select("report", "b.label", "b.total")

    found = [
        listed("product", reports.by_product(rows)), listed("type", reports.by_type(rows)),
        listed("traffic", reports.by_traffic(rows)), listed("traffic_raw", reports.by_traffic_raw(rows)),
        listed("weekday", reports.by_weekday(rows)), bands("price", reports.price_bands(rows)),
        bands("price_sql", reports.price_bands_sql(rows)), bands("distance", reports.distance_bands(rows)),
    ]
    out = found[0]
    for report in found[1:]:
        out = out.unionByName(report)
    return out


# ----------------------------------------------------------------- lake table
def q_lake_insert(spark, sf):
    t = _trip_table(spark, sf)
    return t.log().groupBy(F.col(COMMIT).alias("commit_time")).agg(F.count(F.lit(1)).alias("n"))


def q_lake_precombine(spark, sf):
    t = _trip_table(spark, sf)
    return _with_commit(t.log()).select("commit_time", "uuid", "event_id")


def q_lake_snapshot(spark, sf):
    t = _trip_table(spark, sf)
    return _with_commit(t.snapshot()).select("uuid", "partitionpath", "driver", "rider", "fare", "commit_time")


def q_lake_upsert(spark, sf):
    t = LakeTable(
        spark, work_path(spark, "trips-cow"), key="uuid", precombine="ts", partition="partitionpath",
        kind="cow", tiebreak=("event_id",),
    )
    log = fixtures.trip_log(spark, sf)
    t.write(log.where(F.col("commit_time") <= UPSERT_SPLIT), commit_col="commit_time", delete_col="is_delete")
    t.write(log.where(F.col("commit_time") > UPSERT_SPLIT), commit_col="commit_time", delete_col="is_delete")
    return _with_commit(t.snapshot()).select("uuid", "partitionpath", "fare", "event_id", "commit_time")


def q_lake_append_same_commit(spark, sf):
    """The change feed written in two parts that share every commit; copy-on-write
    and merge-on-read."""
    log = fixtures.trip_log(spark, sf)
    out = None
    for kind in ("cow", "mor"):
        t = LakeTable(spark, work_path(spark, f"trips-{kind}"), key="uuid", precombine="ts",
                      partition="partitionpath", kind=kind, tiebreak=("event_id",))
        for part in (1, 0):
            t.write(log.where(F.col("event_id") % 2 == part), commit_col="commit_time", delete_col="is_delete")
        rows = _with_commit(t.snapshot()).select(F.lit(kind).alias("kind"), "uuid", "event_id", "commit_time")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_lake_partition_counts(spark, sf):
    t = _trip_table(spark, sf, kind="cow")
    return t.snapshot().groupBy("partitionpath").agg(F.count(F.lit(1)).alias("n"))


def q_lake_delete(spark, sf):
    t = _trip_table(spark, sf, kind="cow")
    before_commit = t.last_instant()
    victims = reports.top_n(t.snapshot(), [F.col("uuid")], 2).select("uuid", "partitionpath")
    t.delete(victims, commit=DELETE_COMMIT)
    before = t.as_of(before_commit).select(F.lit(1).alias("b"), F.lit(0).alias("a"))
    after = t.snapshot().select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    return before.unionByName(after).agg(
        F.sum("b").cast("long").alias("raw_count"), F.sum("a").cast("long").alias("after_count")
    )


def q_lake_delete_precombine(spark, sf):
    """Deletes where the greatest precombine value wins: every third key by a
    tombstone without one (it beats all commits up to its own), every next by one
    dated 2024-01-10 (it beats older rows only)."""
    t = LakeTable(spark, work_path(spark, "trips-precombine"), key="uuid", precombine="ts",
                  partition="partitionpath", kind="mor", merge="precombine", tiebreak=("event_id",))
    log = fixtures.trip_log(spark, sf)
    t.write(log, commit_col="commit_time", delete_col="is_delete")
    keys = log.select("uuid", "partitionpath").distinct()
    number = F.col("uuid").cast("long") % 3
    t.delete(keys.where(number == 0), commit="20240112000000")
    t.delete(keys.where(number == 1).withColumn("ts", F.lit("2024-01-10 00:00:00").cast("timestamp")), commit=DELETE_COMMIT)
    return _with_commit(t.snapshot()).select("uuid", "event_id", "commit_time")


def q_lake_overwrite(spark, sf):
    """The table replaced by its whole log, as one commit."""
    t = _trip_table(spark, sf)
    last = t.last_instant()
    t.overwrite(fixtures.trip_log(spark, sf).drop("commit_time", "is_delete"), commit=last)
    return _with_commit(t.snapshot()).select("uuid", "event_id", "commit_time")


def q_lake_as_of(spark, sf):
    t = _trip_table(spark, sf)
    return _with_commit(t.as_of(AS_OF)).select("uuid", "partitionpath", "fare", "commit_time")


def q_lake_as_of_recent(spark, sf):
    t = _trip_table(spark, sf)
    snap = _with_commit(t.as_of(AS_OF.replace("-", "").replace(" ", "").replace(":", "")))
    return reports.top_n(snap, [F.desc("commit_time"), F.asc("uuid")], 5).select("uuid", "commit_time")


def q_lake_incremental(spark, sf):
    t = _trip_table(spark, sf)
    view = f"trips_incremental_{uuid.uuid4().hex[:8]}"
    t.incremental(INCREMENTAL_BEGIN).createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT `_commit_time` AS commit_time, fare, begin_lon, begin_lat, "
        f"date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS ts FROM {view} WHERE fare > 20.0"
    )


def q_lake_incremental_from_commits(spark, sf):
    """Incremental read that begins at the oldest of the newest commits which rows
    of the snapshot come from."""
    t = _trip_table(spark, sf)
    rows = t.incremental(t.begin_instant(50))
    return _with_commit(rows).select("uuid", "fare", "commit_time").where("fare > 20.0")


def q_lake_commits(spark, sf):
    return _trip_table(spark, sf).commits(50)


def q_lake_bucketed_snapshot(spark, sf):
    """The change feed in two writes to a bucketed log; the state is reduced in place."""
    t = BucketedTable(spark, f"trips_{uuid.uuid4().hex[:8]}", work_path(spark, "trips-bucketed"), key="uuid",
                      precombine="ts", partition="partitionpath", tiebreak=("event_id",), buckets=8)
    log = fixtures.trip_log(spark, sf)
    for part in (log.where(F.col("commit_time") > UPSERT_SPLIT), log.where(F.col("commit_time") <= UPSERT_SPLIT)):
        t.write(part, commit_col="commit_time", delete_col="is_delete")
    return _with_commit(t.snapshot()).select("uuid", "partitionpath", "fare", "event_id", "commit_time")


def q_lake_count_footers(spark, sf):
    """Rows of the stored ride table, from the footers of its files."""
    table = LakeTable(spark, work_path(spark, "rides-counted"), key="order_id", precombine="ts", partition="partitionpath",
                      tiebreak=rides.RIDE_TIEBREAK)
    table.overwrite(etl.ride_etl(_rides(spark, sf)), commit="20240101000000")
    return table.footer_count()


def q_trips_fare_range(spark, sf):
    snap = _with_commit(_trip_table(spark, sf, kind="cow").snapshot())
    in_range = snap.where(F.col("fare").between(20, 50))
    return reports.top_n(
        in_range, [F.desc("fare"), F.desc("commit_time"), F.asc("uuid")], 20
    ).select("driver", "rider", "fare", "begin_lat", "begin_lon", "partitionpath", "commit_time")


# ----------------------------------------------------------------- catalog
_DB = "rivulet_db"


def _ride_catalog_table(spark, sf, register: str):
    rows = etl.ride_etl(_rides(spark, sf)).withColumn("date_str", F.col("partitionpath"))
    location = work_path(spark, "rides-catalog")
    # REBALANCE clusters rows by partition value (few files per partition);
    # AQE splits a hot day across tasks instead of sending it to one.
    rows.hint("rebalance", "date_str").write.mode("overwrite").partitionBy("date_str").parquet(location)
    catalog.create_database(spark, _DB, f"{ensure_work_dir(spark)}/warehouse/{_DB}.db")
    table = f"{_DB}.rides_{register}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # of an earlier run; its files are not the table's
    catalog.create_external_table(spark, table, rows.schema, "date_str", location)
    if register == "repair":
        catalog.repair(spark, table)
    else:
        catalog.add_partitions(
            spark, table, "date_str", catalog.discover_partition_dirs(spark, location, "date_str")
        )
    return table


def q_catalog_table(spark, sf):
    table = _ride_catalog_table(spark, sf, "repair")
    return spark.table(table).groupBy("date_str").agg(F.count(F.lit(1)).alias("n"))


def q_catalog_add_partitions(spark, sf):
    table = _ride_catalog_table(spark, sf, "add")
    return spark.table(table).drop("partitionpath", "ts")


def q_catalog_partitions(spark, sf):
    table = _ride_catalog_table(spark, sf, "repair")
    return catalog.show_partitions(spark, table)


# ----------------------------------------------------------------- messages / streams
def _message_files(spark, sf, broken_every=None):
    msgs = encode_orders(fixtures.order_msgs(spark, sf), broken_every=broken_every)
    return write_message_files(msgs, work_path(spark, "order-msgs"))


def q_encode_messages(spark, sf):
    msgs = encode_orders(fixtures.order_msgs(spark, sf))
    dec = msgs.select(
        F.col("key").cast("string").alias("key"),
        "topic", "partition", "offset", F.unix_millis("timestamp").alias("timestamp_ms"),
        F.from_json(F.col("value").cast("string"), etl.ORDER_JSON_SCHEMA).alias("j"),
    )
    return dec.select(
        "key", "topic", "partition", "offset", "timestamp_ms",
        F.col("j.orderId").alias("j_order_id"),
        F.col("j.userId").alias("j_user_id"),
        F.col("j.orderTime").alias("j_order_time"),
        F.col("j.ip").alias("j_ip"),
        F.col("j.orderMoney").alias("j_order_money"),
        F.col("j.orderStatus").alias("j_order_status"),
    )


def _order_table(spark, name, key, merge, tiebreak=()):
    return LakeTable(
        spark, work_path(spark, name), key=key, precombine="ts", partition="day",
        kind="mor", merge=merge, tiebreak=tiebreak,
    )


def q_stream_order_etl(spark, sf):
    src = _message_files(spark, sf)
    table = _order_table(spark, "orders-mor", "order_id", "commit")
    q = start_upsert(order_stream(spark, src), table, work_path(spark, "ckpt"), query_name=f"orders_{uuid.uuid4().hex[:6]}")
    await_all(spark, [q])
    return table.snapshot().select(
        "order_id", "user_id", "order_time", "ip", "topic", "partition", "offset",
        F.unix_millis("timestamp").alias("timestamp_ms"),
        F.col("order_money").cast("double").alias("order_money"),
        "order_status",
        F.unix_millis("ts").alias("ts_ms"),
        "day",
    )


def q_stream_json_tolerant(spark, sf):
    src = _message_files(spark, sf, broken_every=10)
    sink = work_path(spark, "orders-json-sink")
    q = start_json_print(spark, src, sink, work_path(spark, "ckpt"),
                         query_name=f"orders_json_{uuid.uuid4().hex[:6]}")
    await_all(spark, [q])
    return spark.read.parquet(sink).select(
        "orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus", "ts", "partition_day"
    )


def q_stream_upsert_typed(spark, sf):
    """Typed rows of the tolerant decode upserted by order id."""
    src = _message_files(spark, sf, broken_every=10)
    table = LakeTable(spark, work_path(spark, "orders-typed"), key="orderId", precombine="ts",
                      partition="partition_day", kind="mor")
    q = start_upsert(typed_order_stream(spark, src), table, work_path(spark, "ckpt"),
                     query_name=f"orders_typed_{uuid.uuid4().hex[:6]}")
    await_all(spark, [q])
    return table.snapshot().select(
        "orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus", "ts", "partition_day"
    )


def q_stream_upsert_mor(spark, sf):
    src = _message_files(spark, sf)
    table = _order_table(spark, "orders-by-user", "user_id", "precombine", tiebreak=("order_id",))
    q = start_upsert(order_stream(spark, src), table, work_path(spark, "ckpt"),
                     query_name=f"orders_user_{uuid.uuid4().hex[:6]}")
    await_all(spark, [q])
    return table.snapshot().select(
        "user_id", "day", "order_id", F.col("order_money").cast("double").alias("order_money")
    )


def q_stream_lake_read(spark, sf):
    t = _trip_table(spark, sf)
    sink = work_path(spark, "trips-tail")
    q = start_tail(t, sink, work_path(spark, "ckpt"), trigger="availableNow",
                   query_name=f"tail_{uuid.uuid4().hex[:6]}")
    await_all(spark, [q])
    rows = spark.read.parquet(sink)
    return rows.groupBy(F.col(COMMIT).alias("commit_time")).agg(
        F.count_distinct("_partition_path", "_record_key").alias("n")
    )


def q_stream_lake_changes(spark, sf):
    """The changes of a table that was written in two halves, of which one is written
    again, beside a write that fails: every row once."""
    t = LakeTable(spark, work_path(spark, "trips-changes"), key="uuid", precombine="ts", partition="partitionpath",
                  kind="mor", tiebreak=("event_id",))
    log = fixtures.trip_log(spark, sf)
    half = F.col("commit_time") <= UPSERT_SPLIT
    sink, ckpt = work_path(spark, "changes"), work_path(spark, "ckpt")

    def follow():
        q = start_changes(t, sink, ckpt, trigger="availableNow", query_name=f"changes_{uuid.uuid4().hex[:6]}")
        await_all(spark, [q])

    t.write(log.where(half), commit_col="commit_time", delete_col="is_delete", write_id="first")
    follow()
    try:  # a record without a key fails its write
        t.write(log.withColumn("uuid", F.when(F.col("event_id") % 7 > 0, F.col("uuid"))), commit_col="commit_time", delete_col="is_delete")
    except Exception as e:  # noqa: BLE001
        if "NULL record key" not in str(e):
            raise
    t.write(log.where(half), commit_col="commit_time", delete_col="is_delete", write_id="first")
    t.write(log.where(~half), commit_col="commit_time", delete_col="is_delete", write_id="second")
    follow()
    rows = spark.read.parquet(sink)
    return rows.groupBy(F.col(COMMIT).alias("commit_time")).agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------- message log
_TOPIC = "order-topic"


def _order_log(spark, sf, name="order-log", parts=3):
    """The order messages as a log, in as many commits."""
    path = work_path(spark, name)
    msgs = encode_orders(fixtures.order_msgs(spark, sf))
    for k in range(parts):
        append_messages(msgs.where(F.col("offset") % parts == k), path, _TOPIC)
    return path


def _copied(spark, path, **options):
    """All that a stream of the log gives now, by micro-batch."""
    sink, ckpt = work_path(spark, "log-copy"), work_path(spark, "ckpt")
    rows = read_message_log(spark, path, _TOPIC, progress=f"{ckpt}/planned", **options)
    drain(start_copy(rows, sink, ckpt, f"log_{uuid.uuid4().hex[:6]}"))
    return spark.read.parquet(sink)


def _third(spark, sf):
    return load(spark, sf, "events").count() // 3 + 1


def q_stream_log_orders(spark, sf):
    """Orders upserted from the log, a third of them a micro-batch."""
    ckpt = work_path(spark, "ckpt")
    msgs = read_message_log(spark, _order_log(spark, sf), _TOPIC, startingOffsets="earliest",
                            maxOffsetsPerTrigger=_third(spark, sf), progress=f"{ckpt}/planned")
    table = _order_table(spark, "orders-from-log", "order_id", "commit")
    drain(start_upsert(etl.order_etl(msgs), table, ckpt, query_name=f"orders_{uuid.uuid4().hex[:6]}", trigger="0 seconds"))
    return table.snapshot().select("order_id", "user_id", "order_time", "ip", "topic", "partition",
                                   F.unix_millis("timestamp").alias("timestamp_ms"), "order_status", "day")


def q_stream_log_batches(spark, sf):
    """Messages of each micro-batch under a cap."""
    rows = _copied(spark, _order_log(spark, sf), startingOffsets="earliest", maxOffsetsPerTrigger=_third(spark, sf))
    return rows.groupBy(F.col("batch").cast("long").alias("batch")).agg(F.count(F.lit(1)).alias("n"))


def q_stream_log_offsets(spark, sf):
    """Offsets of every topic partition, dense from 0."""
    rows = _copied(spark, _order_log(spark, sf), startingOffsets="earliest")
    return rows.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count_distinct("offset").alias("different"),
    )


def q_stream_log_latest(spark, sf):
    """A stream that starts at the latest offsets gives what comes after its start."""
    path, sink, ckpt = work_path(spark, "order-log"), work_path(spark, "log-copy"), work_path(spark, "ckpt")
    msgs = encode_orders(fixtures.order_msgs(spark, sf))
    append_messages(msgs.where(F.col("offset") % 2 == 0), path, _TOPIC)
    rows = read_message_log(spark, path, _TOPIC, progress=f"{ckpt}/planned")
    q = start_copy(rows, sink, ckpt, f"log_{uuid.uuid4().hex[:6]}")
    q.processAllAvailable()
    append_messages(msgs.where(F.col("offset") % 2 == 1), path, _TOPIC)
    drain(q)
    return spark.read.parquet(sink).select(F.col("key").cast("string").alias("order_id"), "partition")


def q_stream_log_loss(spark, sf):
    """A log that lost the files of its second commit, read on with the loss tolerated."""
    path = work_path(spark, "order-log")
    msgs, folder = encode_orders(fixtures.order_msgs(spark, sf)), f"{path}/{_TOPIC}/segments"
    kept: set[str] = set()
    for k in range(3):
        append_messages(msgs.where(F.col("offset") % 3 == k), path, _TOPIC)
        lost = set(list_names(spark, folder)) - kept if k == 1 else set()
        for name in lost:
            delete_path(spark, f"{folder}/{name}")
        kept |= set(list_names(spark, folder))
    rows = _copied(spark, path, startingOffsets="earliest", failOnDataLoss="false")
    return rows.select(F.col("key").cast("string").alias("order_id"), "partition")


def q_sink_log(spark, sf):
    """The log streamed into another log: the messages as they were, offsets by the sink."""
    source, target, ckpt = _order_log(spark, sf), work_path(spark, "order-log-copy"), work_path(spark, "ckpt")
    msgs = read_message_log(spark, source, _TOPIC, startingOffsets="earliest", maxOffsetsPerTrigger=_third(spark, sf),
                            progress=f"{ckpt}/planned")
    writer = msgs.select("key", "value", "partition", "timestamp").writeStream.format(MESSAGE_LOG)
    writer = writer.option("topic", _TOPIC).option("stream", ckpt).option("checkpointLocation", ckpt)
    drain(writer.queryName(f"sink_{uuid.uuid4().hex[:6]}").start(target))
    rows = _copied(spark, target, startingOffsets="earliest")
    last = F.max("offset").over(Window.partitionBy("topic", "partition"))
    return rows.select(
        F.col("key").cast("string").alias("key"), "topic", "partition", F.unix_millis("timestamp").alias("timestamp_ms"),
        F.get_json_object(F.col("value").cast("string"), "$.userId").alias("user_id"), (last + 1).alias("next_offset"),
    )


def q_stream_progress(spark, sf):
    """Two streams of the log at once: what was heard of them."""
    path = _order_log(spark, sf)
    marks = uuid.uuid4().hex[:6]
    with BatchLog(spark) as log:
        running = []
        for name in ("first", "second"):
            ckpt = work_path(spark, "ckpt")
            rows = read_message_log(spark, path, _TOPIC, startingOffsets="earliest", progress=f"{ckpt}/planned")
            running.append(start_copy(rows, work_path(spark, "log-copy"), ckpt, f"{name}_{marks}"))
        seen = set(active_queries(spark))
        for q in running:
            q.processAllAvailable()
        spark.streams.resetTerminated()
        running[0].stop()
        one_ended = await_any(spark, 60)
        running[1].stop()
        log.wait_ended([q.runId for q in running])
        batches, events = log.batches(), log.events()
    own = F.col("name").endswith(marks)
    short = F.regexp_extract("name", "^[a-z]+", 0)
    rows = batches.where(own).groupBy(short.alias("name")).agg(F.sum("input_rows").alias("input_rows"))
    heard = events.where(own).groupBy(short.alias("name")).agg(
        F.count_if(F.col("event") == "started").alias("started"), F.count_if(F.col("event") == "ended").alias("ended")
    )
    told = rows.join(heard, "name")
    return told.withColumn("active", F.lit(sum(n.endswith(marks) for n in seen))).withColumn("one_ended", F.lit(one_ended))


def q_ipv4_ranges_any_width(spark, sf):
    """The ten ranges beside the whole space, halves, one address and ranges with odd ends."""
    ips = load(spark, sf, "events").select(fixtures.order_ip("event_id").alias("ip"))
    more = [(-(2**31), 2**31 - 1), (0, 2**31 - 1), (-(2**31), -1), (607649793, 608174078), (-1, 0), (1038614528, 1038614528), (-570000001, 1783700001)]
    found = tally(ips, "ip", [*IP_RANGES, *more])
    return found.select(int_to_ipv4("lo").alias("range_start"), int_to_ipv4("hi").alias("range_end"), "total")


def q_ipv4_decode(spark, sf):
    """Every address of the orders as dotted text."""
    return load(spark, sf, "events").select("event_id", int_to_ipv4(fixtures.order_ip("event_id")).alias("ip"))


def q_ipv4_range_tally(spark, sf):
    ips = load(spark, sf, "events").select(fixtures.order_ip("event_id").alias("ip"))
    return tally_ranges(ips, "ip")


# ----------------------------------------------------------------- contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: rides per weekday at sf0.001."""
    return q_ride_by_weekday(spark, SMOKE_SF)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ride_by_product": q_ride_by_product,
    "ride_by_type": q_ride_by_type,
    "ride_by_traffic": q_ride_by_traffic,
    "ride_by_traffic_raw": q_ride_by_traffic_raw,
    "ride_price_bands": q_ride_price_bands,
    "ride_price_bands_sql": q_ride_price_bands_sql,
    "ride_distance_bands": q_ride_distance_bands,
    "ride_by_weekday": q_ride_by_weekday,
    "ride_sample": q_ride_sample,
    "ride_labels_sql": q_ride_labels_sql,
    "ride_etl": q_ride_etl,
    "scan_delimited": q_scan_delimited,
    "scan_delimited_inferred": q_scan_delimited_inferred,
    "scan_delimited_mixed": q_scan_delimited_mixed,
    "scan_rejected": q_scan_rejected,
    "scan_json_drifting": q_scan_json_drifting,
    "ride_store": q_ride_store,
    "ride_reports_stored": q_ride_reports_stored,
    "scan_json_lines": q_scan_json_lines,
    "lake_insert": q_lake_insert,
    "lake_precombine": q_lake_precombine,
    "lake_snapshot": q_lake_snapshot,
    "lake_upsert": q_lake_upsert,
    "lake_append_same_commit": q_lake_append_same_commit,
    "lake_partition_counts": q_lake_partition_counts,
    "lake_delete": q_lake_delete,
    "lake_delete_precombine": q_lake_delete_precombine,
    "lake_overwrite": q_lake_overwrite,
    "lake_as_of": q_lake_as_of,
    "lake_as_of_recent": q_lake_as_of_recent,
    "lake_incremental": q_lake_incremental,
    "lake_incremental_from_commits": q_lake_incremental_from_commits,
    "lake_commits": q_lake_commits,
    "trips_fare_range": q_trips_fare_range,
    "lake_bucketed_snapshot": q_lake_bucketed_snapshot,
    "lake_count_footers": q_lake_count_footers,
    "catalog_table": q_catalog_table,
    "catalog_add_partitions": q_catalog_add_partitions,
    "catalog_partitions": q_catalog_partitions,
    "encode_messages": q_encode_messages,
    "stream_order_etl": q_stream_order_etl,
    "stream_json_tolerant": q_stream_json_tolerant,
    "stream_upsert_typed": q_stream_upsert_typed,
    "stream_upsert_mor": q_stream_upsert_mor,
    "stream_lake_read": q_stream_lake_read,
    "stream_lake_changes": q_stream_lake_changes,
    "stream_log_orders": q_stream_log_orders,
    "stream_log_batches": q_stream_log_batches,
    "stream_log_offsets": q_stream_log_offsets,
    "stream_log_latest": q_stream_log_latest,
    "stream_log_loss": q_stream_log_loss,
    "sink_log": q_sink_log,
    "stream_progress": q_stream_progress,
    "ipv4_decode": q_ipv4_decode,
    "ipv4_range_tally": q_ipv4_range_tally,
    "ipv4_ranges_any_width": q_ipv4_ranges_any_width,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return dict(_QUERIES)
    return {**_QUERIES, **llm_queries.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.oracle_sql()
    if llm_queries is not None:
        found |= llm_queries.SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
