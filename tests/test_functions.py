"""Column helpers: IPv4, date paths, epoch, JSON tolerance."""

import random

import pytest
from pyspark.sql import functions as F

from rivulet.functions import dash_path, epoch_seconds, int_to_ipv4, ipv4_to_int, normalize_instant
from rivulet.functions.ipv4 import IP_RANGES
from rivulet.functions.labels import PRODUCT_LABELS, TRAFFIC_LABELS, WEEKDAY_LABELS
from rivulet.functions.sql_labels import register_label, register_labels
from rivulet.operators.etl import order_etl, order_json_etl, ride_etl
from rivulet.operators import ip_tally
from rivulet.operators.ip_tally import range_blocks, tally, tally_ranges
from rivulet.sources.messages import MESSAGE_SCHEMA


def test_int_to_ipv4_signed(spark):
    df = spark.createDataFrame([(-1950089216,), (-564133889,), (607649792,), (0,), (-1,)], "ip int")
    got = [r[0] for r in df.select(int_to_ipv4("ip")).collect()]
    assert got == ["139.196.0.0", "222.95.255.255", "36.56.0.0", "0.0.0.0", "255.255.255.255"]
    back = [r[0] for r in df.select(ipv4_to_int(int_to_ipv4("ip"))).collect()]
    assert back == [-1950089216, -564133889, 607649792, 0, -1]


def _blocks_of(spark, ranges):
    out = {}
    for r in range_blocks(spark, ranges).collect():
        first = (r.prefix << r.level) - 2**31
        out.setdefault((r.lo, r.hi), []).append((first, first + (1 << r.level) - 1))
    return {k: sorted(v) for k, v in out.items()}


def test_range_blocks_cover_their_range_once(spark):
    r = random.Random(3)
    ends = [-(2**31), -1, 0, 1, 2**31 - 1]
    ranges = {*IP_RANGES, *((a, b) for a in ends for b in ends if a <= b), (-(2**31) + 1, 2**31 - 2)}
    ranges |= {tuple(sorted((r.randrange(-(2**31), 2**31), r.randrange(-(2**31), 2**31)))) for _ in range(60)}
    found = _blocks_of(spark, sorted(ranges))
    assert set(found) == ranges
    for (lo, hi), blocks in found.items():
        assert blocks[0][0] == lo and blocks[-1][1] == hi and len(blocks) <= 62
        assert all(a[1] + 1 == b[0] for a, b in zip(blocks, blocks[1:]))
    assert len(found[(-(2**31), 2**31 - 1)]) == 1 and len(found[(-(2**31) + 1, 2**31 - 2)]) == 62
    assert range_blocks(spark, [(5, 4)]).count() == 0


def test_tally_counts_every_range(spark):
    r = random.Random(4)
    ips = [r.randrange(-(2**31), 2**31) for _ in range(400)] + [7] * 300 + [None]
    ranges = [(-(2**31), 2**31 - 1), (7, 7), (0, 6), (-5, 8), (100, 50)] + [tuple(sorted(r.sample(range(-(2**31), 2**31), 2))) for _ in range(20)]
    want = {(lo, hi): n for lo, hi in ranges if (n := sum(ip is not None and lo <= ip <= hi for ip in ips))}
    rows = spark.createDataFrame([(ip,) for ip in ips], "ip int")
    assert {(x.lo, x.hi): x.total for x in tally(rows, "ip", ranges).collect()} == want
    listed = spark.createDataFrame(ranges, "lo int, hi int")
    assert {(x.lo, x.hi): x.total for x in tally(rows, "ip", listed).collect()} == want
    assert tally(rows, "ip", [(5, 4)]).count() == 0


@pytest.mark.parametrize("sent", [ip_tally.SENT, 3])
def test_tally_never_broadcasts_the_counts(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(ip_tally, "SENT", sent)
    path = str(tmp_path / "ips")
    spark.range(5000).selectExpr("CAST(id * 858993 - 2147483648 AS INT) AS ip").coalesce(1).write.parquet(path)
    rows = spark.read.parquet(path)
    ips = [r.ip for r in rows.collect()]
    ranges = [(-(2**31), 2**31 - 1), (ips[7], ips[7]), (-5, 10**9), (ips[9] + 1, ips[4000])]
    found = tally(rows, "ip", ranges)
    assert {(x.lo, x.hi): x.total for x in found.collect()} == {(lo, hi): sum(lo <= ip <= hi for ip in ips) for lo, hi in ranges}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and ("BuildRight" if sent > 3 else "SortMergeJoin") in plan, plan


def test_label_functions_inline_their_case(spark):
    names = register_labels(spark)
    assert len(names) == 12
    got = spark.sql(
        "SELECT product_label(code) AS a, product_label_or(code, 'other') AS b, weekday_label(code) AS c "
        "FROM VALUES (1), (9), (CAST(NULL AS INT)) AS t(code)"
    )
    assert [tuple(r) for r in got.collect()] == [
        (PRODUCT_LABELS[1], PRODUCT_LABELS[1], WEEKDAY_LABELS[1]), (None, "other", None), (None, "other", None)
    ]
    rows = spark.range(5).selectExpr("CAST(id % 3 AS INT) AS code")
    rows.createOrReplaceTempView("label_codes")
    strict = spark.sql("SELECT traffic_label_strict(code) AS label FROM label_codes")
    assert {r.label for r in strict.collect()} == {TRAFFIC_LABELS[k] for k in range(3)}
    plan = strict._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "traffic_label_strict" not in plan and "Python" not in plan
    with pytest.raises(Exception, match="unlisted code: 9"):
        spark.sql("SELECT product_label_strict(9)").collect()
    assert spark.sql("SELECT product_label_strict(CAST(NULL AS INT))").first()[0] is None
    register_label(spark, "odd_label", {1: "it's", 2: "a\\b"})
    assert tuple(spark.sql("SELECT odd_label(1), odd_label(2)").first()) == ("it's", "a\\b")


def test_tally_edges(spark):
    lo, hi = IP_RANGES[5]
    df = spark.createDataFrame([(lo,), (hi,), (hi + 1,), (lo - 1,), (None,)], "ip int")
    got = [tuple(r) for r in tally_ranges(df, "ip").collect()]
    assert got == [("139.196.0.0", 2)]


def test_dash_path_and_epoch(spark):
    df = spark.createDataFrame(
        [(2017, 5, 22, "2017-05-22 10:00:00"), (2017, None, 22, "0000-00-00 00:00:00")],
        "year int, month int, day int, departure_time string",
    )
    rows = ride_etl(df).collect()
    assert rows[0]["partitionpath"] == "2017-5-22"
    assert rows[0]["ts"] == 1495447200
    assert rows[1]["partitionpath"] is None and rows[1]["ts"] is None
    assert "year" not in ride_etl(df).columns
    _ = dash_path, epoch_seconds


def test_normalize_instant():
    assert normalize_instant("2021-12-25 15:20:16") == "20211225152016000"
    assert normalize_instant("20211225152016") == "20211225152016000"
    assert normalize_instant("2021-12-25 15:20:16.25") == "20211225152016250"


def _messages(spark, values):
    rows = [(b"k%d" % i, v.encode() if v is not None else None, "t", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def test_json_tolerant_parsing(spark):
    msgs = _messages(
        spark,
        [
            '{"orderId":"20211122103434136000001","userId":"300000001","orderTime":"2021-11-22 10:34:34.136",'
            '"ip":"1.2.3.4","orderMoney":12.5,"orderStatus":0}',
            '{"orderId":"20211122103434136000002","orderTime":"2021-11-22 10:34:34.137","orderMoney":"x"}',
            '{"orderId": "broken',
            "not json",
        ],
    )
    rows = order_json_etl(msgs).orderBy("orderId").collect()
    assert len(rows) == 2  # malformed rows are skipped
    assert rows[0]["ts"] == "20211122103434136" and rows[0]["partition_day"] == "2021-11-22"
    assert rows[1]["ip"] is None and rows[1]["orderMoney"] is None  # missing / wrong type -> NULL


def test_order_etl_text_fields(spark):
    msgs = _messages(spark, ['{"userId":"1","orderTime":"2021-11-22 10:34:34.136","orderMoney":12.50,"orderStatus":1}'])
    r = order_etl(msgs).first()
    assert r["order_id"] == "k0" and r["order_money"] == "12.5" and r["order_status"] == "1"
    assert r["ip"] is None and r["day"] == "2021-11-22"
    assert r["ts"] is not None
    assert order_etl(msgs).select(F.col("ts").cast("string")).first()[0].startswith("2021-11-22 10:34:34.136")


def test_message_sink_files_and_arguments(spark, sf_small):
    import pytest

    from rivulet.session import work_path
    from rivulet.sources import fixtures
    from rivulet.sources.messages import encode_orders, read_message_stream, write_messages

    msgs = encode_orders(fixtures.order_msgs(spark, sf_small))
    path = work_path(spark, "sink")
    write_messages(msgs, path=path)
    back = spark.read.schema(MESSAGE_SCHEMA).parquet(path)
    assert back.count() == msgs.count()
    assert back.where(F.col("key").isNull() | F.col("value").isNull()).count() == 0
    with pytest.raises(ValueError):
        write_messages(msgs)
    with pytest.raises(ValueError):
        read_message_stream(spark)
