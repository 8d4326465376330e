"""Reports on hand-written edge rows: band borders, NULLs, labels, weekdays."""

import pytest
from pyspark.sql import types as T

from rivulet.operators import reports

RIDE = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("type", T.IntegerType()),
        T.StructField("traffic_type", T.IntegerType()),
        T.StructField("pre_total_fee", T.DoubleType()),
        T.StructField("start_dest_distance", T.IntegerType()),
        T.StructField("departure_time", T.StringType()),
    ]
)


def _rides(spark, rows):
    return spark.createDataFrame(rows, RIDE)


def test_price_band_borders(spark):
    fees = [15.0, 15.5, 16.0, 50.0, 50.5, 51.0, 100.0, 100.01, None]
    df = _rides(spark, [(i, 1, 0, 0, f, 0, "2021-09-10 08:00:00") for i, f in enumerate(fees)])
    r = reports.price_bands(df).first().asDict()
    # 15.5 and 50.5 fall in no band; 100 is in 51~100 only; NULL in none
    assert r == {"0~15": 1, "16~30": 1, "31~50": 1, "51~100": 2, "100+": 1}
    s = reports.price_bands_sql(df).first().asDict()
    # SQL form: the fourth band is 50..100, so 50 counts twice and 50.5 lands there
    assert s == {"0_15": 1, "16_30": 1, "31_50": 1, "51_100": 4, "100_": 1}


def test_distance_band_borders(spark):
    ds = [10000, 10001, 50000, 50001, 50002, None]
    df = _rides(spark, [(i, 1, 0, 0, 1.0, d, None) for i, d in enumerate(ds)])
    r = reports.distance_bands(df).first().asDict()
    # 50001 is in no band: the last band is "> 50001"
    assert r == {"0~10km": 1, "10~20km": 1, "20~30": 0, "30~50km": 1, "50+km": 1}


def test_bands_over_empty_input_are_null(spark):
    r = reports.price_bands(_rides(spark, [])).collect()
    assert len(r) == 1 and all(v is None for v in r[0])


def test_labels_group_before_labelling(spark):
    df = _rides(spark, [(1, 1, 0, 7, 1.0, 1, None), (2, 1, 1, 8, 1.0, 1, None), (3, 4, None, 302, 1.0, 1, None)])
    traffic = sorted(tuple(r) for r in reports.by_traffic(df).collect())
    # unlisted codes 7 and 8 stay separate rows under the same default label
    assert traffic == sorted([("未知", 1), ("未知", 1), ("跨城拼车", 1)])
    product = sorted(tuple(r) for r in reports.by_product(df).collect())
    assert product == sorted([("滴滴企业快车", 1), ("滴滴专车", 2)])
    kinds = sorted((r[0] or "", r[1]) for r in reports.by_type(df).collect())
    assert kinds == sorted([("", 1), ("实时", 1), ("预约", 1)])


def test_strict_labels_fail_on_unlisted_code(spark):
    df = _rides(spark, [(1, 9, 0, 0, 1.0, 1, None)])
    with pytest.raises(Exception, match="unlisted code"):
        reports.by_product(df, strict=True).collect()


def test_weekday_labels(spark):
    df = _rides(
        spark,
        [
            (1, 1, 0, 0, 1.0, 1, "2021-09-10 12:00:00"),
            (2, 1, 0, 0, 1.0, 1, "2021-10-10 00:00:00"),
            (3, 1, 0, 0, 1.0, 1, "0000-00-00 00:00:00"),
            (4, 1, 0, 0, 1.0, 1, None),
        ],
    )
    got = {r["week"]: r["total"] for r in reports.by_weekday(df).collect()}
    assert got == {"星期五": 1, "星期日": 1, None: 2}


def test_sample_is_ordered_and_capped(spark):
    df = _rides(spark, [(i, 1, 0, 0, float(i), 1, None) for i in range(50, 0, -1)])
    got = [r["order_id"] for r in reports.sample(df, 5).collect()]
    assert got == [1, 2, 3, 4, 5]
