"""Ride-order reports: labelled counts, band counts, weekday counts, samples.

Every report is a pure ``DataFrame -> DataFrame`` function.  Labelled counts
group on the integer code first and label the (tiny) aggregate afterwards, so
the shuffle carries one partial count per code per task, and the label is a
``CASE`` expression rather than a UDF.  Band reports are a single global
aggregate of conditional sums: one pass, partial aggregation per task, one
row through the final exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.labels import (
    PRODUCT_LABELS,
    REALTIME_LABELS,
    TRAFFIC_DEFAULT,
    TRAFFIC_LABELS,
    WEEKDAY_LABELS,
    label,
)
from rivulet.functions.timefmt import weekday

# ---------------------------------------------------------------------------
# Band names and bounds of the reports, as the reference
# defines them.  (name, low, high): high None means "greater than low";
# otherwise low <= x <= high, both ends inclusive.
# ---------------------------------------------------------------------------
PRICE_BANDS = [
    ("0~15", 0, 15),
    ("16~30", 16, 30),
    ("31~50", 31, 50),
    ("51~100", 51, 100),
    ("100+", 100, None),
]
# The SQL variant of the price report: the fourth band starts at 50.
PRICE_BANDS_SQL = [
    ("0_15", 0, 15),
    ("16_30", 16, 30),
    ("31_50", 31, 50),
    ("51_100", 50, 100),
    ("100_", 100, None),
]
DISTANCE_BANDS = [
    ("0~10km", 0, 10000),
    ("10~20km", 10001, 20000),
    ("20~30", 20001, 30000),
    ("30~50km", 30001, 50000),
    ("50+km", 50001, None),
]
# ---------------------------------------------------------------------------


def labelled_count(
    df: DataFrame,
    code_col: str,
    mapping: Mapping[object, str],
    out_col: str,
    default: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Count rows per code, then label the codes: ``(out_col, total)``.

    Codes that share a label (unlisted codes under a default) stay separate
    rows, because grouping happens on the code.
    """
    counts = df.groupBy(code_col).agg(F.count(F.lit(1)).alias("total"))
    return counts.select(
        label(F.col(code_col), mapping, default=default, strict=strict).alias(out_col),
        "total",
    )


def by_product(df: DataFrame, strict: bool = False) -> DataFrame:
    return labelled_count(df, "product_id", PRODUCT_LABELS, "order_type", strict=strict)


def by_type(df: DataFrame, out_col: str = "order_realtime", strict: bool = False) -> DataFrame:
    return labelled_count(df, "type", REALTIME_LABELS, out_col, strict=strict)


def by_traffic(df: DataFrame) -> DataFrame:
    return labelled_count(df, "traffic_type", TRAFFIC_LABELS, "traffic_type", default=TRAFFIC_DEFAULT)


def by_traffic_raw(df: DataFrame) -> DataFrame:
    return df.groupBy("traffic_type").agg(F.count(F.lit(1)).alias("total"))


def band_counts(df: DataFrame, col: str, bands: Sequence[tuple]) -> DataFrame:
    """One row; one column per band with the number of rows inside it.

    A NULL value counts in no band (``otherwise(0)``); over zero rows the sums
    are NULL, as SQL ``sum`` is.
    """
    c = F.col(col)
    aggs = []
    for name, lo, hi in bands:
        cond = c > F.lit(lo) if hi is None else c.between(lo, hi)
        aggs.append(F.sum(F.when(cond, 1).otherwise(0)).alias(name))
    return df.agg(*aggs)


def price_bands(df: DataFrame) -> DataFrame:
    return band_counts(df, "pre_total_fee", PRICE_BANDS)


def price_bands_sql(df: DataFrame) -> DataFrame:
    return band_counts(df, "pre_total_fee", PRICE_BANDS_SQL)


def distance_bands(df: DataFrame) -> DataFrame:
    return band_counts(df, "start_dest_distance", DISTANCE_BANDS)


def by_weekday(df: DataFrame, time_col: str = "departure_time") -> DataFrame:
    """Count rows per weekday of a ``yyyy-MM-dd HH:mm:ss`` text: ``(week, total)``.

    Groups on the integer day of week (7 groups) and labels afterwards;
    unparsable text lands in one NULL group instead of failing the job.
    """
    counts = (
        df.select(weekday(time_col).alias("_dow"))
        .groupBy("_dow")
        .agg(F.count(F.lit(1)).alias("total"))
    )
    return counts.select(label(F.col("_dow"), WEEKDAY_LABELS).alias("week"), "total")


SAMPLE_COLUMNS = ("order_id", "product_id", "type", "pre_total_fee", "traffic_type", "start_dest_distance")


def sample(df: DataFrame, n: int = 20, columns: Sequence[str] = SAMPLE_COLUMNS) -> DataFrame:
    """First ``n`` rows of a projection, in a fixed order so the answer is
    deterministic (plans as a per-task top-n, then a merge of n rows each)."""
    proj = df.select(*columns)
    return proj.orderBy(*[F.col(c).asc_nulls_last() for c in columns]).limit(n)


def top_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """Sort + limit; plans as ``TakeOrderedAndProject`` (no global sort)."""
    return df.orderBy(*order).limit(n)
