"""Code -> label mapping as a plain column expression (no Python UDF).

``label(col, mapping)`` compiles to one ``CASE WHEN`` that stays inside
whole-stage codegen.  ``default=None`` gives NULL for an unlisted code (the
SQL form of the reports); ``strict=True`` fails the job on an unlisted,
non-NULL code (the form whose match has no default case).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The labels the reports must print, exactly as the reference
# defines them (code -> label, in natural order).
# ---------------------------------------------------------------------------
PRODUCT_LABELS = {
    1: "滴滴专车",
    2: "滴滴企业专车",
    3: "滴滴快车",
    4: "滴滴企业快车",
}
REALTIME_LABELS = {
    0: "实时",
    1: "预约",
}
TRAFFIC_LABELS = {
    0: "普通散客",
    1: "企业时租",
    2: "企业接机套餐",
    3: "企业送机套餐",
    4: "拼车",
    5: "接机",
    6: "送机",
    302: "跨城拼车",
}
TRAFFIC_DEFAULT = "未知"
# Day of week, Sunday = 1 (the calendar numbering Spark's dayofweek uses).
WEEKDAY_LABELS = {
    1: "星期日",
    2: "星期一",
    3: "星期二",
    4: "星期三",
    5: "星期四",
    6: "星期五",
    7: "星期六",
}
# ---------------------------------------------------------------------------


def label(
    col: Column | str,
    mapping: Mapping[object, str],
    default: str | None = None,
    strict: bool = False,
) -> Column:
    """``CASE col WHEN k1 THEN v1 ... [ELSE default] END`` from a dict."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for code, text in mapping.items():
        expr = (F.when(c == F.lit(code), F.lit(text)) if expr is None
                else expr.when(c == F.lit(code), F.lit(text)))
    if expr is None:
        raise ValueError("empty label mapping")
    if strict:
        return expr.when(c.isNull(), F.lit(None).cast("string")).otherwise(
            F.raise_error(F.concat(F.lit("unlisted code: "), c.cast("string")))
        )
    if default is not None:
        return expr.otherwise(F.lit(default))
    return expr
