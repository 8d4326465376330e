"""Signed 32-bit integer <-> dotted IPv4 text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The ten address ranges orders are drawn from, as signed
# 32-bit integers (first, last), in the reference's order.
#   36.56.0.0-36.63.255.255, 61.232.0.0-61.237.255.255,
#   106.80.0.0-106.95.255.255, 121.76.0.0-121.77.255.255,
#   123.232.0.0-123.235.255.255, 139.196.0.0-139.215.255.255,
#   171.8.0.0-171.15.255.255, 182.80.0.0-182.92.255.255,
#   210.25.0.0-210.47.255.255, 222.16.0.0-222.95.255.255
# ---------------------------------------------------------------------------
IP_RANGES = [
    (607649792, 608174079),
    (1038614528, 1039007743),
    (1783627776, 1784676351),
    (2035023872, 2035154943),
    (2078801920, 2079064063),
    (-1950089216, -1948778497),
    (-1425539072, -1425014785),
    (-1236271104, -1235419137),
    (-770113536, -768606209),
    (-569376768, -564133889),
]
# ---------------------------------------------------------------------------


def int_to_ipv4(col: Column | str) -> Column:
    """Dotted quad of a signed 32-bit address (``-1950089216`` -> ``139.196.0.0``)."""
    c = (F.col(col) if isinstance(col, str) else col).cast("int")
    octets = [F.shiftright(c, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8)]
    octets.append(c.bitwiseAND(F.lit(255)).cast("string"))
    return F.concat_ws(".", *octets)


def ipv4_to_int(col: Column | str) -> Column:
    """Dotted quad -> signed 32-bit address; NULL when not four octets."""
    c = F.col(col) if isinstance(col, str) else col
    parts = F.split(c, r"\.")
    acc = F.lit(0).cast("long")
    for i in range(4):
        acc = acc * 256 + F.try_element_at(parts, F.lit(i + 1)).try_cast("long")
    return F.when(F.size(parts) == 4, (acc - F.when(acc >= 2**31, F.lit(2**32)).otherwise(0)).cast("int"))
