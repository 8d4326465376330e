"""Date/time and text column helpers used by the ETL operators.

All parsing goes through ``try_to_timestamp`` so that text such as
``0000-00-00 00:00:00`` becomes NULL instead of failing an ANSI-mode job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of the source data.
DEPARTURE_FORMAT = "yyyy-MM-dd HH:mm:ss"
ORDER_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
COMMIT_FORMAT = "yyyyMMddHHmmssSSS"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_time(col: Column | str, fmt: str) -> Column:
    """Text -> timestamp, NULL when the text does not match ``fmt``."""
    if fmt == DEPARTURE_FORMAT:  # the form that a cast reads, several times as fast as a pattern
        return F.when(_c(col).like("____-__-__ __:__:__"), _c(col).try_cast("timestamp"))
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def epoch_seconds(col: Column | str, fmt: str = DEPARTURE_FORMAT) -> Column:
    """``unix_timestamp(text, fmt)`` that yields NULL on bad text."""
    return F.unix_timestamp(parse_time(col, fmt))


def dash_path(*parts: Column | str) -> Column:
    """``y-m-d`` without zero padding (``2017-5-22``); NULL if any part is NULL.

    ``concat_ws`` alone would skip a NULL part and emit ``2017-22``.
    """
    cols = [_c(p) for p in parts]
    any_null = None
    for c in cols:
        any_null = c.isNull() if any_null is None else (any_null | c.isNull())
    return F.when(~any_null, F.concat_ws("-", *[c.cast("string") for c in cols]))


def prefix(col: Column | str, n: int) -> Column:
    """First ``n`` characters (``substring(s, 0, n)`` in the source programs)."""
    return F.substring(_c(col), 1, n)


def weekday(col: Column | str, fmt: str = DEPARTURE_FORMAT) -> Column:
    """Day of week of a date-time text, Sunday = 1; NULL on bad text."""
    return F.dayofweek(parse_time(col, fmt))


_DASHED = re.compile(r"(\d{4})-(\d\d)-(\d\d)(?:[ T](\d\d):(\d\d):(\d\d)(?:\.(\d{1,3}))?)?")


def normalize_instant(instant: str) -> str:
    """An instant as 17 digits ``yyyyMMddHHmmssSSS``, from ``2021-12-25``,
    ``2021-12-25 15:20:16[.5]``, or 14 or 17 digits.  Instants of one length
    compare as texts."""
    text = str(instant).strip()
    if re.fullmatch(r"\d{14}|\d{17}", text):
        return text.ljust(17, "0")
    m = _DASHED.fullmatch(text)
    if not m:
        raise ValueError(f"not an instant: {instant!r}")
    parts = [g or "00" for g in m.groups()[:6]]
    return "".join(parts) + (m[7] or "").ljust(3, "0")


def instant_column(col: Column | str) -> Column:
    """Texts of 14 or 17 digits as 17 digits; others (and NULL) fail the job."""
    c = _c(col).cast("string")
    return F.when(c.rlike(r"^(\d{14}|\d{17})$"), F.rpad(c, 17, "0")).otherwise(
        F.raise_error(F.concat(F.lit("not an instant: "), F.coalesce(c, F.lit("NULL"))))
    )
