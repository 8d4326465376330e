from rivulet.functions.ipv4 import IP_RANGES, int_to_ipv4, ipv4_to_int  # noqa: F401
from rivulet.functions.labels import (  # noqa: F401
    PRODUCT_LABELS,
    REALTIME_LABELS,
    TRAFFIC_DEFAULT,
    TRAFFIC_LABELS,
    WEEKDAY_LABELS,
    label,
)
from rivulet.functions.timefmt import (  # noqa: F401
    dash_path,
    epoch_seconds,
    instant_column,
    normalize_instant,
    parse_time,
    prefix,
    weekday,
)
