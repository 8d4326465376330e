from rivulet.streaming.orders import active_queries, await_all, await_any, order_stream, start_json_print, start_upsert  # noqa: F401
from rivulet.streaming.table_tail import start_tail, tail_log  # noqa: F401
