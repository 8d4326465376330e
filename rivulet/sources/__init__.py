from rivulet.sources.delimited import RIDE_FILE_SCHEMA, read_delimited, write_delimited  # noqa: F401
from rivulet.sources.fixtures import order_msgs, rides, trip_log  # noqa: F401
from rivulet.sources.json_lines import read_json_lines, write_json_lines  # noqa: F401
from rivulet.sources.messages import (  # noqa: F401
    MESSAGE_SCHEMA,
    encode_orders,
    read_message_stream,
    write_message_files,
    write_messages,
)
from rivulet.sources.tables import TABLES, load  # noqa: F401
