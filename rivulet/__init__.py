"""rivulet: keyed lake tables and ride/order analytics as Spark DataFrame jobs.

Subpackages
-----------
sources     scans of the given tables, delimited/JSON-lines files, message files
functions   column expressions (labels, time formats, IPv4 decoding)
operators   DataFrame -> DataFrame operators (reports, ETL, keyed lake table)
plans       plan-level helpers (size-checked broadcast, catalog statements)
streaming   Structured Streaming jobs (message ETL, upsert sink, table tail)
"""

from rivulet.session import work_path, ensure_work_dir  # noqa: F401

__all__ = ["work_path", "ensure_work_dir"]
