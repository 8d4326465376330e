"""The label mappings as SQL functions, callable by name from SQL text.

They are temporary SQL functions (``RETURN CASE ...``): Catalyst puts their body
into the query, so a call costs what the ``CASE`` expression costs, and nothing
runs in Python.  Each label has three forms: ``name`` gives NULL for an unlisted code,
``name_or(code, default)`` the default, and ``name_strict`` fails the query; NULL has
the label NULL (the default in ``name_or``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from rivulet.functions.labels import PRODUCT_LABELS, REALTIME_LABELS, TRAFFIC_LABELS, WEEKDAY_LABELS

LABEL_FUNCTIONS = {
    "product_label": PRODUCT_LABELS,
    "realtime_label": REALTIME_LABELS,
    "traffic_label": TRAFFIC_LABELS,
    "weekday_label": WEEKDAY_LABELS,
}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_label(spark: SparkSession, name: str, mapping: Mapping[int, str]) -> list[str]:
    """Create the three functions of one mapping; existing ones are replaced."""
    if not mapping:
        raise ValueError("empty label mapping")
    cases = " ".join(f"WHEN {int(code)} THEN {_text(text)}" for code, text in mapping.items())
    unlisted = "raise_error(concat('unlisted code: ', CAST(code AS STRING)))"
    bodies = {
        name: ("code INT", f"CASE code {cases} END"),
        f"{name}_or": ("code INT, fallback STRING", f"CASE code {cases} ELSE fallback END"),
        f"{name}_strict": ("code INT", f"CASE code {cases} ELSE CASE WHEN code IS NOT NULL THEN {unlisted} END END"),
    }
    for function, (parameters, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}({parameters}) RETURNS STRING RETURN {body}")
    return list(bodies)


def register_labels(spark: SparkSession) -> list[str]:
    """Create the functions of all mappings in this session; returns their names."""
    return [f for name, mapping in LABEL_FUNCTIONS.items() for f in register_label(spark, name, mapping)]
