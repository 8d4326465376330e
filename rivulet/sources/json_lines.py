"""JSON-lines collections -> tables (schema inferred, declared, or drifting)."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNFIT = "_unfit"


def read_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Scan JSON lines.  Without a schema Spark infers one in a first pass over
    all rows; declare one for large inputs."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def variant_schema(lines: DataFrame, text_col: str = "value") -> T.StructType:
    """The fields of all rows that are JSON objects and the type that holds all of a
    field's values, in one distributed pass (partial schemas merge in every task).
    A field without such a type stays a VARIANT; one that is always null is text."""
    parsed = lines.select(F.try_parse_json(text_col).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    found = parsed.agg(F.schema_of_variant_agg("v")).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", found)
    ddl = re.sub(r"\bVOID\b", "STRING", ddl)
    return T.DataType.fromDDL(ddl)


def _field(v: Column, name: str) -> Column:
    """A field of a VARIANT object, as a VARIANT; a path can't name one with both quotes."""
    if "'" in name and '"' in name:
        return F.try_element_at(F.variant_get(v, "$", "map<string, variant>"), F.lit(name))
    quote = '"' if "'" in name else "'"
    return F.variant_get(v, f"$[{quote}{name}{quote}]", "variant")


def fitted(v: Column, schema: T.StructType) -> tuple[list[Column], Column]:
    """A column per field of ``schema`` out of a VARIANT object, and a map of the values that
    a field's type can't hold, by field, as JSON text (null: none).  No value is lost; a
    missing field is NULL."""
    columns, unfit = [], []
    for f in schema.fields:
        raw = _field(v, f.name)
        if isinstance(f.dataType, T.VariantType):
            columns.append(raw.alias(f.name))
            continue
        value = F.try_variant_get(raw, "$", f.dataType.simpleString())
        columns.append(value.alias(f.name))
        lost = raw.isNotNull() & ~F.is_variant_null(raw) & value.isNull()
        unfit.append(F.when(lost, F.struct(F.lit(f.name).alias("k"), F.to_json(raw).alias("v"))))
    held = F.array_compact(F.array(*unfit)) if unfit else F.lit(None).cast("array<struct<k: string, v: string>>")
    return columns, F.when(F.size(held) > 0, F.map_from_entries(held))


def read_json_drifting(
    spark: SparkSession, path: str, preferred: Mapping[str, str] | None = None
) -> DataFrame:
    """Scan JSON lines whose shape changes from row to row.  Every field that any row has
    is a column of the type that holds all its values; for a field without such a
    type (a VARIANT) ``preferred`` may name one, and what does not fit it stands in
    ``_unfit``, by field.  A line that is no JSON object is a row of NULLs with the
    line in ``_unfit`` under the key ``""``."""
    lines = spark.read.text(path)
    wanted = dict(preferred or {})
    schema = T.StructType(
        [
            T.StructField(f.name, T.DataType.fromDDL(wanted[f.name]) if f.name in wanted else f.dataType)
            for f in variant_schema(lines).fields
        ]
    )
    v = F.try_parse_json("value")
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    columns, unfit = fitted(F.when(is_object, v), schema)
    return lines.select(*columns, F.when(is_object, unfit).otherwise(F.create_map(F.lit(""), F.col("value"))).alias(UNFIT))


def write_json_lines(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path
