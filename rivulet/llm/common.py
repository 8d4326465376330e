"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import work_path

# Java and RE2 spelling of the word separators: space and \x09-\x0D.
SPACES = r"[\x20\x09-\x0D]+"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared work folder and read it
    back: cuts the lineage with files that outlive any executor."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], *names: str) -> list[str]:
    """Names that clash with none of ``taken`` (compared without case)."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two non-null longs that identify a document row by id and text, so null
    ids and several texts under one id stay apart in joins and groups.  Rows
    equal in both share the key."""
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")),
        F.xxhash64(F.col(id_col), F.col(text_col)),
    ]


def hash_share(hashed: Column) -> Column:
    """A hash as a number from 0 to 1: below s for a share s of the values."""
    return F.pmod(hashed, F.lit(1 << 40)) / float(1 << 40)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it
    inside other lambdas (Catalyst would inline a projected column there)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text, unchanged; a null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda w: w != F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
