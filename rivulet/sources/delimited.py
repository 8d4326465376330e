"""Delimited text scan and write (tab-separated ride files with a header)."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.session import hadoop_fs

_HEADERS_AT_ONCE = 16  # files whose first line is read at the same time

# The columns of the ride file in its order, with declared types
# (text times stay text, as in the catalog DDL; CSV inference would turn
# ``departure_time`` into a timestamp).  The last three are dropped by the ETL.
RIDE_FILE_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("city_id", T.IntegerType()),
        T.StructField("district", T.IntegerType()),
        T.StructField("county", T.IntegerType()),
        T.StructField("type", T.IntegerType()),
        T.StructField("combo_type", T.IntegerType()),
        T.StructField("traffic_type", T.IntegerType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("driver_product_id", T.IntegerType()),
        T.StructField("start_dest_distance", T.IntegerType()),
        T.StructField("arrive_time", T.StringType()),
        T.StructField("departure_time", T.StringType()),
        T.StructField("pre_total_fee", T.DoubleType()),
        T.StructField("normal_time", T.StringType()),
        T.StructField("bubble_trace_id", T.StringType()),
        T.StructField("product_1level", T.IntegerType()),
        T.StructField("dest_lng", T.DoubleType()),
        T.StructField("dest_lat", T.DoubleType()),
        T.StructField("starting_lng", T.DoubleType()),
        T.StructField("starting_lat", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)


REJECTED = "_rejected"


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files at and below ``path``, which may be a glob (metadata only)."""
    fs, p = hadoop_fs(spark, path)
    found = []
    for root in fs.globStatus(p) or ():
        top = root.getPath().toString()
        walk = fs.listFiles(root.getPath(), True)
        while walk.hasNext():
            f = walk.next()
            name = f.getPath().toString()
            if f.getLen() and not any(x.startswith(("_", ".")) for x in name[len(top) :].split("/")):
                found.append(name)
    if not found and not fs.globStatus(p):
        raise FileNotFoundError(path)
    return sorted(found)


def _first_line(spark: SparkSession, file: str) -> str:
    """The header line of one file, through its codec if it is compressed."""
    fs, p = hadoop_fs(spark, file)
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(
        jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
    )
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a folder by their header lines.  One line of each file is read, a few
    files at a time."""
    files = _data_files(spark, path)
    with ThreadPoolExecutor(_HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(lambda f: _first_line(spark, f), files))
    out: dict[str, list[str]] = {}
    for header, file in zip(headers, files):
        out.setdefault(header, []).append(file)
    return out


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = RIDE_FILE_SCHEMA,
    sep: str = "\t",
    header: bool = True,
    infer: bool = False,
    rejects: bool = False,
) -> DataFrame:
    """Scan delimited text.  With a header, the columns of the declared ``schema`` are found
    by name in every file, wherever they stand there: files are read by groups of one
    header.  A file that lacks a declared column is an error, other columns are left
    out.  A declared schema avoids the extra inference pass over the whole input;
    ``infer=True`` (or ``schema=None``) runs it.

    ``rejects=True`` adds the column ``_rejected``: NULL for a good row, the line itself for
    one that is short, long or has a value that its type can't hold (its fields may be
    NULL or not; see ``split_rejected``).  Lines of blanks and separators only are no rows."""
    reader = spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    if schema is None or infer:
        return reader.option("inferSchema", True).csv(path)
    kept = list(schema.fieldNames())
    if rejects:  # every column is parsed, also where the caller selects a few
        reader = reader.option("columnNameOfCorruptRecord", REJECTED).option("columnPruning", False)
        kept.append(REJECTED)

    def scan(names: list[str], files: str | list[str]) -> DataFrame:
        declared = {f.name: f.dataType for f in schema.fields}
        fields = [T.StructField(n, declared.get(n, T.StringType())) for n in names]
        if rejects:
            fields.append(T.StructField(REJECTED, T.StringType()))
        return reader.schema(T.StructType(fields)).csv(files).select(*kept)

    if not header:
        return scan(schema.fieldNames(), path)
    groups = files_by_header(spark, path)
    if not groups:
        empty = T.StructType([*schema.fields, *([T.StructField(REJECTED, T.StringType())] if rejects else [])])
        return spark.createDataFrame([], empty)
    out = None
    for line, files in groups.items():
        names = next(csv.reader([line], delimiter=sep)) if len(sep) == 1 else line.split(sep)
        missing = set(schema.fieldNames()) - set(names)
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(sorted(missing))}")
        rows = scan(names, path if len(groups) == 1 else files)
        out = rows if out is None else out.unionByName(rows)
    return out


def split_rejected(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write rows read with ``rejects=True`` below ``path`` in one scan and give back
    ``(good rows, rejected lines)``, each a scan of its own folder."""
    spark = rows.sparkSession
    flagged = rows.withColumn("_bad", F.col(REJECTED).isNotNull())
    flagged.write.mode("overwrite").partitionBy("_bad").parquet(path)
    stored = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_bad", T.BooleanType())])).parquet(path)
    good = stored.where(~F.col("_bad")).drop("_bad", REJECTED)
    return good, stored.where("_bad").select(F.col(REJECTED).alias("line"))


def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = True) -> str:
    """Write ``df`` as delimited text, one file per task (no shuffle)."""
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)
    return path
