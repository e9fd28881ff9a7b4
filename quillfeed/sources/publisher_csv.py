"""SRC1-3, SRC8: publisher list CSVs (``sources.<locale>.csv``).

All values are read as strings (no inference). Files whose headers differ
(e.g. ``Creative Instance ID`` vs ``Creative ID``) are read per header group
and unioned by name with missing columns as NULL (T1), so a column of one file
never shifts into another column. The locale comes from the file name and
each row keeps (file, row number) for first/last-writer rules.
"""

from __future__ import annotations

import glob
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCALE_RE = r"sources\.(.*)\.csv$"


def _parse_header(line: str) -> tuple[str, ...]:
    import csv

    return tuple(next(csv.reader([line])))


def _list_and_headers(spark: SparkSession, pattern: str) -> list[tuple[str, tuple[str, ...]]]:
    """(path, header) for every file matching ``pattern``. Only file names and
    one header line per file reach the driver. Local paths use the standard
    library; URIs (hdfs://, s3a://, ...) go through the Hadoop FileSystem API."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", pattern):
        out = []
        for p in sorted(glob.glob(pattern)):
            with open(p, encoding="utf-8") as f:
                out.append((p, _parse_header(f.readline().rstrip("\r\n"))))
        return out
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = gpath.getFileSystem(conf)
    out = []
    for st in sorted(fs.globStatus(gpath) or [], key=lambda x: x.getPath().toString()):
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(st.getPath()), "UTF-8"))
        try:
            out.append((st.getPath().toString(), _parse_header(reader.readLine() or "")))
        finally:
            reader.close()
    return out


def read_source_csvs(spark: SparkSession, pattern: str) -> DataFrame:
    """Read every file matching ``pattern`` (local path or any Hadoop URI)."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for p, header in _list_and_headers(spark, pattern):
        groups.setdefault(header, []).append(p)
    out = None
    for header, paths in groups.items():
        schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
        df = (
            spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .schema(schema).csv(paths)
            .withColumn("file", F.col("_metadata.file_name"))
        )
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(pattern)
    # SRC3: locale from the file name. Row numbers: a per-file ordinal that
    # follows the file's order (monotonically increasing ids are ordered within
    # a file split; files are small enough to be one split each).
    return out.withColumn("locale", F.regexp_extract("file", LOCALE_RE, 1)).withColumn(
        "row_no", F.monotonically_increasing_id())


def read_locale_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: one locale's list."""
    return read_source_csvs(spark, path)
