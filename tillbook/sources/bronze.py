"""Bronze CSV scans.

One CSV per domain and day: ``<root>/bronze/<system>/<table>/<prefix>_YYYY_MM_DD.csv``
(a plain file, or a folder of part files as Spark writes them).

Columns are matched by header NAME, never by position: Spark's CSV reader
given several files takes the first file's header for all of them, so a day
whose columns come in another order would silently land in the wrong columns.
The header line of each file is probed on the driver (one small read per
file, no data), files with the same header are read by ONE scan, and the
scans are combined with ``unionByName`` - a long backfill is a handful of scans
in one job, not one plan node per file.

Typing: everything is read as text and cast to the declared type by name, so
no inference job runs and a day of whole-number prices stays DOUBLE.  A bad
cell fails the job with ``CAST_INVALID_INPUT`` (ANSI), before any table is
touched.  ``infer=True`` keeps the reference's ``inferSchema`` behaviour.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions.days import file_day
from tillbook.schemas import Domain
from tillbook.session import list_conf, session_conf
from tillbook.sources.fs import FS

FILE_DAY = "_file_day"
_FILE_DAY_RE = r"_(\d{4}_\d{2}_\d{2})\.csv(/|$)"


def bronze_path(root: str, domain: Domain, day) -> str:
    """S1's file name: dashes of the day become underscores."""
    return (f"{root.rstrip('/')}/bronze/{domain.system}/{domain.name}/"
            f"{domain.prefix}_{file_day(day)}.csv")


def type_by_name(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast declared columns by header name; absent ones are NULL, extra ones stay text."""
    by_lower = {c.lower(): c for c in raw.columns}
    cols = []
    for f in schema:
        src = by_lower.get(f.name.lower())
        cols.append((F.col(f"`{src}`").cast(f.dataType) if src is not None
                     else F.lit(None).cast(f.dataType)).alias(f.name))
    declared = {f.name.lower() for f in schema}
    extra = [F.col(f"`{c}`") for c in raw.columns if c.lower() not in declared
             and c != FILE_DAY]
    keep = [F.col(FILE_DAY)] if FILE_DAY in raw.columns else []
    return raw.select(*cols, *extra, *keep)


def read_csv(spark: SparkSession, paths: list[str], schema: T.StructType | None = None,
             infer: bool = False, with_file_day: bool = False) -> DataFrame:
    """Read bronze files by header name; a missing file raises before any job."""
    if not paths:
        raise ValueError("no bronze file to read")
    fs = FS(spark, paths[0])
    groups: dict[str | None, list[str]] = defaultdict(list)
    # one small read per file; on an object store these are round trips, so a
    # long range is probed by a few threads (I/O bound, results in file order)
    with ThreadPoolExecutor(max_workers=min(16, len(paths))) as pool:
        headers = list(pool.map(fs.first_line, paths))
    for p, h in zip(paths, headers):
        groups[h].append(p)
    frames = []
    for _header, group in groups.items():
        with session_conf(spark, list_conf(spark)):      # files are listed here
            raw = (spark.read.option("header", True).option("inferSchema", infer)
                   .csv(group))
        if with_file_day:
            raw = raw.withColumn(FILE_DAY, F.to_date(F.translate(
                F.regexp_extract("_metadata.file_path", _FILE_DAY_RE, 1), "_", "-")))
        if schema is not None and not infer:
            raw = type_by_name(raw, schema)
        frames.append(raw)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def days_present(spark: SparkSession, root: str, domain: Domain, days) -> list:
    """Those of ``days`` that have a bronze file."""
    days = list(days)
    if not days:
        return []
    fs = FS(spark, root)
    with ThreadPoolExecutor(max_workers=min(16, len(days))) as pool:
        there = list(pool.map(lambda d: fs.exists(bronze_path(root, domain, d)), days))
    return [d for d, yes in zip(days, there) if yes]


def read_days(spark: SparkSession, root: str, domain: Domain, days,
              infer: bool = False, with_file_day: bool = False) -> DataFrame:
    """S1 + S2 for a list of days of one domain."""
    paths = [bronze_path(root, domain, d) for d in days]
    return read_csv(spark, paths, None if infer else domain.schema, infer, with_file_day)


def read_day(spark: SparkSession, root: str, domain: Domain, day,
             infer: bool = False) -> DataFrame:
    """S1 + S2 for one day of one domain."""
    return read_days(spark, root, domain, [day], infer)
