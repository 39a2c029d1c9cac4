"""Day-partitioned Parquet tables and their operators.

The reference gets replace-day and upsert from Delta; Spark's own Parquet
tables refuse MERGE and DELETE, so each operator here is a Spark job over a
table laid out as ``<path>/<day>=YYYY-MM-DD/part-*.parquet``.  Days are replaced
by Spark's dynamic partition overwrite: rows go to a hidden staging folder
and the days that got rows are swapped in when the job commits, so a failed or
killed job - or a lost executor, whose tasks Spark retries - leaves the table
as it was.  Days that have to go without getting rows are removed by name afterwards.

One writer per table at a time is assumed, as in the reference.  A table exists
from its first completed write, which leaves ``_table.json`` with the columns
added to the declared ones.

Reads always use the stored schema (partition value types, column order, no
footer merge), so a day filter becomes a ``PartitionFilters`` entry.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions.days import as_date, day_str
from tillbook.session import list_conf, scratch_dir, session_conf
from tillbook.sources.fs import FS

MARKER = "_table.json"        # a write has completed; holds the added columns
PENDING = "_pending"          # days changed since the reports were built, a file per write


@dataclass(frozen=True)
class Table:
    path: str
    day: str
    schema: T.StructType           # declared columns, day included
    key: str | None = None         # upsert key
    sort: tuple[str, ...] = ()     # extra in-file sort keys (O1)
    ranged: bool = False           # split a hot day by key range (O1)
    track: bool = False            # keep the days each write changed until cleared

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# --- reads (S3, S4) -----------------------------------------------------------
def exists(spark: SparkSession, table: Table) -> bool:
    """T1's probe: some write has completed."""
    return FS(spark, table.path).exists(f"{table.path}/{MARKER}")


def added_columns(spark: SparkSession, table: Table) -> list[T.StructField]:
    """Columns that writes added to the declared ones (T3), oldest first."""
    fs = FS(spark, table.path)
    if not fs.exists(f"{table.path}/{MARKER}"):
        return []
    return list(T.StructType.fromJson(json.loads(fs.read_text(f"{table.path}/{MARKER}"))["added"]))


def read(spark: SparkSession, table: Table, days=None, evolved: bool = False) -> DataFrame:
    """S3 (whole table) or S4 (``days`` only, pruned to those partitions).

    ``evolved=True`` also returns columns added by writes (T3), NULL for rows
    written before them.
    """
    wanted = None if days is None else sorted({as_date(d) for d in days})
    schema = T.StructType([*table.schema, *(added_columns(spark, table) if evolved else [])])
    names = schema.fieldNames()
    with session_conf(spark, list_conf(spark)):   # file listing happens here, eagerly
        if wanted is None:
            return spark.read.schema(schema).parquet(table.path).select(*names)
        # List only the requested day folders, not the whole table.
        fs = FS(spark, table.path)
        prefix = f"{table.day}="
        have = {n for n in fs.children(table.path, dirs=True) if n.startswith(prefix)}
        paths = [f"{table.path}/{prefix}{day_str(d)}" for d in wanted if f"{prefix}{day_str(d)}" in have]
        reader = spark.read.schema(schema).option("basePath", table.path)
        df = reader.parquet(*paths) if paths else reader.parquet(table.path).filter(F.lit(False))
    return df.select(*names).filter(F.col(table.day).isin(wanted))


# --- typing of incoming rows --------------------------------------------------
def conform(df: DataFrame, table: Table, extra: list[T.StructField] = ()) -> DataFrame:
    """Cast by column name to the declared types; absent columns become NULL.

    ``extra`` names further columns to keep.  A NULL day is rejected inside the
    write job (no extra pass over the data): such a row could never be replaced
    later (B9).
    """
    cols = []
    for f in [*table.schema, *extra]:
        c = F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else \
            F.lit(None).cast(f.dataType)
        if f.name == table.day:
            c = F.when(c.isNull(), F.raise_error(F.lit(
                f"NULL in day column {table.day}: every row needs a day"))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _evolved(spark: SparkSession, table: Table, df: DataFrame, fresh: bool = False) -> list[T.StructField]:
    """Added columns after ``df`` is written: those of the table (none if ``fresh``) and
    those new in ``df``.  A column that comes back with another type is refused."""
    known = [] if fresh else added_columns(spark, table)
    types = {f.name: f.dataType for f in known}
    for f in df.schema:
        if f.name in table.columns:
            continue
        if f.name not in types:
            known.append(T.StructField(f.name, f.dataType, True))
        elif types[f.name] != f.dataType:
            raise ValueError(f"column {f.name} of {table.path} is {types[f.name].simpleString()}, "
                             f"not {f.dataType.simpleString()}")
    return known


# --- writing -----------------------------------------------------------------
# Writing by day: ``rebalance(day)`` sends each day to one task and AQE splits a
# day bigger than the advisory size into several, so files per day stay
# minimal.  AQE then merges small partitions up to min(total / parallelism,
# advisory size) - but never below its minimum partition size (1 MB), which
# would put every day of a small multi-day write into one serial task that
# opens thousands of files.  For the write only, that floor is dropped: empty
# partitions still merge away on a big cluster, and small days spread over the
# cores.
WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
              "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1"}


#: An upsert of at most so many keys looks for each of them in the files' bloom filters.
FEW_KEYS = 500


def _bloom(table: Table) -> dict[str, str]:
    """Writer options: a bloom filter on the key, sized by the keys that a row group has.
    One in 100,000: a batch of FEW_KEYS keys reads few row groups that have none of them."""
    return {} if table.key is None else {
        f"parquet.bloom.filter.enabled#{table.key}": "true", f"parquet.bloom.filter.fpp#{table.key}": "0.00001",
        "parquet.bloom.filter.adaptive.enabled": "true"}


def _among(target: DataFrame, key: str, src: DataFrame) -> DataFrame:
    """Rows of ``target`` that may have a key of the batch ``src``: an exact filter that the
    Parquet reader can use on row groups, by bloom filter for few keys, else by range."""
    lo, hi, about = src.agg(F.min(key), F.max(key), F.approx_count_distinct(key)).first()
    if about <= 2 * FEW_KEYS:      # else the batch need not be shuffled to count its keys
        few = [r[0] for r in src.select(key).filter(F.col(key).isNotNull()).distinct().limit(FEW_KEYS + 1).collect()]
        if len(few) <= FEW_KEYS:
            return target.filter(F.col(key).isin(few))
    return target.filter(F.col(key).between(F.lit(lo), F.lit(hi)))


def write_by_day(df: DataFrame, day: str, keys: list[str], path: str, fmt: str = "parquet",
                 mode: str = "overwrite", ranged: bool = False, **options) -> None:
    """One Spark job writing ``df`` partitioned by ``day`` to ``path``.

    A hot day is split over tasks: by size as the rows come or, ``ranged``, by ranges of the
    keys, so that its files have disjoint key ranges and a filter on the first key skips most
    of them.  Ranges cost a sampling pass over ``df`` before the shuffle.
    """
    dealt = df.repartitionByRange(*keys) if ranged else df.hint("rebalance", day)
    w = (dealt.sortWithinPartitions(*keys)
         .write.mode(mode).partitionBy(day).options(**options))
    with session_conf(df.sparkSession, WRITE_CONF):
        w.format(fmt).save(path)


def _write(table: Table, df: DataFrame, only: list[str] | None = None, mode: str = "overwrite") -> list[str]:
    """Replace the days that ``df`` has rows for (or append to them); return all its days.

    ``only``: write just the rows of these days; the others' days are returned too.
    The days are observed while the rows pass, without another job.
    """
    seen, day = Observation(), F.col(table.day).cast("string")
    rows = df.observe(seen, F.collect_set(day).alias("days"))
    if only is not None:
        rows = rows.filter(F.col(table.day).isin([as_date(d) for d in only]))
    write_by_day(rows, table.day, [table.day, *table.sort], table.path, mode=mode,
                 ranged=table.ranged and bool(table.sort), partitionOverwriteMode="dynamic", **_bloom(table))
    try:
        return sorted(seen.get["days"])
    except Py4JJavaError:      # a plan that Spark found to be empty reports nothing: nothing was written
        return sorted(r[0] for r in df.select(day).distinct().collect())


def days_frame(spark: SparkSession, table: Table) -> DataFrame:
    """The days of a table from the names of its folders (every folder has rows): no file is read."""
    rows = [(as_date(d),) for d in sorted(_stored_days(spark, table))]
    return spark.createDataFrame(rows, T.StructType([table.schema[table.day]]))


def _drop_days(spark: SparkSession, table: Table, days) -> None:
    """Remove days by name (metadata only, bounded by days)."""
    fs = FS(spark, table.path)
    for d in sorted(days):
        fs.delete(f"{table.path}/{table.day}={d}")


def _stored_days(spark: SparkSession, table: Table) -> set[str]:
    prefix = f"{table.day}="
    return {n[len(prefix):] for n in FS(spark, table.path).children(table.path, dirs=True) if n.startswith(prefix)}


def _describe(spark: SparkSession, table: Table, added: list[T.StructField]) -> None:
    FS(spark, table.path).write_text(f"{table.path}/{MARKER}", json.dumps(
        {"added": T.StructType(list(added)).jsonValue()}))


# --- days that reports have yet to see -------------------------------------------
def _changing(spark: SparkSession, table: Table, days) -> None:
    """Note the days of a tracked table that are about to change."""
    if table.track and days:
        fs = FS(spark, table.path)
        fs.mkdirs(f"{table.path}/{PENDING}")
        fs.write_text(f"{table.path}/{PENDING}/{uuid.uuid4().hex}.json", json.dumps(sorted(days)))


def pending(spark: SparkSession, table: Table) -> dict[str, list[str]]:
    """Days changed by writes of a tracked table that nobody has cleared, by write."""
    fs = FS(spark, table.path)
    base = f"{table.path}/{PENDING}"
    return {n: json.loads(fs.read_text(f"{base}/{n}")) for n in fs.children(base, dirs=False)
            if n.endswith(".json")}


def clear_pending(spark: SparkSession, table: Table, writes) -> None:
    fs = FS(spark, table.path)
    for n in writes:
        fs.delete(f"{table.path}/{PENDING}/{n}")


# --- table operators ------------------------------------------------------------
def create(spark: SparkSession, table: Table, df: DataFrame, evolve: bool = True) -> list[str]:
    """Create or replace the whole table with ``df``."""
    added = _evolved(spark, table, df, fresh=True) if evolve else []
    before = _stored_days(spark, table)
    _changing(spark, table, before)
    days = _write(table, conform(df, table, added))
    _changing(spark, table, set(days) - before)
    _drop_days(spark, table, before - set(days))
    _describe(spark, table, added)
    return days


def append(spark: SparkSession, table: Table, df: DataFrame) -> list[str]:
    """Append with schema evolution.

    Declared columns are cast by name (absent ones are NULL); columns new to
    the table are kept and read back through ``read(..., evolved=True)``,
    NULL for rows written before them.  A column that was added with another
    type raises before anything is written.
    """
    if not exists(spark, table):
        return create(spark, table, df)
    added = _evolved(spark, table, df)
    days = _write(table, conform(df, table, added), mode="append")
    _describe(spark, table, added)
    _changing(spark, table, days)
    return days


def delete_days(spark: SparkSession, table: Table, days) -> None:
    """T4 for day predicates: drop those partitions (metadata only)."""
    days = sorted({day_str(d) for d in days})
    if exists(spark, table):
        _changing(spark, table, days)
        _drop_days(spark, table, days)


def delete_where(spark: SparkSession, table: Table, predicate: Column | str) -> list[str]:
    """T4 for any predicate, also over added columns: rewrite only the days holding
    matching rows.

    A row is deleted when the predicate is TRUE; NULL never matches, as in a
    SQL ``DELETE``.
    """
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    touched = sorted(day_str(r[0]) for r in read(spark, table, evolved=True).filter(pred)
                     .select(table.day).distinct().collect())
    if touched:
        kept = read(spark, table, days=touched, evolved=True).filter(~F.coalesce(pred, F.lit(False)))
        _rewrite(spark, table, kept, touched)
    return touched


def _rewrite(spark: SparkSession, table: Table, df: DataFrame, days: list[str]) -> list[str]:
    """Give ``days`` the rows of ``df``, which may come from the table itself."""
    _changing(spark, table, days)
    rows = _write(table, df)
    _drop_days(spark, table, set(days) - set(rows))
    return rows


def replace_days(spark: SparkSession, table: Table, df: DataFrame, days=None,
                 evolve: bool = True) -> list[str]:
    """T5: each requested day gets exactly the rows of ``df`` for it.

    A requested day without rows is removed (the reference's delete + empty
    append).  Rows of days not requested are appended to those days, as the
    reference's append does - so repeating a call repeats *those* rows.  Only
    when there are such rows, they take a second pass.
    ``days=None`` replaces the days ``df`` has.
    """
    if not exists(spark, table):
        return create(spark, table, df, evolve=evolve)
    known = added_columns(spark, table)
    added = _evolved(spark, table, df) if evolve else known
    rows = conform(df, table, added)
    asked = None if days is None else sorted({day_str(d) for d in days})
    _changing(spark, table, asked)
    found = set(_write(table, rows, asked))
    others = found - set(found if asked is None else asked)
    _changing(spark, table, found if asked is None else others)
    if others:
        _write(table, rows, sorted(others), mode="append")
    _drop_days(spark, table, set(asked or []) - found)
    if added != known:
        _describe(spark, table, added)
    return sorted(found | set(asked or []))


def upsert(spark: SparkSession, table: Table, df: DataFrame) -> list[str]:
    """Merge ``df`` into the table on ``table.key``; return touched days.

    Matched target rows take the columns that the source has (also their day, so
    a row can move to another day) and keep the others; unmatched source rows
    are inserted; every other row stays whole, added columns included.  NULL
    keys never match.  A target row matched by two source rows is an error;
    source duplicates of a new key are all inserted.  Source columns unknown to
    the table are dropped, as the reference's merge does.

    Job 1 finds the matches: it scans the key column of the target - with up to FEW_KEYS
    keys only the row groups whose bloom filter has one of them, else those within the
    batch's smallest and largest key - and writes the matched keys with their days to the scratch folder.
    Job 2 rewrites the touched days, which it joins with the batch once; what to
    insert it knows from the matched keys.  A batch under the broadcast
    threshold by Catalyst's size estimate is broadcast, so the target is not
    shuffled; else both sides sort-merge, with AQE's skew splitting.  NULL keys
    never enter a join.
    """
    k, d = table.key, table.day
    if k is None:
        raise ValueError(f"table {table.path} has no key to upsert on")
    if not exists(spark, table):
        return create(spark, table, conform(df, table), evolve=False)
    added = added_columns(spark, table)
    fields = [*table.schema, *added]
    given = [f.name for f in fields if f.name in df.columns]

    # 0. the source batch, typed, written once to the scratch folder: both
    #    jobs read the same rows and the CSV is parsed once; lineage is cut
    #    at a table on the shared store
    run = scratch_dir(spark, "upsert")
    src = conform(df, table, added)
    src.write.mode("overwrite").parquet(f"{run}/source")
    src = spark.read.schema(T.StructType(fields)).parquet(f"{run}/source")
    s_keys = src.filter(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias("_n"))

    # 1. matched keys and their days
    target = _among(read(spark, table).select(k, d).filter(F.col(k).isNotNull()), k, src)
    with session_conf(spark, {"spark.sql.parquet.pushdown.inFilterThreshold": str(FEW_KEYS)}):
        target.join(s_keys, k).groupBy(k, d).agg(F.max("_n").alias("_n")).write.parquet(f"{run}/matched")
    matched = spark.read.schema(T.StructType([table.schema[k], table.schema[d], T.StructField(
        "_n", T.LongType())])).parquet(f"{run}/matched")
    info = (matched.groupBy(d).agg(F.max("_n").alias("_n"))
            .unionByName(src.select(d).distinct().withColumn("_n", F.lit(0).cast("long")))
            .groupBy(d).agg(F.max("_n").alias("_n")).collect())
    if any(r["_n"] > 1 for r in info):
        FS(spark, run).delete(run)
        raise ValueError(f"upsert on {k}: a target row matches several source rows")
    touched = sorted(day_str(r[0]) for r in info)

    # 2. new content of the touched days
    tgt = read(spark, table, days=touched, evolved=True)
    s = src.filter(F.col(k).isNotNull()).select(
        F.col(k).alias("__k"), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__s_{c}") for c in given])
    updated_or_kept = tgt.filter(F.col(k).isNotNull()).join(s, F.col(k) == F.col("__k"), "left").select(*[
        (F.when(F.col("__hit"), F.col(f"__s_{f.name}")).otherwise(F.col(f.name)) if f.name in given
         else F.col(f.name)).alias(f.name) for f in fields])
    inserted = src.filter(F.col(k).isNotNull()).join(matched.select(k).distinct(), k, "left_anti")
    merged = (updated_or_kept.unionByName(inserted)
              .unionByName(src.filter(F.col(k).isNull()))
              .unionByName(tgt.filter(F.col(k).isNull())))
    rows = _rewrite(spark, table, merged, touched)
    FS(spark, run).delete(run)
    return sorted(set(rows) | set(touched))


def write(spark: SparkSession, table: Table, df: DataFrame, days=None) -> list[str]:
    """Bootstrap a missing table whole; else upsert (keyed) or replace days."""
    if not exists(spark, table):
        return create(spark, table, df)
    if table.key is not None:
        return upsert(spark, table, df)
    return replace_days(spark, table, df, days)
