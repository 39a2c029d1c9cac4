"""Jobs a user calls (P1-P5): ingest, gold builds, backfill, the daily run, reports.

Layout under one root (an argument, never a constant):
  bronze/<system>/<table>/<prefix>_YYYY_MM_DD.csv
  silver/<domain>/<table>/            day-partitioned Parquet
  gold/<area>/<table>/                day-partitioned Parquet
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.days import as_date, day_range, day_str
from tillbook.operators import gold, reports, storage
from tillbook.operators.storage import Table
from tillbook.schemas import (DOMAINS, FREIGHT, FREIGHT_REPORT, PRODUCT_REPORT, REPORTS,
                              RETURNS, SALES, STOCK, TAX_REPORT, TAXES, Domain, Report)
from tillbook.session import scratch_dir
from tillbook.sources import bronze
from tillbook.sources.fs import FS


@dataclass(frozen=True)
class Lake:
    root: str

    def bronze(self, domain: Domain, day) -> str:
        return bronze.bronze_path(self.root, domain, day)

    def silver(self, domain: Domain) -> Table:
        sort = (domain.key,) if domain.key else ()
        return Table(f"{self.root}/silver/{domain.name}/{domain.name}", domain.day,
                     domain.schema, domain.key, sort, track=True)

    def gold(self, report: Report) -> Table:
        return Table(f"{self.root}/gold/{report.folder}/{report.table}", report.day,
                     report.schema, None, tuple(report.keys[1:]), ranged=True)


def _domain(d: Domain | str) -> Domain:
    return DOMAINS[d] if isinstance(d, str) else d


def _report(r: Report | str) -> Report:
    return REPORTS[r] if isinstance(r, str) else r


def concurrently(spark: SparkSession, jobs: dict[str, Callable]) -> dict:
    """Run independent jobs side by side and return what each returned, or its exception.

    Spark's scheduler takes jobs of several threads: the few tasks of a small day leave
    cores idle that another domain can use.  Each job has a pool of its own name, so under
    ``spark.scheduler.mode=FAIR`` a big one does not hold up the others.
    """
    def run(name: str):
        sc = spark.sparkContext
        before = sc.getLocalProperty("spark.scheduler.pool")
        sc.setLocalProperty("spark.scheduler.pool", name)
        try:
            return jobs[name]()
        except Exception as e:  # noqa: BLE001 - returned, other jobs go on
            return e
        finally:
            sc.setLocalProperty("spark.scheduler.pool", before)
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(run), name) for name in jobs}
        return {name: job.result() for name, job in started.items()}


# --- P1 -----------------------------------------------------------------------
def ingest(spark: SparkSession, lake: Lake, domain: Domain | str, days) -> list[str]:
    """Load the bronze files of ``days`` into the domain's silver table.

    Missing table -> created from the files (T2); keyed domain -> upsert (T6);
    otherwise the days are replaced (T5).  A missing file raises before anything
    is written.  Returns the days whose silver rows changed (an upsert can touch
    older days); the table remembers them until the reports are built.

    Repeating a day is safe for rows of that day.  A file of an unkeyed domain
    that holds rows of another day appends those to it, as the reference does,
    and a second run appends them again.
    """
    domain = _domain(domain)
    days = [as_date(d) for d in days]
    table = lake.silver(domain)
    several = domain.upsert and len(days) > 1
    df = bronze.read_days(spark, lake.root, domain, days, with_file_day=several)
    run = scratch_dir(spark, "ingest")
    try:
        if several:                                     # the files are parsed once
            df = latest_per_key(_stored(df, f"{run}/rows"), domain.key, f"{run}/repeated")
        if not storage.exists(spark, table):
            written = storage.create(spark, table, df)
            return sorted(set(written) | {day_str(d) for d in days})
        if domain.upsert:
            return storage.upsert(spark, table, df)
        return storage.replace_days(spark, table, df, days)
    finally:
        FS(spark, run).delete(run)


def _stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` by way of a scratch folder: what reads it twice computes it once."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest_per_key(df: DataFrame, key: str, scratch: str | None = None) -> DataFrame:
    """Over several files, the newest file's rows win for a repeated key.

    Same as applying the files one by one, oldest first (for keys unique within
    a file).  ``groupBy`` pre-aggregates per task, so even a key holding a third
    of all rows shuffles one row per task.  Only keys of several files are joined
    back, from the ``scratch`` folder: where they are few Spark knows it from the
    folder's size and broadcasts them, so the rows are not shuffled; else AQE
    splits a hot key on the big side.  Rows with a NULL key are all kept.
    """
    fd = bronze.FILE_DAY
    repeated = _stored(df.filter(F.col(key).isNotNull()).groupBy(key)
                       .agg(F.min(fd).alias("_first"), F.max(fd).alias("_latest"))
                       .filter("_first != _latest").select(key, "_latest"),
                       scratch or scratch_dir(df.sparkSession, "repeated"))
    kept = df.filter(F.col(key).isNotNull()).join(repeated, key, "left").filter(
        F.col("_latest").isNull() | (F.col(fd) == F.col("_latest"))).drop("_latest")
    return kept.unionByName(df.filter(F.col(key).isNull())).drop(fd)


# --- P2 -----------------------------------------------------------------------
def summary(spark: SparkSession, lake: Lake, report: Report | str, days=None) -> DataFrame:
    """The gold rows of ``report`` from silver, for ``days`` (None = all)."""
    report = _report(report)

    def src(domain):
        return storage.read(spark, lake.silver(domain), days=days)

    if report is TAX_REPORT:
        return gold.tax_summary(src(TAXES))
    if report is FREIGHT_REPORT:
        return gold.freight_summary(src(FREIGHT))
    return gold.product_summary(src(RETURNS), src(STOCK), src(SALES))


def build_gold(spark: SparkSession, lake: Lake, report: Report | str, days=None) -> list[str]:
    """Rebuild a gold table whole (``days=None`` or table missing), else
    replace just ``days`` (a day whose rows are gone disappears, B5)."""
    report = _report(report)
    table = lake.gold(report)
    if days is None or not storage.exists(spark, table):
        return storage.create(spark, table, summary(spark, lake, report), evolve=False)
    days = [day_str(d) for d in days]
    return storage.replace_days(spark, table, summary(spark, lake, report, days), days,
                                evolve=False)


# --- P3 -----------------------------------------------------------------------
def backfill(spark: SparkSession, lake: Lake, lo, hi, domains=None) -> dict:
    """Ingest every day of ``lo..hi`` that has a file and refresh the gold tables.

    One job per domain for the whole range (not one per day), side by side, then one
    gold job per report over every day the ingests touched.  Returns ``{"touched": days
    per domain, "missing": days without a file per domain, "reports": ...}``; a
    report that fails raises after the others are built.
    """
    days = day_range(lo, hi)
    domains = [_domain(d) for d in (domains or list(DOMAINS))]
    there = {d.name: bronze.days_present(spark, lake.root, d, days) for d in domains}
    missing = {n: sorted({day_str(x) for x in days} - {day_str(x) for x in have}) for n, have in there.items()}
    touched = concurrently(spark, {n: lambda n=n: ingest(spark, lake, n, there[n]) if there[n] else []
                                   for n in there})
    for got in touched.values():
        if isinstance(got, Exception):
            raise got
    reports_ = refresh_reports(spark, lake, touched)
    failed = {n: r for n, r in reports_.items() if isinstance(r, Exception)}
    if failed:
        raise RuntimeError(f"reports failed: { {n: str(e)[:200] for n, e in failed.items()} }") \
            from next(iter(failed.values()))
    return {"touched": touched, "missing": missing, "reports": reports_}


def refresh_reports(spark: SparkSession, lake: Lake, touched: dict[str, list[str]]) -> dict:
    """Refresh each report whose inputs are all in ``touched``, over their touched days
    and those that earlier runs left (a run that died between silver and gold, a
    report that failed).  A silver table forgets its days once its report is built.
    Returns the days per report, or the exception of one that failed."""
    def refresh(report: Report) -> list[str] | None:
        left = {n: storage.pending(spark, lake.silver(DOMAINS[n])) for n in report.needs}
        days = {d for n in report.needs for d in touched[n]}
        days |= {d for writes in left.values() for changed in writes.values() for d in changed}
        if not all(storage.exists(spark, lake.silver(DOMAINS[n])) for n in report.needs):
            return None                             # a domain that has never had a file
        built = build_gold(spark, lake, report, sorted(days))
        for n, writes in left.items():
            storage.clear_pending(spark, lake.silver(DOMAINS[n]), writes)
        return built

    ready = [r for r in REPORTS.values() if all(n in touched for n in r.needs)]
    done = concurrently(spark, {r.name: lambda r=r: refresh(r) for r in ready})
    return {n: built for n, built in done.items() if built is not None}


# --- P4 -----------------------------------------------------------------------
def run_day(spark: SparkSession, lake: Lake, day) -> dict:
    """The daily run.  Five ingests side by side, then the reports whose inputs loaded.

    A failed domain (say, its file is missing) skips only the reports that need
    it, and a failed report stops no other one; nothing is raised, so the caller
    has to look at ``status``.  Upserts can touch older days (B6); those are
    refreshed too.
    """
    loaded = concurrently(spark, {d.name: lambda d=d: ingest(spark, lake, d, [day])
                                  for d in (RETURNS, STOCK, SALES, FREIGHT, TAXES)})
    status = {n: _failure(got) if isinstance(got, Exception) else "ok" for n, got in loaded.items()}
    touched = {n: got for n, got in loaded.items() if not isinstance(got, Exception)}
    built = refresh_reports(spark, lake, touched)
    for r in REPORTS.values():
        got = built.get(r.name)
        status[r.name] = "skipped" if got is None else _failure(got) if isinstance(got, Exception) else "ok"
    return {"status": status, "touched": touched}


def _failure(e: Exception) -> str:
    return f"failed: {type(e).__name__}: {str(e)[:200]}"


# --- P5 -----------------------------------------------------------------------
MEASURE = {TAX_REPORT.name: ("TotalImpostoPago", True),
           FREIGHT_REPORT.name: ("TotalFretePago", True),
           PRODUCT_REPORT.name: ("TotalQuantidadeVendida", False)}


def report(spark: SparkSession, lake: Lake, name: str, branches=None, lo=None, hi=None,
           product=None) -> DataFrame:
    """P5: rows of one report, filtered."""
    df = storage.read(spark, lake.gold(_report(name)))
    if _report(name) is not PRODUCT_REPORT:
        product = None
    return reports.filter_report(df, branches, lo, hi, product)


def report_series(spark: SparkSession, lake: Lake, name: str, branches=None, lo=None,
                  hi=None, product=None) -> DataFrame:
    """P5: the daily total per branch behind the report's chart."""
    measure, money = MEASURE[_report(name).name]
    return reports.daily_totals(report(spark, lake, name, branches, lo, hi, product),
                                measure, money)


def report_choices(spark: SparkSession, lake: Lake, name: str) -> dict[str, DataFrame]:
    """P5: what a report can be filtered by - branches, products (product report
    only), days, and the default range (first and last day) - as lazy frames
    over the stored gold table (A8, A9).  Days and range come from the names of the
    day folders, so no file is read for them."""
    df = storage.read(spark, lake.gold(_report(name)))
    days = storage.days_frame(spark, lake.gold(_report(name)))
    out = {"branches": reports.distinct_values(df, "FilialId"),
           "days": reports.distinct_values(days, "CodigoData"),
           "bounds": reports.date_bounds(days)}
    if _report(name) is PRODUCT_REPORT:
        out["products"] = reports.distinct_values(df, "ProdutoId")
    return out
