"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "gold_summaries_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ..., "cores": ...}

input domains, as the jobs call it): each query written to the ``noop`` sink, 8
rounds in one session, median of the last 5.  The value is the sum of those
three medians.  Table jobs are timed too, median of 3: create a table, build a
gold table whole, backfill a range, the daily run, replace a day, upsert a
batch, refresh one gold day, ingest one CSV day; setting up what they work on
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tillbook.operators import gold, reports, storage  # noqa: E402
from tillbook.plans import catalog, pipeline  # noqa: E402
from tillbook.schemas import (DOMAINS, FREIGHT, PRODUCT_REPORT, RETURNS, SALES, STOCK,  # noqa: E402
                              TAXES)
from tillbook.session import local_session, scratch_dir  # noqa: E402
from tillbook.sources import fixtures as fx  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _sf_of(path: str):
    tail = os.path.basename(path)
    try:
        return float(tail[2:]) if tail.startswith("sf") else tail
    except ValueError:
        return tail


def timed(fn, rounds: int, keep: int) -> float:
    times = []
    for _ in range(rounds):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times[-keep:]), 4)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8,
                          app="tillbook-bench")
    sf = SF_DIR
    headline = {
        "gold_products": lambda: noop(gold.product_summary(
            fx.returns(spark, sf), fx.stock(spark, sf), fx.sales(spark, sf))),
        "gold_freight": lambda: noop(gold.freight_summary(fx.freight(spark, sf))),
        "gold_taxes": lambda: noop(gold.tax_summary(fx.taxes(spark, sf))),
    }
    others = {
        "gold_products_tagged": lambda: noop(gold.product_summary_tagged(fx.product_lines(spark, sf))),
        "gold_freight_sql": lambda: noop(gold.freight_summary_sql(spark, fx.freight(spark, sf))),
        "gold_products_by_join": lambda: noop(gold.product_summary_by_join(
            fx.returns(spark, sf), fx.stock(spark, sf), fx.sales(spark, sf))),
        "daily_freight_by_branch": lambda: noop(reports.daily_totals(
            gold.freight_summary(fx.freight(spark, sf)), "TotalFretePago", money=True)),
        "report_filter_all": lambda: noop(reports.filter_report(
            gold.product_summary_tagged(fx.product_lines(spark, sf)),
            (1, 5, 7, 12), "1996-01-01", "1998-12-31", 2)),
    }
    out = {}
    for name, fn in {**headline, **others}.items():
        out[name] = timed(fn, 8, 5)

    # --- day-sized table jobs over silver/gold tables built once ---------------
    lake = pipeline.Lake(scratch_dir(spark, "bench"))
    for d in (TAXES, RETURNS, STOCK, SALES):
        storage.create(spark, lake.silver(d), fx.FRAMES[d.name](spark, sf))
    sales_rows = fx.sales(spark, sf)
    out["create_sales"] = timed(lambda: storage.create(spark, lake.silver(SALES), sales_rows), 3, 3)
    out["build_gold_products"] = timed(lambda: pipeline.build_gold(spark, lake, PRODUCT_REPORT), 3, 3)
    taxes = fx.taxes(spark, sf)
    tax_day = "2024-01-15"
    out["replace_day_taxes"] = timed(lambda: storage.replace_days(
        spark, lake.silver(TAXES), taxes.filter(F.col("data_pagamento") == F.lit(tax_day)
                                                .cast("date")), [tax_day]), 3, 3)
    month = "1997-06-01"
    out["gold_refresh_products_day"] = timed(
        lambda: pipeline.build_gold(spark, lake, PRODUCT_REPORT, days=[month]), 3, 3)

    # upsert of one month of orders into a freight table holding every order
    ftab = storage.Table(f"{lake.root}/silver/frete_month", FREIGHT.day, FREIGHT.schema,
                         FREIGHT.key, (FREIGHT.key,))
    freight = fx.freight(spark, sf)
    storage.create(spark, ftab, freight)
    batch = freight.filter(F.date_trunc("month", "data_envio") == F.lit(month).cast("timestamp")) \
        .withColumn("valor_frete", F.col("valor_frete") + 1)
    out["upsert_month_freight"] = timed(lambda: storage.upsert(spark, ftab, batch), 3, 3)

    # the daily hot path: one bronze CSV day into a silver table holding every day
    blake = pipeline.Lake(f"{lake.root}/csv")
    sales_days = fx.write_bronze(spark, blake.root, SALES, fx.sales(spark, sf))
    pipeline.ingest(spark, blake, SALES, sales_days)                       # bootstrap
    out["ingest_day_sales_csv"] = timed(
        lambda: pipeline.ingest(spark, blake, SALES, [month]), 3, 3)

    # a range of tax days, and the daily run over all five domains on a month's first day
    n = iter(range(100))

    def fresh(label, domains):
        tlake = pipeline.Lake(f"{lake.root}/{label}{next(n)}")
        return tlake, {d.name: fx.write_bronze(spark, tlake.root, d, df) for d, df in domains}

    tlake, tdays = fresh("backfill", [(TAXES, taxes)])
    out["backfill_taxes"] = timed(lambda: pipeline.backfill(
        spark, tlake, min(tdays["tributos"]), max(tdays["tributos"]), ["tributos"]), 3, 3)
    monthly = [(DOMAINS[k], df) for k, df in catalog.monthly_frames(spark, sf).items()]
    dlake, ddays = fresh("daily", monthly)
    for d, _ in monthly:
        pipeline.ingest(spark, dlake, d, ddays[d.name])
    today = sorted(set.intersection(*map(set, ddays.values())))[0]
    out["run_day"] = timed(lambda: pipeline.run_day(spark, dlake, today), 3, 3)

    value = round(sum(out[k] for k in headline), 4)
    print(json.dumps({"metric": "gold_summaries_sec", "value": value, "unit": "sec",
                      "queries": out, "sf": _sf_of(SF_DIR), "cores": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
