"""Jobs (P1-P5) and the invariants of SURVEY section 5 on bronze files derived
from the sf0.001 tables."""

from conftest import SF, write_csv
import pytest
from pyspark.sql import functions as F

from tillbook.operators import storage
from tillbook.plans import pipeline
from tillbook.plans.pipeline import Lake
from tillbook.schemas import FREIGHT, PRODUCT_REPORT, RETURNS, SALES, STOCK, TAX_REPORT, TAXES
from tillbook.sources import fixtures as fx


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _bronze(spark, root, domains):
    return {d.name: fx.write_bronze(spark, root, d, fx.FRAMES[d.name](spark, SF)) for d in domains}


def test_incremental_gold_equals_full_rebuild(spark, scratch):
    lake = Lake(scratch)
    days = _bronze(spark, scratch, (RETURNS, STOCK, SALES))
    for d in (RETURNS, STOCK, SALES):
        pipeline.ingest(spark, lake, d, days[d.name])
    pipeline.build_gold(spark, lake, PRODUCT_REPORT)
    schema = PRODUCT_REPORT.schema
    full = spark.createDataFrame(storage.read(spark, lake.gold(PRODUCT_REPORT)).collect(), schema)
    some = sorted(days["vendas"])[::3]
    pipeline.build_gold(spark, lake, PRODUCT_REPORT, days=some)
    again = storage.read(spark, lake.gold(PRODUCT_REPORT))
    assert full.count() > 0 and _same(full, again)
    # the same rows as the summary computed straight from the tables
    direct = storage.conform(fx_products(spark), lake.gold(PRODUCT_REPORT))
    assert _same(again, direct)


def fx_products(spark):
    from tillbook.operators import gold
    return gold.product_summary_tagged(fx.product_lines(spark, SF))


def test_backfill_equals_days_one_by_one(spark, scratch):
    days = _bronze(spark, f"{scratch}/a", (TAXES,))["tributos"]
    _bronze(spark, f"{scratch}/b", (TAXES,))
    a, b = Lake(f"{scratch}/a"), Lake(f"{scratch}/b")
    pipeline.backfill(spark, a, min(days), max(days), domains=["tributos"])
    for d in sorted(days):
        pipeline.ingest(spark, b, TAXES, [d])
        pipeline.build_gold(spark, b, TAX_REPORT, days=[d])
    assert _same(storage.read(spark, a.gold(TAX_REPORT)), storage.read(spark, b.gold(TAX_REPORT)))
    # sum of the A7 series over branches = sum of the gold measure
    series = pipeline.report_series(spark, a, "taxes")
    total = storage.read(spark, a.gold(TAX_REPORT)).agg(
        F.sum(F.col("TotalImpostoPago").cast("decimal(24,4)"))).first()[0]
    assert series.agg(F.sum(F.col("TotalImpostoPago").cast("decimal(24,4)"))).first()[0] == total


def test_run_day_skips_only_reports_of_failed_domains(spark, scratch):
    lake = Lake(scratch)
    days = _bronze(spark, scratch, (TAXES,))
    day = sorted(days["tributos"])[0]
    out = pipeline.run_day(spark, lake, day)
    assert out["status"]["tributos"] == "ok" and out["status"]["taxes"] == "ok"
    assert out["status"]["frete"].startswith("failed") and out["status"]["freight"] == "skipped"
    assert out["status"]["products"] == "skipped"
    gold_days = {str(r[0]) for r in storage.read(spark, lake.gold(TAX_REPORT))
                 .select("CodigoData").distinct().collect()}
    assert gold_days == {day}


def test_upsert_moves_day_refreshes_both_gold_days(spark, scratch):
    lake = Lake(scratch)
    f = fx.freight(spark, SF).limit(0)
    base = spark.createDataFrame(
        [("a", 10.0, "2024-01-01", "Loggi", "SP01"), ("b", 5.0, "2024-01-01", "Loggi", "SP01")],
        "pedido_id string, valor_frete double, data_envio string, transportadora string, filial_id string",
    ).withColumn("data_envio", F.to_date("data_envio"))
    assert f.count() == 0
    storage.create(spark, lake.silver(FREIGHT), base)
    pipeline.build_gold(spark, lake, "freight")
    moved = base.filter("pedido_id = 'a'").withColumn("data_envio", F.to_date(F.lit("2024-01-02")))
    touched = storage.upsert(spark, lake.silver(FREIGHT), moved)
    pipeline.refresh_reports(spark, lake, {"frete": touched})
    got = sorted((str(r.CodigoData), r.TotalFretePago)
                 for r in storage.read(spark, lake.gold(pipeline.FREIGHT_REPORT)).collect())
    assert got == [("2024-01-01", 5.0), ("2024-01-02", 10.0)]


def test_report_choices_over_stored_gold(spark, scratch):
    lake = Lake(scratch)
    storage.create(spark, lake.silver(TAXES), fx.taxes(spark, SF))
    pipeline.build_gold(spark, lake, "taxes")
    ch = pipeline.report_choices(spark, lake, "taxes")
    assert "products" not in ch
    branches = [r[0] for r in ch["branches"].collect()]
    expected = fx.taxes(spark, SF).select("filial_id").distinct().count()
    assert branches == sorted(branches) and len(branches) == expected
    lo, hi = ch["bounds"].first()
    days = [r[0] for r in ch["days"].collect()]
    assert (lo, hi) == (days[0], days[-1])
    # an empty report: (NULL, NULL) bounds and no branches
    storage.delete_days(spark, lake.gold(TAX_REPORT), days)
    empty = pipeline.report_choices(spark, lake, "taxes")
    assert tuple(empty["bounds"].first()) == (None, None)
    assert empty["branches"].count() == 0


def test_latest_per_key_with_a_hot_key(spark):
    """A key holding a third of the rows across many files: only the newest
    file's rows of it survive; other keys and NULL keys are untouched."""
    from tillbook.sources.bronze import FILE_DAY
    n = 3000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN CAST(id AS STRING) END AS k",
        f"date_add(DATE'2024-01-01', CAST(id % 10 AS INT)) AS {FILE_DAY}", "id")
    out = pipeline.latest_per_key(df, "k")
    hot = out.filter("k = 'hot'").collect()
    newest = max(r[FILE_DAY] for r in df.filter("k = 'hot'").select(FILE_DAY).collect())
    expected_hot = df.filter(F.col("k") == "hot").filter(F.col(FILE_DAY) == newest).count()
    assert len(hot) == expected_hot > 0
    assert out.filter("k IS NULL").count() == n // 3
    assert out.filter("k <> 'hot'").count() == n // 3
    assert FILE_DAY not in out.columns


def test_report_and_series_over_products(spark, scratch):
    lake = Lake(scratch)
    for d in (RETURNS, STOCK, SALES):
        storage.create(spark, lake.silver(d), fx.FRAMES[d.name](spark, SF))
    pipeline.build_gold(spark, lake, PRODUCT_REPORT)
    gold_rows = storage.read(spark, lake.gold(PRODUCT_REPORT))
    one = gold_rows.first()
    rows = pipeline.report(spark, lake, "products", [one.FilialId], one.CodigoData,
                           one.CodigoData, one.ProdutoId).collect()
    assert [tuple(r) for r in rows] == [tuple(one)]
    # the series sums quantities per day and branch over the filtered rows
    series = pipeline.report_series(spark, lake, "products", [one.FilialId]).collect()
    expected = gold_rows.filter(F.col("FilialId") == one.FilialId) \
        .groupBy("CodigoData").agg(F.sum("TotalQuantidadeVendida").alias("q")).collect()
    assert sorted((r.CodigoData, r.TotalQuantidadeVendida) for r in series) == \
        sorted((r.CodigoData, r.q) for r in expected)
    # a product argument is ignored by the reports without products
    storage.create(spark, lake.silver(TAXES), fx.taxes(spark, SF))
    pipeline.build_gold(spark, lake, "taxes")
    assert pipeline.report(spark, lake, "taxes", product=3).count() == \
        storage.read(spark, lake.gold(TAX_REPORT)).count()


HEAD = "data_pagamento,tipo_imposto,valor_pago,filial_id\n"


def _tax_file(lake, day, *lines):
    write_csv(lake.bronze(TAXES, day), HEAD + "".join(f"{x}\n" for x in lines))


def _gold_taxes(spark, lake):
    return sorted((str(r.CodigoData), r.TotalImpostoPago)
                  for r in storage.read(spark, lake.gold(TAX_REPORT)).collect())


def test_failed_bootstrap_is_bootstrapped_again(spark, scratch, monkeypatch):
    lake = Lake(scratch)
    for n, d in enumerate(("2024-01-01", "2024-01-02")):
        _tax_file(lake, d, f"{d},ICMS,{n + 1}.5,SP01")
        pipeline.ingest(spark, lake, TAXES, [d])
    with monkeypatch.context() as m:
        m.setattr(storage, "_write", lambda *a, **k: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError):
            pipeline.build_gold(spark, lake, TAX_REPORT)
    assert not storage.exists(spark, lake.gold(TAX_REPORT))
    pipeline.build_gold(spark, lake, TAX_REPORT, days=["2024-01-01"])
    assert _gold_taxes(spark, lake) == [("2024-01-01", 1.5), ("2024-01-02", 2.5)]


def test_a_failing_report_stops_no_other_and_is_caught_up(spark, scratch, monkeypatch):
    lake = Lake(scratch)
    day = "2024-01-01"
    _tax_file(lake, day, f"{day},ICMS,1.5,SP01")
    write_csv(lake.bronze(FREIGHT, day), "pedido_id,valor_frete,data_envio,transportadora,filial_id\n"
              f"a,2.5,{day},Loggi,SP01\n")
    with monkeypatch.context() as m:
        m.setattr(pipeline.gold, "tax_summary", lambda df: (_ for _ in ()).throw(RuntimeError("no taxes")))
        status = pipeline.run_day(spark, lake, day)["status"]
        with pytest.raises(RuntimeError, match="reports failed.*no taxes"):
            pipeline.backfill(spark, lake, day, day, ["tributos"])
    assert status["taxes"].startswith("failed: RuntimeError: no taxes") and status["freight"] == "ok"
    assert storage.read(spark, lake.gold(pipeline.FREIGHT_REPORT)).count() == 1
    # the next run builds what the failed one left, though it touches another day
    _tax_file(lake, "2024-01-02", "2024-01-02,ICMS,3.5,SP01")
    assert pipeline.run_day(spark, lake, "2024-01-02")["status"]["taxes"] == "ok"
    assert _gold_taxes(spark, lake) == [("2024-01-01", 1.5), ("2024-01-02", 3.5)]
    assert storage.pending(spark, lake.silver(TAXES)) == {}


def test_a_crash_between_silver_and_gold_leaves_nothing_stale(spark, scratch):
    lake = Lake(scratch)
    head = "pedido_id,valor_frete,data_envio,transportadora,filial_id\n"
    write_csv(lake.bronze(FREIGHT, "2024-01-01"), head + "a,10.0,2024-01-01,Loggi,SP01\nb,5.0,2024-01-01,Loggi,SP01\n")
    pipeline.run_day(spark, lake, "2024-01-01")
    write_csv(lake.bronze(FREIGHT, "2024-01-02"), head + "a,10.0,2024-01-02,Loggi,SP01\n")
    pipeline.ingest(spark, lake, FREIGHT, ["2024-01-02"])           # moved a; the run dies here
    pipeline.run_day(spark, lake, "2024-01-02")                     # the day again: touches 01-02 only
    got = sorted((str(r.CodigoData), r.TotalFretePago)
                 for r in storage.read(spark, lake.gold(pipeline.FREIGHT_REPORT)).collect())
    assert got == [("2024-01-01", 5.0), ("2024-01-02", 10.0)]


def test_backfill_takes_the_days_that_exist(spark, scratch):
    lake = Lake(scratch)
    for d in ("2024-01-01", "2024-01-03"):
        _tax_file(lake, d, f"{d},ICMS,1.5,SP01")
    out = pipeline.backfill(spark, lake, "2024-01-01", "2024-01-04", ["tributos", "frete"])
    assert out["missing"]["tributos"] == ["2024-01-02", "2024-01-04"] and len(out["missing"]["frete"]) == 4
    assert out["touched"] == {"tributos": ["2024-01-01", "2024-01-03"], "frete": []}
    assert _gold_taxes(spark, lake) == [("2024-01-01", 1.5), ("2024-01-03", 1.5)]


def test_rows_of_another_day_are_appended_each_time(spark, scratch):
    """As the reference does: only rows of the file's own day are replaced."""
    lake = Lake(scratch)
    _tax_file(lake, "2024-01-01", "2024-01-01,ICMS,1.0,SP01")
    pipeline.ingest(spark, lake, TAXES, ["2024-01-01"])
    _tax_file(lake, "2024-01-02", "2024-01-01,ICMS,2.0,SP01", "2024-01-02,ICMS,4.0,SP01")
    for _ in range(2):
        pipeline.ingest(spark, lake, TAXES, ["2024-01-02"])
    got = sorted((str(r.data_pagamento), r.valor_pago) for r in storage.read(spark, lake.silver(TAXES)).collect())
    assert got == [("2024-01-01", 1.0), ("2024-01-01", 2.0), ("2024-01-01", 2.0), ("2024-01-02", 4.0)]


def test_jobs_run_side_by_side_and_fail_alone(spark):
    import threading
    meet = threading.Barrier(3, timeout=60)         # passed only if all three run at once

    def job(n):
        meet.wait()
        pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        if n == "bad":
            raise OSError("disk")
        return pool, spark.range(n).count()
    got = pipeline.concurrently(spark, {"five": lambda: job(5), "bad": lambda: job("bad"), "two": lambda: job(2)})
    assert (got["five"], got["two"], str(got["bad"])) == (("five", 5), ("two", 2), "disk")
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert pipeline.concurrently(spark, {}) == {}


def test_files_of_several_days_are_parsed_once(spark, scratch, monkeypatch):
    """What reads the rows of a keyed domain again reads them typed, from the scratch
    folder; keys of several files are few here, so the rows are joined without a shuffle."""
    from tillbook.functions.days import file_day
    lake, days = Lake(scratch), ["2024-01-01", "2024-01-02", "2024-01-03"]
    for i, d in enumerate(days):
        rows = "".join(f"{k},{i}.5,{d},c,b\n" for k in ("", "same", f"own{i}"))
        write_csv(f"{scratch}/bronze/sistema_frete/frete/frete_{file_day(d)}.csv",
                  "pedido_id,valor_frete,data_envio,transportadora,filial_id\n" + rows)
    real, plans = storage.create, []

    def create(s, table, df, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(s, table, df, **options)
    monkeypatch.setattr(storage, "create", create)
    pipeline.ingest(spark, lake, FREIGHT, days)
    assert "Scan csv" not in plans[0] and "BroadcastHashJoin" in plans[0]
    got = storage.read(spark, lake.silver(FREIGHT)).select("pedido_id", "valor_frete").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, .5), (None, 1.5), (None, 2.5), ("own0", .5), ("own1", 1.5), ("own2", 2.5), ("same", 2.5)], key=str)


def test_history_of_the_daily_run_is_loaded_side_by_side(spark):
    import threading
    from tillbook.plans import catalog
    both = threading.Barrier(2, timeout=60)
    jobs = {n: lambda n=n: (both.wait(), n)[1] for n in ("a", "b")}
    assert catalog._all(spark, jobs) == {"a": "a", "b": "b"}
    with pytest.raises(ZeroDivisionError):
        catalog._all(spark, {"bad": lambda: 1 // 0})
