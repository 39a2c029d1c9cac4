"""Registered queries over the driver's tables, with their DuckDB oracle SQL.

Each entry is ``(spark, sf_dir) -> DataFrame`` and runs over whole tables.
Queries that exercise table operators write to a fresh folder under the
shared checkpoint root and return what was stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillbook.operators import gold
from tillbook.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- oracle building blocks (DuckDB) -----------------------------------------
def _money(expr: str, digits: int) -> str:
    # exact sum of two-decimal values, rounded, as double
    return f"CAST(ROUND(SUM(CAST({expr} AS DECIMAL(18,2))), {digits}) AS DOUBLE)"


TAXES_SQL = f"""
SELECT data_pagamento AS CodigoData, filial_id AS FilialId, tipo_imposto AS TipoImposto,
       {_money('valor_pago', 4)} AS TotalImpostoPago
FROM {fx.SQL['tributos']} t GROUP BY 1, 2, 3"""

FREIGHT_SQL = f"""
SELECT data_envio AS CodigoData, filial_id AS FilialId, transportadora AS Transportadora,
       {_money('valor_frete', 4)} AS TotalFretePago
FROM {fx.SQL['frete']} f GROUP BY 1, 2, 3"""

# TicketMedio: integer cents, half up (valid for non-negative prices).
PRODUCTS_SQL = f"""
WITH l AS {fx.LINES_SQL},
r AS (SELECT day, product, branch, CAST(SUM(qty) AS BIGINT) AS TotalDevolvido
      FROM l WHERE flag = 'R' GROUP BY ALL),
a AS (SELECT day, product, branch, CAST(SUM(qty) AS BIGINT) AS TotalEmEstoque
      FROM l WHERE flag = 'A' GROUP BY ALL),
n AS (SELECT day, product, branch, CAST(SUM(qty) AS BIGINT) AS TotalQuantidadeVendida,
             {_money('price', 2)} AS TotalValorVendido,
             CAST(SUM(CAST(price AS DECIMAL(18,2))) * 100 AS BIGINT) AS cents
      FROM l WHERE flag = 'N' GROUP BY ALL)
SELECT r.day AS CodigoData, r.product AS ProdutoId, r.branch AS FilialId,
       TotalDevolvido, TotalEmEstoque, TotalQuantidadeVendida, TotalValorVendido,
       CASE WHEN TotalQuantidadeVendida = 0 THEN NULL
            ELSE ((2 * cents + TotalQuantidadeVendida) // (2 * TotalQuantidadeVendida)) / 100.0
       END AS TicketMedio
FROM r JOIN a USING (day, product, branch) JOIN n USING (day, product, branch)"""


# --- A1, A2, S5, J1 -------------------------------------------------------------
@register("gold_taxes", TAXES_SQL)
def gold_taxes(spark, sf_dir):
    return gold.tax_summary(fx.taxes(spark, sf_dir))


@register("gold_freight", FREIGHT_SQL)
def gold_freight(spark, sf_dir):
    return gold.freight_summary(fx.freight(spark, sf_dir))


@register("gold_freight_sql", FREIGHT_SQL)
def gold_freight_sql(spark, sf_dir):
    return gold.freight_summary_sql(spark, fx.freight(spark, sf_dir))


@register("gold_products", PRODUCTS_SQL)
def gold_products(spark, sf_dir):
    return gold.product_summary(fx.returns(spark, sf_dir), fx.stock(spark, sf_dir),
                                fx.sales(spark, sf_dir))


@register("gold_products_tagged", PRODUCTS_SQL)
def gold_products_tagged(spark, sf_dir):
    # lines that already carry their flag, read once
    return gold.product_summary_tagged(fx.product_lines(spark, sf_dir))


# --- shared pieces for table-operator queries ---------------------------------
from pyspark.sql import functions as F  # noqa: E402

from tillbook.functions.days import day_range  # noqa: E402
from tillbook.operators import reports, storage  # noqa: E402
from tillbook.plans import pipeline  # noqa: E402
from tillbook.schemas import (DOMAINS, FREIGHT, PRODUCT_REPORT, RETURNS, SALES,  # noqa: E402
                              STOCK, TAX_REPORT, TAXES)
from tillbook.session import scratch_dir  # noqa: E402


def _lake(spark, label: str) -> pipeline.Lake:
    return pipeline.Lake(scratch_dir(spark, label))


def _silver(spark, label, domain) -> storage.Table:
    return _lake(spark, label).silver(domain)


def _as_text(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)


# Silver rows as stored: declared types, so branch and order id are text.
SILVER_SQL = {
    "frete": f"SELECT * REPLACE ({_as_text('pedido_id', 'filial_id')}) FROM {fx.SQL['frete']} f",
    "tributos": f"SELECT * REPLACE ({_as_text('filial_id')}) FROM {fx.SQL['tributos']} t",
    "vendas": f"SELECT * REPLACE ({_as_text('filial_id')}) FROM {fx.SQL['vendas']} v",
    "estoque": f"SELECT * REPLACE ({_as_text('filial_id')}) FROM {fx.SQL['estoque']} e",
    "devolucao": f"SELECT * REPLACE ({_as_text('filial_id')}) FROM {fx.SQL['devolucao']} d",
}


def _gold_text(sql: str) -> str:
    """A gold oracle with the branch as text, as the pipeline stores it."""
    return f"SELECT * REPLACE ({_as_text('FilialId')}) FROM ({sql}) g"


HALF = ("2024-01-01", "2024-01-15")        # replaced days in the T5 query
EMPTIED = ("2024-01-02", "2024-01-03")     # days replaced by nothing
DROPPED = ("2024-01-01", "2024-01-15")     # days deleted in the T4 queries


# --- S3, S4, T2 ----------------------------------------------------------------
@register("silver_scan_full", SILVER_SQL["vendas"])
def silver_scan_full(spark, sf_dir):
    t = _silver(spark, "scan", SALES)
    storage.create(spark, t, fx.sales(spark, sf_dir))
    return storage.read(spark, t)


@register("silver_scan_day",
          f"SELECT * FROM ({SILVER_SQL['vendas']}) s WHERE data_venda = DATE '1996-03-01'")
def silver_scan_day(spark, sf_dir):
    t = _silver(spark, "scanday", SALES)
    storage.create(spark, t, fx.sales(spark, sf_dir))
    return storage.read(spark, t, days=["1996-03-01"])


@register("table_create", SILVER_SQL["frete"])
def table_create(spark, sf_dir):
    t = _silver(spark, "create", FREIGHT)
    true = fx.freight(spark, sf_dir)
    storage.create(spark, t, true.withColumn("valor_frete", F.col("valor_frete") + 1))
    storage.create(spark, t, true)          # replaces the whole table
    return storage.read(spark, t)


# --- T3 ------------------------------------------------------------------------
@register("append_schema_evolution", f"""
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS transportadora), CAST(NULL AS VARCHAR) AS canal
FROM ({SILVER_SQL['frete']}) a
UNION ALL
SELECT *, 'web' AS canal FROM ({SILVER_SQL['frete']}) b""")
def append_schema_evolution(spark, sf_dir):
    t = _silver(spark, "append", FREIGHT)
    f = fx.freight(spark, sf_dir)
    storage.append(spark, t, f.drop("transportadora"))            # a column missing
    storage.append(spark, t, f.withColumn("canal", F.lit("web")))  # a column added
    return storage.read(spark, t, evolved=True)


_WEB = "concat('web', CAST(pedido_id AS VARCHAR))"


@register("upsert_keeps_new_columns", f"""
SELECT * REPLACE (valor_frete + 1 AS valor_frete), {_WEB} AS canal FROM ({SILVER_SQL['frete']}) f""")
def upsert_keeps_new_columns(spark, sf_dir):
    t = _silver(spark, "upsertnew", FREIGHT)
    f = fx.freight(spark, sf_dir).withColumn("data_envio", F.trunc("data_envio", "month"))
    storage.append(spark, t, f.withColumn("canal", F.expr("concat('web', CAST(pedido_id AS STRING))")))
    storage.upsert(spark, t, fx.freight(spark, sf_dir).withColumn("valor_frete", F.col("valor_frete") + 1))
    return storage.read(spark, t, evolved=True)          # every row matched and moved to its own day


@register("delete_where_keeps_new_columns", f"""
SELECT * FROM (SELECT *, 'u' || CAST(filial_id AS VARCHAR) AS canal FROM ({SILVER_SQL['tributos']}) t) x
WHERE NOT (valor_pago > 50 AND canal <> 'u3')""")
def delete_where_keeps_new_columns(spark, sf_dir):
    t = _silver(spark, "deletenew", TAXES)
    storage.append(spark, t, fx.taxes(spark, sf_dir).withColumn(
        "canal", F.expr("concat('u', CAST(filial_id AS STRING))")))
    storage.delete_where(spark, t, "valor_pago > 50 AND canal <> 'u3'")
    return storage.read(spark, t, evolved=True)


# --- T4 ------------------------------------------------------------------------
_DROPPED_SQL = f"""SELECT * FROM ({SILVER_SQL['tributos']}) t
WHERE data_pagamento NOT IN (DATE '{DROPPED[0]}', DATE '{DROPPED[1]}')"""


@register("delete_day", _DROPPED_SQL)
def delete_day(spark, sf_dir):
    t = _silver(spark, "delete", TAXES)
    storage.create(spark, t, fx.taxes(spark, sf_dir))
    storage.delete_days(spark, t, DROPPED)
    return storage.read(spark, t)


@register("delete_where_day", _DROPPED_SQL)
def delete_where_day(spark, sf_dir):
    # the reference's form: a SQL predicate string comparing the day to text
    t = _silver(spark, "deletewhere", TAXES)
    storage.create(spark, t, fx.taxes(spark, sf_dir))
    for d in DROPPED:
        storage.delete_where(spark, t, f"data_pagamento = '{d}'")
    return storage.read(spark, t)


# --- T5 ------------------------------------------------------------------------
@register("replace_day", f"""
SELECT * FROM ({SILVER_SQL['tributos']}) t
WHERE data_pagamento BETWEEN DATE '{HALF[0]}' AND DATE '{HALF[1]}'
UNION ALL
SELECT * REPLACE (valor_pago + 1 AS valor_pago) FROM ({SILVER_SQL['tributos']}) t
WHERE NOT (data_pagamento BETWEEN DATE '{HALF[0]}' AND DATE '{HALF[1]}')""")
def replace_day(spark, sf_dir):
    t = _silver(spark, "replace", TAXES)
    true = fx.taxes(spark, sf_dir)
    storage.create(spark, t, true.withColumn("valor_pago", F.col("valor_pago") + 1))
    days = day_range(*HALF)
    storage.replace_days(spark, t, true.filter(F.col("data_pagamento").isin(days)), days)
    return storage.read(spark, t)


@register("replace_day_empty", f"""SELECT * FROM ({SILVER_SQL['tributos']}) t
WHERE data_pagamento NOT IN (DATE '{EMPTIED[0]}', DATE '{EMPTIED[1]}')""")
def replace_day_empty(spark, sf_dir):
    t = _silver(spark, "replaceempty", TAXES)
    true = fx.taxes(spark, sf_dir)
    storage.create(spark, t, true)
    storage.replace_days(spark, t, true.filter(F.lit(False)), EMPTIED)
    return storage.read(spark, t)


# --- T6 ------------------------------------------------------------------------
NEW_KEY_OFFSET = 10 ** 12


@register("upsert_by_key", f"""
SELECT * FROM ({SILVER_SQL['frete']}) f
UNION ALL
SELECT * REPLACE (CAST(CAST(pedido_id AS BIGINT) + {NEW_KEY_OFFSET} AS VARCHAR) AS pedido_id)
FROM ({SILVER_SQL['frete']}) n""")
def upsert_by_key(spark, sf_dir):
    t = _silver(spark, "upsert", FREIGHT)
    true = fx.freight(spark, sf_dir)
    storage.create(spark, t, true.withColumn("valor_frete", F.col("valor_frete") + 1))
    new = true.withColumn("pedido_id", F.col("pedido_id") + NEW_KEY_OFFSET)
    storage.upsert(spark, t, true.unionByName(new))   # every key updated, as many inserted
    return storage.read(spark, t)


@register("upsert_moves_day", f"""
SELECT * REPLACE (CAST(data_envio + INTERVAL 1 DAY AS DATE) AS data_envio)
FROM ({SILVER_SQL['frete']}) f""")
def upsert_moves_day(spark, sf_dir):
    t = _silver(spark, "upsertmove", FREIGHT)
    true = fx.freight(spark, sf_dir)
    storage.create(spark, t, true)
    storage.upsert(spark, t, true.withColumn("data_envio", F.date_add("data_envio", 1)))
    return storage.read(spark, t)


# --- F3-F6, A7-A9 over the gold summaries --------------------------------------
BRANCH_PICK = (1, 5, 7, 12)
RANGE = ("1996-01-01", "1998-12-31")
PRODUCT_PICK = 10
ONE_PRODUCT = 2                 # with rows for the picked branches and range



def _products(spark, sf_dir):
    return gold.product_summary_tagged(fx.product_lines(spark, sf_dir))


@register("report_filter_branches",
          f"SELECT * FROM ({PRODUCTS_SQL}) p WHERE FilialId IN {BRANCH_PICK}")
def report_filter_branches(spark, sf_dir):
    return reports.filter_report(_products(spark, sf_dir), branches=BRANCH_PICK)


@register("report_filter_dates", f"""SELECT * FROM ({PRODUCTS_SQL}) p
WHERE CodigoData BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""")
def report_filter_dates(spark, sf_dir):
    return reports.filter_report(_products(spark, sf_dir), lo=RANGE[0], hi=RANGE[1])


@register("report_filter_product",
          f"SELECT * FROM ({PRODUCTS_SQL}) p WHERE ProdutoId = {PRODUCT_PICK}")
def report_filter_product(spark, sf_dir):
    return reports.filter_report(_products(spark, sf_dir), product=PRODUCT_PICK)


@register("report_filter_all_products", PRODUCTS_SQL)
def report_filter_all_products(spark, sf_dir):
    return reports.filter_report(_products(spark, sf_dir), product="*")


@register("report_filter_all", f"""SELECT * FROM ({PRODUCTS_SQL}) p
WHERE FilialId IN {BRANCH_PICK} AND ProdutoId = {ONE_PRODUCT}
  AND CodigoData BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""")
def report_filter_all(spark, sf_dir):
    return reports.filter_report(_products(spark, sf_dir), BRANCH_PICK, RANGE[0], RANGE[1],
                                 ONE_PRODUCT)


@register("report_filter_no_branch", f"SELECT * FROM ({PRODUCTS_SQL}) p WHERE FALSE")
def report_filter_no_branch(spark, sf_dir):
    return reports.filter_report(_products(spark, sf_dir), branches=[])


def _daily_money(sql: str, measure: str) -> str:
    return f"""SELECT CodigoData, FilialId,
       CAST(COALESCE(SUM(CAST({measure} AS DECIMAL(18,4))), 0) AS DOUBLE) AS {measure}
FROM ({sql}) g WHERE CodigoData IS NOT NULL AND FilialId IS NOT NULL GROUP BY 1, 2"""


@register("daily_taxes_by_branch", _daily_money(TAXES_SQL, "TotalImpostoPago"))
def daily_taxes_by_branch(spark, sf_dir):
    return reports.daily_totals(gold_taxes(spark, sf_dir), "TotalImpostoPago", money=True)


@register("daily_freight_by_branch", _daily_money(FREIGHT_SQL, "TotalFretePago"))
def daily_freight_by_branch(spark, sf_dir):
    return reports.daily_totals(gold_freight(spark, sf_dir), "TotalFretePago", money=True)


@register("daily_quantity_by_branch", f"""SELECT CodigoData, FilialId,
       CAST(COALESCE(SUM(TotalQuantidadeVendida), 0) AS BIGINT) AS TotalQuantidadeVendida
FROM ({PRODUCTS_SQL}) g WHERE CodigoData IS NOT NULL AND FilialId IS NOT NULL GROUP BY 1, 2""")
def daily_quantity_by_branch(spark, sf_dir):
    return reports.daily_totals(_products(spark, sf_dir), "TotalQuantidadeVendida",
                                money=False)


@register("distinct_branches",
          f"SELECT DISTINCT FilialId FROM ({TAXES_SQL}) g WHERE FilialId IS NOT NULL")
def distinct_branches(spark, sf_dir):
    return reports.distinct_values(gold_taxes(spark, sf_dir), "FilialId")


@register("distinct_products",
          f"SELECT DISTINCT ProdutoId FROM ({PRODUCTS_SQL}) g WHERE ProdutoId IS NOT NULL")
def distinct_products(spark, sf_dir):
    return reports.distinct_values(_products(spark, sf_dir), "ProdutoId")


@register("distinct_days",
          f"SELECT DISTINCT CodigoData FROM ({FREIGHT_SQL}) g WHERE CodigoData IS NOT NULL")
def distinct_days(spark, sf_dir):
    return reports.distinct_values(gold_freight(spark, sf_dir), "CodigoData")


@register("date_bounds", f"""SELECT MIN(CodigoData) AS first_day, MAX(CodigoData) AS last_day
FROM ({FREIGHT_SQL}) g""")
def date_bounds(spark, sf_dir):
    return reports.date_bounds(gold_freight(spark, sf_dir))


NO_DATA = ("2099-01-01", "2099-12-31")     # a range no table reaches: an empty report


@register("date_bounds_empty", f"""SELECT MIN(CodigoData) AS first_day, MAX(CodigoData) AS last_day
FROM ({FREIGHT_SQL}) g WHERE CodigoData BETWEEN DATE '{NO_DATA[0]}' AND DATE '{NO_DATA[1]}'""")
def date_bounds_empty(spark, sf_dir):
    # the whole freight summary is computed; the range then leaves no row
    return reports.date_bounds(reports.filter_report(gold_freight(spark, sf_dir),
                                                     lo=NO_DATA[0], hi=NO_DATA[1]))


# --- A3, A4, A5/A6 alone, J1 in join form, O2 -----------------------------------
@register("returns_summary", f"""SELECT day AS CodigoData, product AS ProdutoId,
       branch AS FilialId, CAST(SUM(qty) AS BIGINT) AS TotalDevolvido
FROM {fx.LINES_SQL} l WHERE flag = 'R' GROUP BY 1, 2, 3""")
def returns_summary(spark, sf_dir):
    return gold.returns_summary(fx.returns(spark, sf_dir))


@register("stock_summary", f"""SELECT day AS CodigoData, product AS ProdutoId,
       branch AS FilialId, CAST(SUM(qty) AS BIGINT) AS TotalEmEstoque
FROM {fx.LINES_SQL} l WHERE flag = 'A' GROUP BY 1, 2, 3""")
def stock_summary(spark, sf_dir):
    return gold.stock_summary(fx.stock(spark, sf_dir))


@register("sales_summary", f"""SELECT day AS CodigoData, product AS ProdutoId, branch AS FilialId,
       CAST(SUM(qty) AS BIGINT) AS TotalQuantidadeVendida,
       {_money('price', 2)} AS TotalValorVendido,
       CASE WHEN SUM(qty) = 0 THEN NULL ELSE
         ((2 * CAST(SUM(CAST(price AS DECIMAL(18,2))) * 100 AS BIGINT) + SUM(qty))
          // (2 * SUM(qty))) / 100.0 END AS TicketMedio
FROM {fx.LINES_SQL} l WHERE flag = 'N' GROUP BY 1, 2, 3""")
def sales_summary(spark, sf_dir):
    return gold.sales_summary(fx.sales(spark, sf_dir))


@register("gold_products_by_join", PRODUCTS_SQL)
def gold_products_by_join(spark, sf_dir):
    return gold.product_summary_by_join(fx.returns(spark, sf_dir), fx.stock(spark, sf_dir),
                                        fx.sales(spark, sf_dir))


@register("gold_products_preview", f"""SELECT * FROM ({PRODUCTS_SQL}) p
ORDER BY CodigoData, ProdutoId, FilialId LIMIT 5""")
def gold_products_preview(spark, sf_dir):
    return gold.preview(_products(spark, sf_dir), gold.KEYS_PRODUCT, 5)


# --- P2, O1, P5 through a lake of silver and gold tables ---------------------------
def _silver_lake(spark, sf_dir, label, domains) -> pipeline.Lake:
    lake = _lake(spark, label)
    for d in domains:
        storage.create(spark, lake.silver(d), fx.FRAMES[d.name](spark, sf_dir))
    return lake


@register("gold_bootstrap_equals_incremental", _gold_text(PRODUCTS_SQL))
def gold_bootstrap_equals_incremental(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir, "goldinc", (RETURNS, STOCK, SALES))
    days = pipeline.build_gold(spark, lake, PRODUCT_REPORT)         # bootstrap
    pipeline.build_gold(spark, lake, PRODUCT_REPORT, days=days)     # every day again
    return storage.read(spark, lake.gold(PRODUCT_REPORT))


@register("gold_taxes_sorted", _gold_text(TAXES_SQL))
def gold_taxes_sorted(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir, "goldtax", (TAXES,))
    pipeline.build_gold(spark, lake, TAX_REPORT)
    return storage.read(spark, lake.gold(TAX_REPORT)).orderBy(*gold.KEYS_TAX)


@register("report_days_stored", f"""SELECT DISTINCT CodigoData FROM ({TAXES_SQL}) g""")
def report_days_stored(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir, "days", (TAXES,))
    pipeline.build_gold(spark, lake, TAX_REPORT)
    return pipeline.report_choices(spark, lake, "taxes")["days"]


@register("report_bounds_stored", f"""SELECT MIN(CodigoData) AS first_day, MAX(CodigoData) AS last_day
FROM ({TAXES_SQL}) g""")
def report_bounds_stored(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir, "bounds", (TAXES,))
    pipeline.build_gold(spark, lake, TAX_REPORT)
    return pipeline.report_choices(spark, lake, "taxes")["bounds"]


@register("upsert_few_keys", f"""SELECT f.* REPLACE (valor_frete + (pedido_id IN (
  SELECT pedido_id FROM ({SILVER_SQL["frete"]}) n WHERE pedido_id IS NOT NULL ORDER BY pedido_id LIMIT 300)
  )::INT AS valor_frete) FROM ({SILVER_SQL["frete"]}) f""")
def upsert_few_keys(spark, sf_dir):
    t = _silver(spark, "few", FREIGHT)
    rows = fx.freight(spark, sf_dir)
    storage.create(spark, t, rows)
    few = rows.filter("pedido_id IS NOT NULL").orderBy(F.col("pedido_id").cast("string")).limit(300)
    storage.upsert(spark, t, few.withColumn("valor_frete", F.col("valor_frete") + 1))
    return storage.read(spark, t)


@register("report_products_filtered", f"""SELECT * FROM ({_gold_text(PRODUCTS_SQL)}) p
WHERE FilialId IN {tuple(str(b) for b in BRANCH_PICK)}
  AND CodigoData BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""")
def report_products_filtered(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir, "report", (RETURNS, STOCK, SALES))
    pipeline.build_gold(spark, lake, PRODUCT_REPORT)
    return pipeline.report(spark, lake, "products", [str(b) for b in BRANCH_PICK],
                           RANGE[0], RANGE[1], product="*")


@register("report_series_taxes", _daily_money(_gold_text(TAXES_SQL), "TotalImpostoPago"))
def report_series_taxes(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir, "series", (TAXES,))
    pipeline.build_gold(spark, lake, TAX_REPORT)
    return pipeline.report_series(spark, lake, "taxes")


# --- S1, S2, P1, P3, P4 from bronze files derived from the tables ------------------
def _bronze_lake(spark, sf_dir, label, domains) -> tuple[pipeline.Lake, dict]:
    lake = _lake(spark, label)
    days = {d.name: fx.write_bronze(spark, lake.root, d, fx.FRAMES[d.name](spark, sf_dir))
            for d in domains}
    return lake, days


@register("bronze_scan_day", SILVER_SQL["tributos"])
def bronze_scan_day(spark, sf_dir):
    from tillbook.sources import bronze
    lake, days = _bronze_lake(spark, sf_dir, "bronze", (TAXES,))
    return bronze.read_days(spark, lake.root, TAXES, days["tributos"])


@register("bronze_scan_infer", f"SELECT * FROM {fx.SQL['tributos']} t")
def bronze_scan_infer(spark, sf_dir):
    # inferred types: branch numbers come back as numbers
    from tillbook.sources import bronze
    lake, days = _bronze_lake(spark, sf_dir, "infer", (TAXES,))
    return bronze.read_days(spark, lake.root, TAXES, days["tributos"], infer=True)


@register("ingest_sales_replace", SILVER_SQL["vendas"])
def ingest_sales_replace(spark, sf_dir):
    lake, days = _bronze_lake(spark, sf_dir, "ingestsales", (SALES,))
    pipeline.ingest(spark, lake, SALES, days["vendas"])     # bootstrap
    pipeline.ingest(spark, lake, SALES, days["vendas"])     # re-run: replaces every day
    return storage.read(spark, lake.silver(SALES))


@register("ingest_freight_upsert", SILVER_SQL["frete"])
def ingest_freight_upsert(spark, sf_dir):
    lake, days = _bronze_lake(spark, sf_dir, "ingestfreight", (FREIGHT,))
    pipeline.ingest(spark, lake, FREIGHT, days["frete"])    # bootstrap
    pipeline.ingest(spark, lake, FREIGHT, days["frete"])    # re-run: upsert of every key
    return storage.read(spark, lake.silver(FREIGHT))


RETURNS_SQL = f"SELECT * REPLACE ({_as_text('pedido_id', 'filial_id')}) FROM {fx.SQL['devolucao_pedido']} d"


@register("ingest_returns_upsert", f"SELECT * REPLACE (quantidade + 1 AS quantidade) FROM ({RETURNS_SQL}) r")
def ingest_returns_upsert(spark, sf_dir):
    lake = _lake(spark, "ingestreturns")
    first = fx.returns_by_order(spark, sf_dir)
    for df in (first, first.withColumn("quantidade", F.col("quantidade") + 1)):
        days = fx.write_bronze(spark, lake.root, RETURNS, df)
        pipeline.ingest(spark, lake, RETURNS, days)      # bootstrap, then an upsert of every key
    return storage.read(spark, lake.silver(RETURNS))


@register("backfill_range", _gold_text(TAXES_SQL))
def backfill_range(spark, sf_dir):
    lake, days = _bronze_lake(spark, sf_dir, "backfill", (TAXES,))
    pipeline.backfill(spark, lake, min(days["tributos"]), max(days["tributos"]),
                      domains=["tributos"])
    return storage.read(spark, lake.gold(TAX_REPORT))


@register("backfill_keyed_with_gaps", f"""
SELECT * REPLACE (quantidade + 1 AS quantidade, CAST(data_devolucao + INTERVAL 1 MONTH AS DATE) AS data_devolucao)
FROM ({RETURNS_SQL}) r""")
def backfill_keyed_with_gaps(spark, sf_dir):
    # a file on the first of each month only; every key again, changed, in the next
    # month's file, whose row wins
    lake = _lake(spark, "backfillkeyed")
    first = fx.returns_by_order(spark, sf_dir)
    later = first.withColumns({"quantidade": F.col("quantidade") + 1,
                               "data_devolucao": F.add_months("data_devolucao", 1)})
    days = fx.write_bronze(spark, lake.root, RETURNS, first.unionByName(later))
    out = pipeline.backfill(spark, lake, min(days), max(days), domains=["devolucao"])
    assert out["missing"]["devolucao"] and set(days) <= set(out["touched"]["devolucao"])
    return storage.read(spark, lake.silver(RETURNS))


# All five domains on common days, the first of a month.
MONTHLY = {
    "frete": "SELECT * REPLACE (CAST(date_trunc('month', data_envio) AS DATE) AS data_envio)"
             f" FROM {fx.SQL['frete']} f",
    "tributos": "SELECT CAST(DATE '1996-01-01' + to_months(CAST(user_id % 24 AS INTEGER)) AS DATE)"
                " AS data_pagamento, event_type AS tipo_imposto, value AS valor_pago,"
                f" user_id % {fx.BRANCHES} AS filial_id FROM events",
}


def monthly_frames(spark, sf_dir) -> dict:
    frames = {n: f(spark, sf_dir) for n, f in fx.FRAMES.items()}
    frames["frete"] = frames["frete"].withColumn("data_envio", F.trunc("data_envio", "month"))
    frames["tributos"] = frames["tributos"].withColumn(
        "data_pagamento", F.expr("add_months(DATE'1996-01-01', CAST(filial_id AS INT))"))
    return frames


def _all(spark, jobs: dict) -> dict:
    """What independent jobs return that run side by side; the first failure is raised."""
    out = pipeline.concurrently(spark, jobs)
    for got in out.values():
        if isinstance(got, Exception):
            raise got
    return out


@register("run_day_summary", f"""
SELECT 'taxes' AS report, CodigoData, CAST(FilialId AS VARCHAR) AS FilialId, TipoImposto AS item,
       TotalImpostoPago AS total FROM ({TAXES_SQL.replace(fx.SQL['tributos'], f"({MONTHLY['tributos']})")}) t
UNION ALL
SELECT 'freight', CodigoData, CAST(FilialId AS VARCHAR), Transportadora, TotalFretePago
FROM ({FREIGHT_SQL.replace(fx.SQL['frete'], f"({MONTHLY['frete']})")}) f
UNION ALL
SELECT 'products', CodigoData, CAST(FilialId AS VARCHAR), CAST(ProdutoId AS VARCHAR), TotalValorVendido
FROM ({PRODUCTS_SQL}) p""")
def run_day_summary(spark, sf_dir):
    # History without one day, then the daily run adds that day to all five
    # domains and all three reports.  (Re-running a day would insert the returns
    # again: their order id is NULL here, and NULL keys never match in an upsert
    # - the reference's merge does the same.)
    # Domains and reports of the history go side by side, as in the daily run.
    lake, frames = _lake(spark, "runday"), monthly_frames(spark, sf_dir)
    days = _all(spark, {n: lambda n=n: fx.write_bronze(spark, lake.root, DOMAINS[n], frames[n]) for n in frames})
    common = sorted(set.intersection(*map(set, days.values())))
    today = common[len(common) // 2]
    _all(spark, {n: lambda n=n: pipeline.ingest(spark, lake, n, [x for x in days[n] if x != today]) for n in frames})
    _all(spark, {r: lambda r=r: pipeline.build_gold(spark, lake, r) for r in pipeline.REPORTS})
    out = pipeline.run_day(spark, lake, today)
    assert set(out["status"].values()) == {"ok"}, out
    one = {n: storage.read(spark, lake.gold(r)) for n, r in pipeline.REPORTS.items()}
    return one["taxes"].selectExpr(
        "'taxes' AS report", "CodigoData", "FilialId", "TipoImposto AS item", "TotalImpostoPago AS total").unionByName(
        one["freight"].selectExpr("'freight' AS report", "CodigoData", "FilialId", "Transportadora AS item",
                                  "TotalFretePago AS total")).unionByName(
        one["products"].selectExpr("'products' AS report", "CodigoData", "FilialId",
                                   "CAST(ProdutoId AS STRING) AS item", "TotalValorVendido AS total"))
