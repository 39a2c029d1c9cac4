"""Gold summaries (A1-A6, J1, O1, O2) as pure DataFrame -> DataFrame functions.

Formulas kept from the reference, including two that look odd (B1):
``TotalValorVendido`` sums *unit prices* (not price x quantity) and
``TicketMedio`` divides that sum by the quantity sum.  Money is summed exactly
(see ``functions.money``), so results do not depend on partitioning.

Plan shape: each summary is one hash aggregation (partial aggregation before the
shuffle, so a hot day/branch never lands whole in one task).  The product
summary's three-way inner join of per-domain aggregates is expressed as ONE
aggregation over the union of the three inputs with presence flags - same rows
as the join (a key missing from any input, or with a NULL part, is dropped),
one shuffle instead of three plus a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.money import (rounded_sum_sql, to_double_sql, unit_sum_sql,
                                      wild_sum_sql, with_ratio)
from tillbook.schemas import FREIGHT_REPORT, PRODUCT_REPORT, TAX_REPORT

KEYS_TAX = list(TAX_REPORT.keys)
KEYS_FREIGHT = list(FREIGHT_REPORT.keys)
KEYS_PRODUCT = list(PRODUCT_REPORT.keys)


def _by(df: DataFrame, keys: list[tuple[str, str]], aggs: list[str]) -> DataFrame:
    """``groupBy`` renamed keys, aggregates given as SQL expression text."""
    return df.groupBy(*[F.expr(f"`{src}` AS {dst}") for src, dst in keys]) \
        .agg(*[F.expr(a) for a in aggs])


def tax_summary(tributos: DataFrame) -> DataFrame:
    """A1: ``round(sum(valor_pago), 4)`` by day, branch, tax type."""
    return _by(tributos, [("data_pagamento", "CodigoData"), ("filial_id", "FilialId"),
                          ("tipo_imposto", "TipoImposto")],
               [f"{rounded_sum_sql('valor_pago', 4)} AS TotalImpostoPago"])


def freight_summary(frete: DataFrame) -> DataFrame:
    """A2: ``round(sum(valor_frete), 4)`` by day, branch, carrier."""
    return _by(frete, [("data_envio", "CodigoData"), ("filial_id", "FilialId"),
                       ("transportadora", "Transportadora")],
               [f"{rounded_sum_sql('valor_frete', 4)} AS TotalFretePago"])


# The reference's freight job is SQL text; identifiers match case-insensitively.
FREIGHT_SQL = f"""
SELECT DATA_ENVIO     AS CodigoData,
       FILIAL_ID      AS FilialId,
       transportadora AS Transportadora,
       {rounded_sum_sql('VALOR_FRETE', 4)} AS TotalFretePago
FROM {{view}}
GROUP BY DATA_ENVIO, FILIAL_ID, transportadora
"""


def freight_summary_sql(spark: SparkSession, frete: DataFrame,
                        view: str = "fretes") -> DataFrame:
    """S5 + A2 in SQL text over a temp view."""
    frete.createOrReplaceTempView(view)
    return spark.sql(FREIGHT_SQL.format(view=view))


def returns_summary(devolucao: DataFrame) -> DataFrame:
    """A3: ``sum(quantidade)`` by day, product, branch."""
    return _by(devolucao, [("data_devolucao", "CodigoData"), ("produto_id", "ProdutoId"),
                           ("filial_id", "FilialId")],
               ["sum(quantidade) AS TotalDevolvido"])


def stock_summary(estoque: DataFrame) -> DataFrame:
    """A4: ``sum(quantidade_disponivel)`` by day, product, branch."""
    return _by(estoque, [("data_referencia", "CodigoData"), ("produto_id", "ProdutoId"),
                         ("filial_id", "FilialId")],
               ["sum(quantidade_disponivel) AS TotalEmEstoque"])


def _sales_measures(qty: str, price: str) -> list[str]:
    return [f"sum({qty}) AS TotalQuantidadeVendida", f"{unit_sum_sql(price)} AS __v",
            f"{wild_sum_sql(price)} AS __w"]


def _finish_sales(df: DataFrame, keep: list[str]) -> DataFrame:
    """A5/A6 results from the per-group sums (runs once per group)."""
    df = with_ratio(df, "__v", "__w", "TotalQuantidadeVendida", "__t", 2,
                    keep=[*keep, "__v", "__w"])                    # A6, NULL on 0
    return df.selectExpr(*keep, f"{to_double_sql('__v', '__w', 2)} AS TotalValorVendido",
                         "__t AS TicketMedio")


def sales_summary(vendas: DataFrame) -> DataFrame:
    """A5 + A6: quantity, rounded price sum and average ticket in one pass."""
    df = _by(vendas, [("data_venda", "CodigoData"), ("produto_id", "ProdutoId"),
                      ("filial_id", "FilialId")],
             _sales_measures("quantidade", "valor_unitario"))
    return _finish_sales(df, [*KEYS_PRODUCT, "TotalQuantidadeVendida"])


# Tagged shape shared by the three product inputs.
def tag_returns(devolucao: DataFrame) -> DataFrame:
    return devolucao.selectExpr(
        "data_devolucao AS day", "produto_id AS product", "filial_id AS branch",
        "'R' AS flag", "quantidade AS qty", "CAST(NULL AS DOUBLE) AS price")


def tag_stock(estoque: DataFrame) -> DataFrame:
    return estoque.selectExpr(
        "data_referencia AS day", "produto_id AS product", "filial_id AS branch",
        "'A' AS flag", "quantidade_disponivel AS qty", "CAST(NULL AS DOUBLE) AS price")


def tag_sales(vendas: DataFrame) -> DataFrame:
    return vendas.selectExpr(
        "data_venda AS day", "produto_id AS product", "filial_id AS branch",
        "'N' AS flag", "quantidade AS qty", "valor_unitario AS price")


def product_summary_tagged(lines: DataFrame) -> DataFrame:
    """J1 over tagged lines (``day, product, branch, flag, qty, price``).

    flag R = returns, A = stock, N = sales.  A key is kept only when all three
    flags occur for it and no key part is NULL - the rows the reference's
    ``returns ⋈ stock ⋈ sales`` inner join on the three keys keeps.  Catalyst
    pushes the NULL-key test below the aggregation, to the scan.
    """
    df = _by(lines, [("day", "CodigoData"), ("product", "ProdutoId"), ("branch", "FilialId")], [
        "sum(CASE WHEN flag = 'R' THEN qty END) AS TotalDevolvido",
        "sum(CASE WHEN flag = 'A' THEN qty END) AS TotalEmEstoque",
        *_sales_measures("CASE WHEN flag = 'N' THEN qty END",
                         "CASE WHEN flag = 'N' THEN price END"),
        "bool_or(flag = 'R') AND bool_or(flag = 'A') AND bool_or(flag = 'N') AS __all",
    ]).where("__all AND CodigoData IS NOT NULL AND ProdutoId IS NOT NULL"
             " AND FilialId IS NOT NULL")
    return _finish_sales(df, [*KEYS_PRODUCT, "TotalDevolvido", "TotalEmEstoque",
                              "TotalQuantidadeVendida"])


def product_summary(devolucao: DataFrame, estoque: DataFrame,
                    vendas: DataFrame) -> DataFrame:
    """Products by day and branch with returns, stock, sales and ticket."""
    lines = tag_returns(devolucao).unionByName(tag_stock(estoque)).unionByName(
        tag_sales(vendas))
    return product_summary_tagged(lines)


def product_summary_by_join(devolucao: DataFrame, estoque: DataFrame,
                            vendas: DataFrame) -> DataFrame:
    """J1 in the reference's own shape: three aggregates, two inner joins.

    Kept as the readable definition and for the equivalence test; each
    aggregate is hash-partitioned on the join keys, so the sort-merge joins
    add no exchange of their own.
    """
    keys = KEYS_PRODUCT
    return (returns_summary(devolucao).join(stock_summary(estoque), keys, "inner")
            .join(sales_summary(vendas), keys, "inner"))


def preview(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """O2: first ``n`` rows in key order (top-n per task, no full sort)."""
    return df.orderBy(*keys).limit(n)
