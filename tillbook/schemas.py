"""Declared schemas of the five source domains and the three reports.

Every domain is a day-partitioned table; every report too.  Types are declared
here once, so no job depends on CSV inference (a day of whole-number prices
would otherwise turn a money column into ``int``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class Domain:
    """One bronze source and the silver table it feeds.

    ``key`` set  -> the day is applied as an upsert on that column.
    ``key`` None -> the day is replaced as a whole.
    """

    name: str          # silver domain folder and table name
    system: str        # bronze system folder
    prefix: str        # bronze file prefix: <prefix>_YYYY_MM_DD.csv
    day: str           # day column (the partition column)
    schema: T.StructType
    key: str | None = None

    @property
    def upsert(self) -> bool:
        return self.key is not None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


@dataclass(frozen=True)
class Report:
    """One gold table."""

    name: str
    folder: str        # gold area folder
    table: str         # gold table folder
    day: str
    keys: tuple[str, ...]           # grain, day first
    measures: tuple[str, ...]
    schema: T.StructType
    needs: tuple[str, ...] = field(default=())   # source domains

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# --- fixed values: names and types of the reference's data contract --------
# Silver domains (name, bronze system, file prefix, day column, key) and their
# columns in declared order.
SALES = Domain(
    "vendas", "sistema_vendas", "vendas", "data_venda",
    _schema(("data_venda", T.DateType()), ("produto_id", T.IntegerType()),
            ("filial_id", T.StringType()), ("quantidade", T.IntegerType()),
            ("valor_unitario", T.DoubleType())),
)
FREIGHT = Domain(
    "frete", "sistema_frete", "frete", "data_envio",
    _schema(("pedido_id", T.StringType()), ("valor_frete", T.DoubleType()),
            ("data_envio", T.DateType()), ("transportadora", T.StringType()),
            ("filial_id", T.StringType())),
    key="pedido_id",
)
TAXES = Domain(
    "tributos", "sistema_tributos", "tributos", "data_pagamento",
    _schema(("data_pagamento", T.DateType()), ("tipo_imposto", T.StringType()),
            ("valor_pago", T.DoubleType()), ("filial_id", T.StringType())),
)
STOCK = Domain(
    "estoque", "sistema_estoque", "estoque", "data_referencia",
    _schema(("produto_id", T.IntegerType()), ("filial_id", T.StringType()),
            ("quantidade_disponivel", T.IntegerType()),
            ("data_referencia", T.DateType())),
)
RETURNS = Domain(
    "devolucao", "sistema_devolucao", "devolucao", "data_devolucao",
    _schema(("pedido_id", T.StringType()), ("produto_id", T.IntegerType()),
            ("quantidade", T.IntegerType()), ("motivo", T.StringType()),
            ("data_devolucao", T.DateType()), ("filial_id", T.StringType())),
    key="pedido_id",
)

# Gold reports: folder/table names, grain and measures.
TAX_REPORT = Report(
    "taxes", "tributario", "tb_gd_resumo_impostos_pagos", "CodigoData",
    ("CodigoData", "FilialId", "TipoImposto"), ("TotalImpostoPago",),
    _schema(("CodigoData", T.DateType()), ("FilialId", T.StringType()),
            ("TipoImposto", T.StringType()), ("TotalImpostoPago", T.DoubleType())),
    needs=("tributos",),
)
FREIGHT_REPORT = Report(
    "freight", "logistica", "tb_gd_resumo_fretes_pagos", "CodigoData",
    ("CodigoData", "FilialId", "Transportadora"), ("TotalFretePago",),
    _schema(("CodigoData", T.DateType()), ("FilialId", T.StringType()),
            ("Transportadora", T.StringType()), ("TotalFretePago", T.DoubleType())),
    needs=("frete",),
)
PRODUCT_REPORT = Report(
    "products", "vendas", "tb_gd_resumo_produtos_filiais", "CodigoData",
    ("CodigoData", "ProdutoId", "FilialId"),
    ("TotalDevolvido", "TotalEmEstoque", "TotalQuantidadeVendida",
     "TotalValorVendido", "TicketMedio"),
    _schema(("CodigoData", T.DateType()), ("ProdutoId", T.IntegerType()),
            ("FilialId", T.StringType()), ("TotalDevolvido", T.LongType()),
            ("TotalEmEstoque", T.LongType()),
            ("TotalQuantidadeVendida", T.LongType()),
            ("TotalValorVendido", T.DoubleType()), ("TicketMedio", T.DoubleType())),
    needs=("devolucao", "estoque", "vendas"),
)
# --- end of fixed values -----------------------------------------------------

DOMAINS: dict[str, Domain] = {d.name: d for d in (RETURNS, STOCK, SALES, FREIGHT, TAXES)}
REPORTS: dict[str, Report] = {r.name: r for r in (TAX_REPORT, FREIGHT_REPORT, PRODUCT_REPORT)}
