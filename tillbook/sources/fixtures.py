"""Domain frames derived from the driver's TPC-H-like tables.

The driver ships no sales or freight data, so each source domain is mapped onto
its tables (FIXTURES.md section 3).  Every frame is a lazy projection of whole
tables: Catalyst prunes columns and pushes the flag filters to the scan.

Branch ids are integers here (strings in the bronze files); no transform
depends on the branch type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.schemas import FREIGHT, RETURNS, SALES, STOCK, TAXES

# --- fixed values: how the driver's columns stand in for the domains ---------
SALE_FLAG, STOCK_FLAG, RETURN_FLAG = "N", "A", "R"
BRANCHES = 24   # tax branch = user_id % 24
PRODUCTS = 50   # product of an order's return = customer % 50
# --- end of fixed values ----------------------------------------------------


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  Its schema is read from the footers once per process
    and then declared, so later reads start no schema-inference job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem ⋈ part ⋈ supplier`` once, tagged by return flag.

    Columns: ``day, product, branch, flag, qty, price`` - the common shape of the
    sales (N), stock (A) and returns (R) domains.  Day = month of ship date.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice",
        "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(part, F.expr("l_partkey = p_partkey"))
            .join(supp, F.expr("l_suppkey = s_suppkey"))
            .selectExpr("trunc(to_date(l_shipdate), 'month') AS day", "p_size AS product",
                        "s_nationkey AS branch", "l_returnflag AS flag",
                        "CAST(l_quantity AS INT) AS qty", "l_extendedprice AS price"))


def _lines(spark, sf_dir, flag):
    return product_lines(spark, sf_dir).where(f"flag = '{flag}'")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, SALE_FLAG).selectExpr(
        "day AS data_venda", "product AS produto_id", "branch AS filial_id",
        "qty AS quantidade", "price AS valor_unitario")


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, STOCK_FLAG).selectExpr(
        "product AS produto_id", "branch AS filial_id", "qty AS quantidade_disponivel",
        "day AS data_referencia")


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No unique order id exists for a returned line, so pedido_id is NULL here;
    # returns_by_order has returns with a key.
    return _lines(spark, sf_dir, RETURN_FLAG).selectExpr(
        "CAST(NULL AS STRING) AS pedido_id", "product AS produto_id", "qty AS quantidade",
        "CAST(NULL AS STRING) AS motivo", "day AS data_devolucao", "branch AS filial_id")


def freight(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, F.expr("o_custkey = c_custkey")).selectExpr(
        "o_orderkey AS pedido_id", "o_totalprice AS valor_frete",
        "to_date(o_orderdate) AS data_envio", "o_orderpriority AS transportadora",
        "c_nationkey AS filial_id")


def returns_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns keyed by order: one per order, on the first of its month."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, F.expr("o_custkey = c_custkey")).selectExpr(
        "o_orderkey AS pedido_id", f"CAST(o_custkey % {PRODUCTS} AS INT) AS produto_id",
        "CAST(1 + o_orderkey % 9 AS INT) AS quantidade", "o_orderpriority AS motivo",
        "trunc(to_date(o_orderdate), 'month') AS data_devolucao", "c_nationkey AS filial_id")


def taxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "to_date(ts) AS data_pagamento", "event_type AS tipo_imposto",
        "value AS valor_pago", f"user_id % {BRANCHES} AS filial_id")


FRAMES = {
    SALES.name: sales, STOCK.name: stock, RETURNS.name: returns,
    FREIGHT.name: freight, TAXES.name: taxes,
}

# SQL text of the same mappings, for the DuckDB oracle (tables are views there).
LINES_SQL = """(SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS day,
        p.p_size AS product, s.s_nationkey AS branch, l.l_returnflag AS flag,
        CAST(l.l_quantity AS INTEGER) AS qty, l.l_extendedprice AS price
   FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                   JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""
SQL = {
    "vendas": f"""(SELECT day AS data_venda, product AS produto_id, branch AS filial_id,
        qty AS quantidade, price AS valor_unitario FROM {LINES_SQL} x WHERE flag = 'N')""",
    "estoque": f"""(SELECT product AS produto_id, branch AS filial_id,
        qty AS quantidade_disponivel, day AS data_referencia FROM {LINES_SQL} x WHERE flag = 'A')""",
    "devolucao": f"""(SELECT CAST(NULL AS VARCHAR) AS pedido_id, product AS produto_id,
        qty AS quantidade, CAST(NULL AS VARCHAR) AS motivo, day AS data_devolucao,
        branch AS filial_id FROM {LINES_SQL} x WHERE flag = 'R')""",
    "devolucao_pedido": f"""(SELECT o.o_orderkey AS pedido_id,
        CAST(o.o_custkey % {PRODUCTS} AS INTEGER) AS produto_id,
        CAST(1 + o.o_orderkey % 9 AS INTEGER) AS quantidade, o.o_orderpriority AS motivo,
        CAST(date_trunc('month', o.o_orderdate) AS DATE) AS data_devolucao, c.c_nationkey AS filial_id
   FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)""",
    "frete": """(SELECT o.o_orderkey AS pedido_id, o.o_totalprice AS valor_frete,
        CAST(o.o_orderdate AS DATE) AS data_envio, o.o_orderpriority AS transportadora,
        c.c_nationkey AS filial_id
   FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)""",
    "tributos": """(SELECT CAST(ts AS DATE) AS data_pagamento, event_type AS tipo_imposto,
        value AS valor_pago, user_id % 24 AS filial_id FROM events)""",
}


def write_bronze(spark: SparkSession, root: str, domain, df: DataFrame) -> list[str]:
    """Write a domain frame as bronze files, one per day, in one Spark job.

    The frame is written partitioned by a copy of its day (so the day column
    stays in the file), then each day folder is renamed to the bronze name
    ``<prefix>_YYYY_MM_DD.csv`` - a folder of part files, which the bronze
    reader takes like a single file.  Returns the days written.
    """
    import uuid

    from tillbook.sources.bronze import bronze_path
    from tillbook.sources.fs import FS

    tmp = f"{root.rstrip('/')}/_bronze_tmp/{uuid.uuid4().hex}"
    from tillbook.operators.storage import write_by_day
    write_by_day(df.withColumn("_pday", F.date_format(F.col(domain.day), "yyyy-MM-dd")),
                 "_pday", ["_pday"], tmp, fmt="csv", header=True)
    fs = FS(spark, tmp)
    days = []
    for name in fs.children(tmp, dirs=True):
        if name.startswith("_pday="):
            day = name.split("=", 1)[1]
            dst = bronze_path(root, domain, day)
            fs.delete(dst)
            fs.rename(f"{tmp}/{name}", dst)
            days.append(day)
    fs.delete(tmp)
    return days
