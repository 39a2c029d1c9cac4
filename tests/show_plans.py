"""Write PLANS.md: formatted physical plans of the main jobs (python tests/show_plans.py)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tillbook.operators import gold, reports, storage  # noqa: E402
from tillbook.plans import pipeline  # noqa: E402
from tillbook.schemas import FREIGHT, PRODUCT_REPORT, RETURNS, SALES, STOCK  # noqa: E402
from tillbook.session import local_session, scratch_dir  # noqa: E402
from tillbook.sources import fixtures as fx  # noqa: E402

SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
OUT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def main():
    spark = local_session(8)
    lake = pipeline.Lake(scratch_dir(spark, "plans"))
    for d in (RETURNS, STOCK, SALES):
        storage.create(spark, lake.silver(d), fx.FRAMES[d.name](spark, SF))
    pipeline.build_gold(spark, lake, PRODUCT_REPORT)
    ftab = lake.silver(FREIGHT)
    storage.create(spark, ftab, fx.taxes(spark, SF).selectExpr(
        "CAST(rand(7) * 1e9 AS BIGINT) AS pedido_id", "valor_pago AS valor_frete",
        "data_pagamento AS data_envio", "tipo_imposto AS transportadora", "filial_id"))
    captured = {}
    orig = storage._write

    def spy(table, df, *options, **more):
        captured.setdefault("upsert", plan(df))
        return orig(table, df, *options, **more)

    storage._write = spy
    storage.upsert(spark, ftab, storage.read(spark, ftab, days=["2024-01-10"])
                   .withColumn("valor_frete", F.col("valor_frete") + 1))
    storage._write = orig

    sections = [
        ("Product summary (J1, A3-A6) over the fixture join",
         "One partial + final aggregation, one exchange on the three keys; part and "
         "supplier broadcast by Catalyst's size check; no Python.",
         gold.product_summary_tagged(fx.product_lines(spark, SF))),
        ("Tax summary (A1)", "Column pruning to four columns of `events`.",
         gold.tax_summary(fx.taxes(spark, SF))),
        ("Gold refresh of one day from silver (P2)",
         "Each silver scan lists and reads one day folder (PartitionFilters).",
         pipeline.summary(spark, lake, PRODUCT_REPORT, days=["1997-06-01"])),
        ("Report filter on the gold table (F6)",
         "Date range as partition filter, branch list pushed to Parquet.",
         pipeline.report(spark, lake, "products", ["1", "5"], "1996-01-01", "1996-12-31", 10)),
        ("Daily totals (A7)", "Exact money sum per day and branch.",
         reports.daily_totals(gold.freight_summary(fx.freight(spark, SF)), "TotalFretePago", True)),
    ]
    with open(OUT, "w") as fh:
        fh.write("# Physical plans\n\nGenerated by `python tests/show_plans.py` "
                 f"on local[8] over `{SF}`.\n\n")
        for title, note, df in sections:
            fh.write(f"## {title}\n\n{note}\n\n```\n{plan(df).strip()}\n```\n\n")
        fh.write("## Upsert merge of one day (T6)\n\nTarget read only for the touched day; "
                 "the source is broadcast into a left outer join, so the target is not "
                 "shuffled; NULL keys bypass the joins.\n\n```\n"
                 f"{captured['upsert'].strip()}\n```\n")
    print("wrote", OUT)


if __name__ == "__main__":
    main()
