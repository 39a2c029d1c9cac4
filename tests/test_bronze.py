"""Bronze scans (S1, S2) and ingest (P1) on hand-written CSV files."""

import os

import pytest
from conftest import D, write_csv
from pyspark.sql import types as T

from tillbook.operators import storage
from tillbook.plans.pipeline import Lake, ingest
from tillbook.schemas import FREIGHT, SALES, TAXES
from tillbook.sources import bronze


def _path(root, domain, day):
    p = bronze.bronze_path(root, domain, day)
    return p


def test_file_name_from_day(scratch):
    assert _path(scratch, SALES, "2026-04-06").endswith(
        "/bronze/sistema_vendas/vendas/vendas_2026_04_06.csv")


def test_whole_number_prices_stay_double(spark, scratch):
    write_csv(_path(scratch, SALES, "2024-01-01"),
              "data_venda,produto_id,filial_id,quantidade,valor_unitario\n"
              "2024-01-01,1,SP01,3,10\n2024-01-01,2,SP02,1,1500\n")
    df = bronze.read_day(spark, scratch, SALES, "2024-01-01")
    assert df.schema["valor_unitario"].dataType == T.DoubleType()
    assert sorted(r.valor_unitario for r in df.collect()) == [10.0, 1500.0]
    # the reference's inference, for comparison: the column becomes int
    inferred = bronze.read_day(spark, scratch, SALES, "2024-01-01", infer=True)
    assert inferred.schema["valor_unitario"].dataType == T.IntegerType()


def test_header_only_file_gives_empty_typed_frame(spark, scratch):
    write_csv(_path(scratch, TAXES, "2024-01-01"),
              "data_pagamento,tipo_imposto,valor_pago,filial_id\n")
    df = bronze.read_day(spark, scratch, TAXES, "2024-01-01")
    assert df.count() == 0
    assert df.schema == TAXES.schema


def test_missing_file_raises_before_any_write(spark, scratch):
    lake = Lake(scratch)
    with pytest.raises(FileNotFoundError, match="PATH_NOT_FOUND"):
        ingest(spark, lake, TAXES, ["2024-01-05"])
    assert not storage.exists(spark, lake.silver(TAXES))


def test_bad_cell_fails_and_table_is_unchanged(spark, scratch):
    lake = Lake(scratch)
    write_csv(_path(scratch, SALES, "2024-01-01"),
              "data_venda,produto_id,filial_id,quantidade,valor_unitario\n2024-01-01,1,SP01,3,10.5\n")
    ingest(spark, lake, SALES, ["2024-01-01"])
    write_csv(_path(scratch, SALES, "2024-01-01"),
              "data_venda,produto_id,filial_id,quantidade,valor_unitario\n2024-01-01,abc,SP01,3,10.5\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest(spark, lake, SALES, ["2024-01-01"])
    rows = storage.read(spark, lake.silver(SALES)).collect()
    assert [(r.produto_id, r.valor_unitario) for r in rows] == [(1, 10.5)]


def test_swapped_header_lands_in_right_columns(spark, scratch):
    write_csv(_path(scratch, TAXES, "2024-01-01"),
              "data_pagamento,tipo_imposto,valor_pago,filial_id\n2024-01-01,ICMS,10.5,SP01\n")
    write_csv(_path(scratch, TAXES, "2024-01-02"),
              "filial_id,valor_pago,tipo_imposto,data_pagamento\nRJ02,20.25,ISS,2024-01-02\n")
    df = bronze.read_days(spark, scratch, TAXES, ["2024-01-01", "2024-01-02"])
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(D("2024-01-01"), "ICMS", 10.5, "SP01"), (D("2024-01-02"), "ISS", 20.25, "RJ02")]


def test_empty_day_cell_is_rejected(spark, scratch):
    lake = Lake(scratch)
    write_csv(_path(scratch, TAXES, "2024-01-01"),
              "data_pagamento,tipo_imposto,valor_pago,filial_id\n,ICMS,10.5,SP01\n")
    with pytest.raises(Exception, match="NULL in day column"):
        ingest(spark, lake, TAXES, ["2024-01-01"])


def test_rerun_of_a_day_is_identical(spark, scratch):
    lake = Lake(scratch)
    write_csv(_path(scratch, TAXES, "2024-01-01"),
              "data_pagamento,tipo_imposto,valor_pago,filial_id\n2024-01-01,ICMS,10.5,SP01\n"
              "2024-01-01,PIS,1.25,SP02\n")
    ingest(spark, lake, TAXES, ["2024-01-01"])
    first = sorted(tuple(r) for r in storage.read(spark, lake.silver(TAXES)).collect())
    ingest(spark, lake, TAXES, ["2024-01-01"])
    again = sorted(tuple(r) for r in storage.read(spark, lake.silver(TAXES)).collect())
    assert first == again and len(first) == 2


def test_upsert_ingest_and_newest_file_wins(spark, scratch):
    lake = Lake(scratch)
    head = "pedido_id,valor_frete,data_envio,transportadora,filial_id\n"
    write_csv(_path(scratch, FREIGHT, "2024-01-01"), head + "a,10.0,2024-01-01,Loggi,SP01\n"
              "b,11.0,2024-01-01,Loggi,SP01\n")
    write_csv(_path(scratch, FREIGHT, "2024-01-02"), head + "b,99.0,2024-01-02,JadLog,SP01\n")
    # one backfill call over both files: the newer file's row of b wins
    ingest(spark, lake, FREIGHT, ["2024-01-01", "2024-01-02"])
    got = sorted((r.pedido_id, r.valor_frete, str(r.data_envio))
                 for r in storage.read(spark, lake.silver(FREIGHT)).collect())
    assert got == [("a", 10.0, "2024-01-01"), ("b", 99.0, "2024-01-02")]
    # a corrected file without a row keeps the old row
    write_csv(_path(scratch, FREIGHT, "2024-01-01"), head + "a,12.0,2024-01-01,Loggi,SP01\n")
    touched = ingest(spark, lake, FREIGHT, ["2024-01-01"])
    assert touched == ["2024-01-01"]
    got = sorted((r.pedido_id, r.valor_frete) for r in storage.read(spark, lake.silver(FREIGHT)).collect())
    assert got == [("a", 12.0), ("b", 99.0)]


def test_spark_written_folder_reads_like_a_file(spark, scratch):
    from tillbook.sources.fixtures import write_bronze
    df = spark.createDataFrame([(D("2024-01-01"), "ICMS", 1.5, "SP01"),
                                (D("2024-01-02"), "ISS", 2.5, "RJ01")], TAXES.schema)
    days = write_bronze(spark, scratch, TAXES, df)
    assert days == ["2024-01-01", "2024-01-02"]
    assert os.path.isdir(_path(scratch, TAXES, "2024-01-02"))
    back = bronze.read_days(spark, scratch, TAXES, days)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_new_bronze_column_is_kept_and_old_days_read_null(spark, scratch):
    lake = Lake(scratch)
    write_csv(_path(scratch, TAXES, "2024-01-01"),
              "data_pagamento,tipo_imposto,valor_pago,filial_id\n2024-01-01,ICMS,1.5,SP01\n")
    write_csv(_path(scratch, TAXES, "2024-01-02"),
              "data_pagamento,tipo_imposto,valor_pago,filial_id,canal\n2024-01-02,ISS,2.5,SP02,web\n")
    ingest(spark, lake, TAXES, ["2024-01-01"])
    ingest(spark, lake, TAXES, ["2024-01-02"])
    got = sorted((str(r.data_pagamento), r.canal)
                 for r in storage.read(spark, lake.silver(TAXES), evolved=True).collect())
    assert got == [("2024-01-01", None), ("2024-01-02", "web")]
    # the declared view is unchanged
    assert storage.read(spark, lake.silver(TAXES)).columns == TAXES.columns


def test_missing_bronze_column_reads_null(spark, scratch):
    write_csv(_path(scratch, TAXES, "2024-01-01"),
              "data_pagamento,valor_pago,filial_id\n2024-01-01,1.5,SP01\n")
    r = bronze.read_day(spark, scratch, TAXES, "2024-01-01").first()
    assert r.tipo_imposto is None and r.valor_pago == 1.5
