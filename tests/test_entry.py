"""The driver contract: entry(), queries(), oracle_sql() - every query of the
catalog, table-writing ones included, against DuckDB on the sf0.001 tables."""

import pytest
from conftest import SF
from oracle import compare

import __spark_entry__ as E
from tillbook.plans import catalog


def test_entry_runs_on_smoke_tables(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["CodigoData", "ProdutoId", "FilialId", "TotalDevolvido",
                          "TotalEmEstoque", "TotalQuantidadeVendida", "TotalValorVendido",
                          "TicketMedio"]


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF)
    ok, msg = compare(df, SF, E.oracle_sql()[name])
    assert ok, msg


def test_importable_without_the_training_data_package():
    """The other queries stay when that package and the pipeline are not there."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    code = ("import sys; sys.modules['tillbook.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; from tillbook.plans import catalog\n"
            "assert set(e.queries()) == set(catalog.QUERIES)")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
