"""Report filters and series (F3-F6, A7-A9) on small gold frames."""

from conftest import D

from tillbook.operators import reports
from tillbook.schemas import PRODUCT_REPORT, TAX_REPORT


def products(spark):
    rows = [(D("2024-01-01"), 1, "SP01", 1, 2, 3, 10.0, 3.33),
            (D("2024-01-01"), 2, "SP01", 1, 2, 4, 20.0, 5.0),
            (D("2024-01-02"), 1, "RJ01", 1, 2, 5, 30.0, 6.0),
            (D("2024-01-03"), 1, "SP01", 1, 2, None, None, None)]
    return spark.createDataFrame(rows, PRODUCT_REPORT.schema)


def taxes(spark):
    rows = [(D("2024-01-01"), "SP01", "ICMS", 1.1), (D("2024-01-01"), "SP01", "ISS", 2.2),
            (D("2024-01-01"), None, "ISS", 5.0), (D("2024-01-02"), "SP01", "PIS", None)]
    return spark.createDataFrame(rows, TAX_REPORT.schema)


def test_empty_branch_list_gives_no_rows_same_schema(spark):
    df = reports.filter_report(products(spark), branches=[])
    assert df.count() == 0 and df.schema == PRODUCT_REPORT.schema


def test_product_none_and_star_are_all(spark):
    p = products(spark)
    assert reports.filter_report(p, product=None).count() == 4
    assert reports.filter_report(p, product="*").count() == 4
    assert reports.filter_report(p, product=2).count() == 1


def test_inclusive_single_day_range(spark):
    df = reports.filter_report(products(spark), lo="2024-01-02", hi="2024-01-02")
    assert [r.FilialId for r in df.collect()] == ["RJ01"]


def test_all_filters_and(spark):
    df = reports.filter_report(products(spark), ["SP01"], "2024-01-01", "2024-01-03", 1)
    assert sorted(str(r.CodigoData) for r in df.collect()) == ["2024-01-01", "2024-01-03"]


def test_daily_totals_like_pandas(spark):
    got = sorted(tuple(r) for r in reports.daily_totals(taxes(spark), "TotalImpostoPago", True)
                 .collect())
    # NULL branch dropped, all-NULL sum is 0, sums are exact (1.1 + 2.2 = 3.3)
    assert got == [(D("2024-01-01"), "SP01", 3.3), (D("2024-01-02"), "SP01", 0.0)]
    q = sorted(tuple(r) for r in reports.daily_totals(products(spark), "TotalQuantidadeVendida",
                                                      False).collect())
    assert q == [(D("2024-01-01"), "SP01", 7), (D("2024-01-02"), "RJ01", 5),
                 (D("2024-01-03"), "SP01", 0)]


def test_distinct_values_sorted(spark):
    assert [r.FilialId for r in reports.distinct_values(products(spark), "FilialId").collect()] \
        == ["RJ01", "SP01"]
    assert [r.FilialId for r in reports.distinct_values(taxes(spark), "FilialId").collect()] \
        == ["SP01"]


def test_date_bounds_and_empty(spark):
    r = reports.date_bounds(products(spark)).first()
    assert (r.first_day, r.last_day) == (D("2024-01-01"), D("2024-01-03"))
    e = reports.date_bounds(reports.filter_report(products(spark), branches=[])).first()
    assert (e.first_day, e.last_day) == (None, None)
