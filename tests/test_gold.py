"""Gold summaries, exact money and plan shape."""

from conftest import SF, D
from pyspark.sql import functions as F

import pytest

from tillbook.functions.money import rounded_sum, unit_sum_sql, wild_sum_sql, with_ratio
from tillbook.operators import gold
from tillbook.schemas import RETURNS, SALES, STOCK
from tillbook.sources import fixtures as fx


def _frame(spark, domain, rows):
    return spark.createDataFrame(rows, domain.schema)


def _ratio(spark, rows):
    df = spark.createDataFrame(rows, "i int, v double, q long").groupBy("i").agg(
        F.expr(f"{unit_sum_sql('v')} AS m"), F.expr(f"{wild_sum_sql('v')} AS w"), F.sum("q").alias("q"))
    return [r.r for r in with_ratio(df, "m", "w", "q", "r", 2).orderBy("i").collect()]


def _sum(spark, values, digits=4):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    return df.agg(rounded_sum("v", digits).alias("s")).first().s


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_half_cent_tie_rounds_up_exactly(spark):
    assert _ratio(spark, [(1, 40136.35, 10), (2, -40136.35, 10), (3, 1.0, 3), (4, 2.0, 3), (5, 5.0, 0),
                          (6, 0.125, 1), (7, 2.0, -3)]) == [4013.64, -4013.64, 0.33, 0.67, None, 0.13, -0.67]


def test_money_sum_is_order_independent(spark):
    assert _sum(spark, [0.1] * 10 + [1e9, -1e9, 123456.78]) == 123457.78


def test_large_groups_neither_wrap_nor_raise(spark, ansi):
    assert _sum(spark, [9e12, 9e12]) == 1.8e13
    assert _sum(spark, [8e15] * 2000 + [0.25]) == 1.6e19
    assert _sum(spark, [-9e12] * 3 + [9e12, -0.5]) == -1.80000000000005e13
    assert _sum(spark, [1e15, 1e17]) == 1.01e17
    df = spark.range(2_000_000).selectExpr("CAST(8500000000 AS DOUBLE) + 0.01 AS v")
    assert df.agg(rounded_sum("v", 2).alias("s")).first().s == 8.5e9 * 2_000_000 + 20000.0


def test_nan_makes_only_its_own_group_nan(spark, ansi):
    import math
    rows = [(1, float("nan")), (1, 2.5), (2, 2.5), (3, None), (4, float("inf")), (4, 1.0),
            (5, float("inf")), (5, float("-inf"))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = [r.s for r in df.groupBy("g").agg(rounded_sum("v", 4).alias("s")).orderBy("g").collect()]
    assert math.isnan(got[0]) and got[1:4] == [2.5, None, math.inf] and math.isnan(got[4])
    ratio = _ratio(spark, [(1, float("nan"), 2), (2, 5.0, 2), (3, float("inf"), 0)])
    assert math.isnan(ratio[0]) and ratio[1:] == [2.5, None]


def test_values_finer_than_a_micro_unit_are_summed_exactly(spark, ansi):
    assert _sum(spark, [0.0000004] * 1000) == 0.0004
    assert _sum(spark, [0.0000005] * 1000) == 0.0005
    assert _sum(spark, [-0.0000004] * 125) == -0.0001        # a tie, away from zero
    assert _sum(spark, [0.1234567] * 1000) == 123.4567
    assert _sum(spark, [0.00000049] * 100 + [1e8]) == 1e8
    assert _sum(spark, [9e12, 0.01], 2) == 9000000000000.01
    assert _sum(spark, [0.00004999999999]) == 0.0            # not rounded twice
    assert str(_sum(spark, [-0.00001])) == "0.0"


def test_rounded_sum_equals_decimal_arithmetic(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal
    rng = random.Random(5)
    for digits in (2, 4):
        values = [rng.choice([-1, 1]) * round(rng.random() * 10 ** rng.randint(-5, 8), rng.randint(0, 6)) for _ in range(400)]
        want = sum(Decimal(repr(v)) for v in values).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
        assert _sum(spark, values, digits) == float(want)


def test_zero_quantity_gives_null_ticket(spark):
    sales = _frame(spark, SALES, [(D("2024-01-01"), 1, "SP01", 0, 10.0)])
    r = gold.sales_summary(sales).first()
    assert r.TotalQuantidadeVendida == 0 and r.TicketMedio is None and r.TotalValorVendido == 10.0


def test_sales_formulas_sum_unit_prices(spark):
    sales = _frame(spark, SALES, [(D("2024-01-01"), 1, "SP01", 3, 10.0),
                                  (D("2024-01-01"), 1, "SP01", 1, 20.005)])
    r = gold.sales_summary(sales).first()
    assert (r.TotalQuantidadeVendida, r.TotalValorVendido, r.TicketMedio) == (4, 30.01, 7.5)


def test_join_gap_drops_key_and_null_keys(spark):
    day = D("2024-01-01")
    ret = _frame(spark, RETURNS, [("r1", 1, 5, "x", day, "SP01"), ("r2", None, 5, "x", day, "SP01")])
    stk = _frame(spark, STOCK, [(1, "SP01", 50, day), (2, "SP01", 10, day), (None, "SP01", 1, day)])
    sal = _frame(spark, SALES, [(day, 1, "SP01", 2, 9.99), (day, 2, "SP01", 1, 5.0),
                                (day, None, "SP01", 1, 1.0)])
    got = [tuple(r) for r in gold.product_summary(ret, stk, sal).collect()]
    assert got == [(day, 1, "SP01", 5, 50, 2, 9.99, 5.0)]   # product 2 has no return
    by_join = [tuple(r) for r in gold.product_summary_by_join(ret, stk, sal).collect()]
    assert by_join == got


def test_tagged_and_join_forms_agree_on_fixture(spark):
    a = gold.product_summary_tagged(fx.product_lines(spark, SF))
    b = gold.product_summary_by_join(fx.returns(spark, SF), fx.stock(spark, SF), fx.sales(spark, SF))
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_freight_sql_equals_dataframe_form(spark):
    f = fx.freight(spark, SF)
    a, b = gold.freight_summary(f), gold.freight_summary_sql(spark, f, "fretes_test")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_product_summary_plan_one_aggregation_no_python(spark):
    plan = _plan(gold.product_summary_tagged(fx.product_lines(spark, SF)))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEval" not in plan
    # one final aggregation: a single shuffle on the keys, no join of aggregates
    assert plan.count("HashAggregate") == 2
    assert plan.count("Exchange hashpartitioning") == 1
    joins = plan.count("SortMergeJoin") + plan.count("HashJoin")
    assert joins == 2                                    # those of the fixture


def test_scan_prunes_columns(spark):
    df = gold.tax_summary(fx.taxes(spark, SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in read.split(",")) == ["event_type", "ts", "user_id", "value"]


def test_preview_is_top_n(spark):
    df = gold.preview(gold.product_summary_tagged(fx.product_lines(spark, SF)),
                      gold.KEYS_PRODUCT, 5)
    assert "TakeOrderedAndProject" in _plan(df)
    rows = df.collect()
    assert len(rows) == 5
    assert [tuple(r)[:3] for r in rows] == sorted(tuple(r)[:3] for r in rows)
