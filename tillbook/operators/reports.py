"""Report queries over a gold table.

The reference pulls a whole gold table into pandas and filters there; here
every step is a Catalyst plan over the day-partitioned table, so the date range
becomes a partition filter and the branch list a pushed Parquet filter, and
only the final small result ever leaves Spark.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.days import as_date
from tillbook.functions.money import rounded_sum

ALL_PRODUCTS = "*"


def branch_filter(branches) -> Column | None:
    """branch in a chosen set; ``None`` = no filter, ``[]`` = nothing."""
    if branches is None:
        return None
    branches = list(branches)
    if not branches:
        return F.lit(False)
    return F.col("FilialId").isin(branches)


def date_filter(lo: str | dt.date | None, hi: str | dt.date | None) -> Column | None:
    """inclusive day range; either end may be open (``None``)."""
    preds = []
    if lo is not None:
        preds.append(F.col("CodigoData") >= F.lit(as_date(lo)))
    if hi is not None:
        preds.append(F.col("CodigoData") <= F.lit(as_date(hi)))
    return reduce(lambda a, b: a & b, preds) if preds else None


def product_filter(product) -> Column | None:
    """one product; ``None`` or ``"*"`` = all products."""
    if product is None or product == ALL_PRODUCTS:
        return None
    return F.col("ProdutoId") == F.lit(product)


def filter_report(df: DataFrame, branches=None, lo=None, hi=None,
                  product=None) -> DataFrame:
    """AND of F3-F5.  An empty branch list gives no rows, same schema.

    ``FALSE`` folds to an empty relation in Catalyst, so an empty selection
    reads no file at all.
    """
    preds = [p for p in (branch_filter(branches), date_filter(lo, hi),
                         product_filter(product)) if p is not None]
    if not preds:
        return df
    return df.filter(reduce(lambda a, b: a & b, preds))


def daily_totals(df: DataFrame, measure: str, money: bool) -> DataFrame:
    """Total of ``measure`` per day and branch.

    Same result as pandas ``groupby([day, branch])[m].sum()``: NULL keys are
    dropped and an all-NULL group sums to 0.  Money is summed exactly at four
    decimals (the gold values' scale) and returned as DOUBLE.
    """
    if money:   # exact: the gold values have four decimals
        total = F.coalesce(rounded_sum(measure, 4, fine=False), F.lit(0.0))
    else:
        total = F.coalesce(F.sum(measure), F.lit(0)).cast("long")
    return (df.filter(F.col("CodigoData").isNotNull() & F.col("FilialId").isNotNull())
            .groupBy("CodigoData", "FilialId").agg(total.alias(measure)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of a dimension, ascending.

    A partial aggregation per task first, so a huge table shuffles only its
    distinct values; the final sort runs on that small set.
    """
    return (df.select(column).filter(F.col(column).isNotNull()).distinct()
            .orderBy(column))


def date_bounds(df: DataFrame) -> DataFrame:
    """First and last day; an empty report gives one row (NULL, NULL)."""
    return df.agg(F.min("CodigoData").alias("first_day"),
                  F.max("CodigoData").alias("last_day"))

