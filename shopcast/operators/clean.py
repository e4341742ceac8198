"""Cleaning, filters and null handling (PF1-PF9, J1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

col = F.col


def parse_dates(df: DataFrame, column: str = "date_text", fmt: str = "M/d/yyyy",
                out: str = "date") -> DataFrame:
    """PF1: text -> DateType with ``try_to_date`` (bad text -> null)."""
    return df.withColumn(out, F.try_to_date(col(column), fmt))


def count_rejects(df: DataFrame, text_col: str = "date_text",
                  date_col: str = "date") -> DataFrame:
    """PF1: rows whose non-null date text did not parse (one row)."""
    bad = col(text_col).isNotNull() & col(date_col).isNull()
    return df.agg(F.count(F.when(bad, 1)).alias("rejected"),
                  F.count("*").alias("rows"))


def null_counts(df: DataFrame) -> DataFrame:
    """PF2: one row, one bigint per column = its number of nulls."""
    return df.select([F.count(F.when(col(c).isNull(), 1)).alias(c)
                      for c in df.columns])


def median_value(df: DataFrame, column: str,
                 relative_error: float = 0.001) -> DataFrame:
    """One-row frame with the approximate median of ``column``.

    ``percentile_approx`` merges bounded sketches (accuracy = 1/error), so
    the aggregate never holds the column in one task; the result is an
    element of the column, not an interpolated midpoint.
    """
    accuracy = max(1, int(round(1.0 / relative_error))) if relative_error > 0 \
        else 1_000_000
    return df.agg(F.percentile_approx(column, 0.5, accuracy).alias("_median"))


def impute_median(df: DataFrame, column: str,
                  relative_error: float = 0.001) -> DataFrame:
    """PF3: fill nulls of ``column`` with its median.

    The median is one scalar (a bounded sketch aggregate), applied as a
    literal: the plan stays a projection of ``df``, so the planner's size
    estimate of the dimension is unchanged and its join strategy is chosen
    as for the raw table."""
    m = median_value(df, column, relative_error).first()["_median"]
    if m is None:
        return df
    return df.withColumn(column, F.coalesce(col(column), F.lit(m).cast(df.schema[column].dataType)))


def fill_defaults(df: DataFrame) -> DataFrame:
    """PF4: remaining nulls -> 0 in numeric columns, "0" in string columns."""
    return df.na.fill(0).na.fill("0")


def clean_stores(stores: DataFrame, relative_error: float = 0.001) -> DataFrame:
    """PF3 then PF4 on the store dimension."""
    return fill_defaults(impute_median(stores, "competition_distance",
                                       relative_error))


def open_days(df: DataFrame, need_customers: bool = False,
              mode: str = "open_and_sales") -> DataFrame:
    """PF5: the open-day filters, kept apart.

    mode: ``sales`` (sales > 0), ``open`` (open = 1) or ``open_and_sales``;
    ``need_customers`` adds customers > 0.
    """
    conds = {"sales": [col("sales_cents") > 0],
             "open": [col("open") == 1],
             "open_and_sales": [col("open") == 1, col("sales_cents") > 0]}[mode]
    if need_customers:
        conds = conds + [col("customers") > 0]
    return df.filter(reduce(lambda a, b: a & b, conds))


def year_range(years, date_col: str = "date") -> Column:
    """Date-range predicate for a list of years (pushes down as ranges)."""
    d = col(date_col)
    parts = [(d >= F.lit(f"{y:04d}-01-01").cast("date")) &
             (d < F.lit(f"{y + 1:04d}-01-01").cast("date")) for y in sorted(years)]
    return reduce(lambda a, b: a | b, parts)


def in_years(df: DataFrame, years=None, until: int | None = None,
             date_col: str = "date") -> DataFrame:
    """PF6: one year, a list of years, or every year up to ``until``.

    Date-range predicates, plus a predicate on a ``year`` column when the
    frame has one (a table written by ``sinks.write_table`` is partitioned
    by year, so the read prunes partitions)."""
    has_year = "year" in df.columns
    if years is not None:
        if isinstance(years, int):
            years = [years]
        if has_year:
            df = df.filter(col("year").isin(list(years)))
        return df.filter(year_range(years, date_col))
    if until is not None:
        if has_year:
            df = df.filter(col("year") <= until)
        return df.filter(col(date_col) < F.lit(f"{until + 1:04d}-01-01").cast("date"))
    return df


def drop_incomplete(df: DataFrame) -> DataFrame:
    """PF7: drop a row if any column is null."""
    return df.na.drop()


def sales_per_customer(df: DataFrame, out: str = "sales_per_customer") -> DataFrame:
    """PF9: euros per customer, 0 when there are no customers."""
    return df.withColumn(out, F.when(col("customers") == 0, F.lit(0.0)).otherwise(
        col("sales_cents").cast("double") / (col("customers") * 100).cast("double")))


def join_stores(sales: DataFrame, stores: DataFrame, how: str = "left") -> DataFrame:
    """Equi join of facts to the store dimension.

    No unconditional broadcast: the number of stores grows with the data, so
    the planner's size estimate (autoBroadcastJoinThreshold) and AQE's run
    time statistics choose between broadcast and sort-merge.
    """
    return sales.join(stores, "store", how)


def clean_join(sales: DataFrame, stores: DataFrame,
               relative_error: float = 0.001) -> DataFrame:
    """The cleaned table: facts left-joined to the imputed, filled stores."""
    return join_stores(sales, clean_stores(stores, relative_error), "left")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Columns of a numeric type (M3 helper)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
