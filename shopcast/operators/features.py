"""Features shared by training and scoring.

Every window is ``partitionBy(store).orderBy(date)`` and row based.  The
fact table holds one row per store and day, so a window partition holds at
most one row per calendar day of history, whatever the skew of the raw
lines.  All lag and rolling columns share one exchange and one sort.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopcast.functions.calendar import calendar_dict
from shopcast.functions.exact import cents_to_units, dec, moment_std

col = F.col

# Lags and rolling widths of the feature set.
LAGS = (1, 3, 7, 14)
WINDOWS = (7, 14)
CATEGORICAL = ("state_holiday", "store_type", "assortment")


def by_store(frame=None):
    w = Window.partitionBy("store").orderBy("date")
    return w.rowsBetween(*frame) if frame else w


def add_calendar(df: DataFrame) -> DataFrame:
    """Year, month, quarter, ISO week, weekday, weekend flag."""
    have = set(df.columns)
    return df.withColumns({n: c for n, c in calendar_dict("date").items() if n not in have})


def add_interactions(df: DataFrame) -> DataFrame:
    """promo x weekend, promo x month."""
    return df.withColumns({
        "promo_weekend": (col("promo") * col("is_weekend")).cast("long"),
        "promo_month": (col("promo") * col("month")).cast("long")})


def calendar_features(df: DataFrame) -> DataFrame:
    """F1-F4 on the fact table (store, date and the calendar columns)."""
    return add_interactions(add_calendar(df)).select(
        "store", "date", "year", "month", "quarter", "week_of_year",
        "day_of_week", "is_weekend", "promo_weekend", "promo_month")


def add_lags(df: DataFrame, lags=LAGS) -> DataFrame:
    """Row-based lags of sales (euros) and customers per store."""
    w = by_store()
    cols = {}
    for k in lags:
        cols[f"sales_lag_{k}"] = cents_to_units(F.lag("sales_cents", k).over(w))
        cols[f"customers_lag_{k}"] = F.lag("customers", k).over(w)
    return df.withColumns(cols)


def rolling_columns(value: str = "sales_cents", windows=WINDOWS,
                    full: bool = False) -> dict[str, Column]:
    """Mean, sample std and max over the previous w rows (current row
    excluded).  Partial frames are allowed unless ``full``; the std is null
    under two rows.  Moments are integer sums, so results do not depend on
    evaluation order."""
    out = {}
    value_col = col(value).cast("long")
    for w in windows:
        frame = by_store((-w, -1))
        v = dec(value_col)
        n = F.count(v).over(frame)
        s1 = F.sum(v).over(frame)
        s2 = F.sum(v * v).over(frame)
        ok = (n == w) if full else (n > 0)
        out[f"sales_roll_mean_{w}"] = F.when(ok, s1.cast("double") / (n * 100).cast("double"))
        out[f"sales_roll_std_{w}"] = F.when(ok, moment_std(n, s1, s2) / 100.0)
        out[f"sales_roll_max_{w}"] = F.when(ok, cents_to_units(F.max(value_col).over(frame)))
    return out


def add_rolling(df: DataFrame, windows=WINDOWS, full: bool = False) -> DataFrame:
    return df.withColumns(rolling_columns("sales_cents", windows, full))


def _category_pairs(df: DataFrame, cols) -> DataFrame:
    """Distinct non-null (column, value) pairs: rows are first reduced to
    the distinct combinations, which are then unpivoted."""
    combos = df.select(*[col(c).cast("string").alias(c) for c in cols]).distinct()
    pairs = combos.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).alias("value"))
        for c in cols])).alias("p")).select("p.column", "p.value")
    return pairs.filter(col("value").isNotNull()).distinct()


def categories(df: DataFrame, cols=CATEGORICAL) -> dict[str, list[str]]:
    """Sorted distinct non-null values (as strings) of each column.

    The distinct pairs are found by a distributed aggregate.  The values
    become column names of the one-hot table, so they are part of the plan
    and known to the driver like any other schema; ``category_table`` keeps
    them as a table."""
    rows = _category_pairs(df, cols).collect()
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        out[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def category_table(df: DataFrame, cols=CATEGORICAL) -> DataFrame:
    """A20 as a table: (column, position, value), values sorted as strings.
    For categorical columns (the numbering window holds one column's
    distinct values)."""
    w = Window.partitionBy("column").orderBy("value")
    return _category_pairs(df, cols).select(
        "column", (F.row_number().over(w) - 1).cast("long").alias("position"), "value")


def one_hot_columns(cats: dict[str, list[str]],
                    drop_first: dict[str, bool] | bool = True) -> list[Column]:
    """0/1 columns named ``<col>_<value>`` (spaces -> ``_``); a null
    category is 0 everywhere.  Built as one list for a single ``select``."""
    out = []
    for c, values in cats.items():
        drop = drop_first.get(c, True) if isinstance(drop_first, dict) else drop_first
        for v in (values[1:] if drop else values):
            name = f"{c}_{str(v).replace(' ', '_')}"
            out.append(F.when(col(c).cast("string") == v, 1).otherwise(0)
                       .cast("long").alias(name))
    return out


def category_rows(sales: DataFrame) -> DataFrame:
    """The fact rows reduced to what categories depend on: a store, its
    statuses and weekdays (at most 14 rows a store), so that the dimension
    is joined to these and not to every day."""
    return sales.select("store", "state_holiday", calendar_dict("date")["day_of_week"].alias("day_of_week")).distinct()


def _slots(table: DataFrame, drop_first: dict[str, bool]) -> dict[str, tuple[int, int]]:
    """(values skipped, values kept) of each column: numbers only."""
    sizes = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    out = {}
    for c, drop in drop_first.items():
        skip = int(drop and sizes.get(c, 0) > 0)
        if sizes.get(c, 0) > skip:
            out[c] = (skip, sizes[c] - skip)
    return out


def one_hot_vector(df: DataFrame, table: DataFrame, drop_first: dict[str, bool] | None = None,
                   output: str = "one_hot") -> DataFrame:
    """F5 as one sparse vector column, for any number of categories.

    ``table`` is the written category table (``category_table``): values are
    turned into positions by a join with it, so no value passes the driver,
    only the number of values of each column.  Kept values take the slots 0,
    1, ... in table order, columns follow each other in the order of
    ``drop_first``.  A dropped first value, a null and a value that the
    table doesn't have are 0 everywhere.
    """
    slots = _slots(table, DROP_FIRST if drop_first is None else drop_first)
    if "day_of_week" in slots and "day_of_week" not in df.columns:
        df = add_calendar(df)
    names = df.columns
    for i, (c, (skip, kept)) in enumerate(slots.items()):
        own = table.filter(col("column") == c).select(col("value").alias(f"_v{i}"), (col("position") - skip).alias(f"_p{i}"))
        # the slot after the kept ones is the one the encoder drops
        at = F.when(col(f"_p{i}") >= 0, col(f"_p{i}")).otherwise(F.lit(kept)).cast("double")
        nominal = {"ml_attr": {"type": "nominal", "num_vals": kept + 1}}
        df = df.join(own, col(c).cast("string") == col(f"_v{i}"), "left").withColumn(
            f"_i{i}", at.alias(f"_i{i}", metadata=nominal)).drop(f"_v{i}", f"_p{i}")
    if not slots:
        return df.withColumn(output, array_to_vector(F.array().cast("array<double>")))
    index, hot = [f"_i{i}" for i in range(len(slots))], [f"_h{i}" for i in range(len(slots))]
    encoder = OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True).fit(df)
    out = VectorAssembler(inputCols=hot, outputCol=output).transform(encoder.transform(df))
    return out.select(*names, output)


def one_hot_names(table: DataFrame, drop_first: dict[str, bool] | None = None) -> list[str]:
    """Names ``<col>_<value>`` of the vector's slots, for wide outputs only."""
    drop_first = DROP_FIRST if drop_first is None else drop_first
    rows = table.orderBy("column", "position").collect()
    return [f"{c}_{r['value'].replace(' ', '_')}" for c, drop in drop_first.items()
            for r in rows if r["column"] == c and not (drop and r["position"] == 0)]


def one_hot(df: DataFrame, cats: dict[str, list[str]],
            drop_first: dict[str, bool] | bool = True, keep=("store", "date")) -> DataFrame:
    """F5 as 0/1 columns, for few categories."""
    if "day_of_week" in cats and "day_of_week" not in df.columns:
        df = add_calendar(df)
    return df.select(*keep, *one_hot_columns(cats, drop_first))


def one_hot_wide(df: DataFrame, table: DataFrame, keep=("store", "date")) -> DataFrame:
    """The vector of ``one_hot_vector`` as named 0/1 columns."""
    names = one_hot_names(table)
    flat = one_hot_vector(df, table, output="_hot").withColumn("_flat", vector_to_array("_hot"))
    return flat.select(*keep, *[col("_flat")[i].cast("long").alias(n) for i, n in enumerate(names)])


def feature_categories(clean: DataFrame) -> dict[str, list[str]]:
    """Categories of the feature set: weekday (all kept) + the categorical
    columns (first dropped)."""
    return categories(add_calendar(clean), ("day_of_week",) + CATEGORICAL)


DROP_FIRST = {"day_of_week": False, "state_holiday": True, "store_type": True,
              "assortment": True}


def build_features(clean: DataFrame, cats: dict[str, list[str]] | None = None) -> DataFrame:
    """The feature table: calendar -> lags over all days -> open days ->
    rolling -> interactions -> one-hot -> drop incomplete rows.

    ``cats`` (from ``feature_categories``) is a small table of category
    values kept with the model, so that scoring builds the same columns.
    """
    cats = feature_categories(clean) if cats is None else cats
    df = add_lags(add_calendar(clean))
    df = df.filter(col("open") == 1)
    df = add_interactions(add_rolling(df))
    df = df.select("*", *one_hot_columns(cats, DROP_FIRST),
                   cents_to_units(col("sales_cents")).alias("sales"))
    return df.na.drop()
