"""Unit tests on literal frames (FIXTURES part C)."""

import datetime as dt
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcast.functions.exact import round_ratio
from shopcast.operators import clean as C
from shopcast.operators import features as FE
from shopcast.operators import forecast as FC
from shopcast.operators import profile as PR
from shopcast.operators import scoring as SC
from shopcast.operators import select as SE
from shopcast.operators import train as TR
from shopcast.plans import reports as R
from shopcast.plans.ordering import global_row_number, ntile
from shopcast.sources import files
from shopcast.sources.schemas import SALES_SCHEMA

D0 = dt.date(2001, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def sales_frame(spark, rows):
    """rows: (store, day index, open, cents, customers, promo)."""
    data = [(s, day(i), o, c, cu, p, "O", 0) for s, i, o, c, cu, p in rows]
    return spark.createDataFrame(data, SALES_SCHEMA)


# ------------------------------------------------------------------ PF1 / IO1
def test_csv_binds_by_header_name_and_counts_rejects(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sale.csv")
    header = "Date,Store,DayOfWeek,Sales,Customers,Open,Promo,StateHoliday,SchoolHoliday"
    lines = [header,
             "1/2/2001,1,2,100.50,10,1,0,0,0",
             "1/3/2001,1,3,0,0,0,0,0,0",
             "12/31/2000,2,7,99.99,9,1,1,a,1",
             "2001-13-45,2,1,10.00,1,1,0,0,0",
             "2/28/2001,3,3,5.05,1,1,0,0,1",
             "3/1/2001,3,4,7.00,2,1,1,b,0"]
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    df = files.read_sales(spark, path)
    rows = {(r.store, r.date_text): r for r in df.collect()}
    assert rows[(1, "1/2/2001")].date == dt.date(2001, 1, 2)
    assert rows[(1, "1/2/2001")].sales_cents == 10050
    assert rows[(2, "12/31/2000")].date == dt.date(2000, 12, 31)
    rej = C.count_rejects(df).first()
    assert (rej.rejected, rej.rows) == (1, 6)


# ------------------------------------------------------------------ PF2-PF4
STORE_SCHEMA = "store long, store_type string, assortment string, competition_distance double, promo_interval string"


def test_null_counts_median_and_fill(spark):
    st = spark.createDataFrame([(1, "t0", "a0", 100.0, None), (2, "t1", "a1", None, "odd"),
                                (3, "t1", "a0", 300.0, None), (4, "t2", "a2", 200.0, "odd"),
                                (5, "t2", "a1", 400.0, None)], STORE_SCHEMA)
    nc = C.null_counts(st).first().asDict()
    assert nc == {"store": 0, "store_type": 0, "assortment": 0,
                  "competition_distance": 1, "promo_interval": 3}
    # even count (4 values): the lower middle element, not the midpoint
    imp = {r.store: r.competition_distance for r in C.impute_median(st, "competition_distance").collect()}
    assert imp[2] == 200.0
    filled = {r.store: r for r in C.clean_stores(st).collect()}
    assert filled[1].promo_interval == "0" and filled[2].competition_distance == 200.0
    # odd count
    st2 = st.filter("store != 5")
    imp2 = {r.store: r.competition_distance for r in C.impute_median(st2, "competition_distance").collect()}
    assert imp2[2] == 200.0


def test_distance_band_null_is_last(spark):
    from shopcast.functions.bands import distance_band, BAND_LABELS
    df = spark.createDataFrame([(None,), (10.0,), (999.0,), (4999.0,), (5000.0,)], "d double")
    got = [r.b for r in df.select(distance_band(F.col("d")).alias("b")).collect()]
    assert got == [BAND_LABELS[3], BAND_LABELS[0], BAND_LABELS[1], BAND_LABELS[2], BAND_LABELS[3]]


# ------------------------------------------------------------------ exact rounding
def test_round_ratio_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (4, 3), (-4, 3), (7, 0)], "a long, b long")
    got = [r.x for r in df.select(round_ratio(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [3, -3, 1, -1, None]


# ------------------------------------------------------------------ W1 / W2 / W3
def one_store_20_days(spark):
    rows = []
    for i in range(20):
        closed = i in (5, 12)
        rows.append((1, i, 0 if closed else 1, 0 if closed else 1000 + 100 * i,
                     0 if closed else 10 + i, i % 2))
    return sales_frame(spark, rows)


def test_lags_on_all_days_rolling_on_open_days(spark):
    df = one_store_20_days(spark)
    lag = {r.date: r for r in FE.add_lags(df).collect()}
    assert lag[day(0)].sales_lag_1 is None
    assert lag[day(6)].sales_lag_1 == 0.0          # closed day 5 is a lag source
    assert lag[day(14)].sales_lag_14 == 10.0
    assert lag[day(13)].sales_lag_14 is None
    roll = {r.date: r for r in FE.add_rolling(df.filter("open = 1")).collect()}
    assert roll[day(0)].sales_roll_mean_7 is None
    assert roll[day(1)].sales_roll_mean_7 == 10.0 and roll[day(1)].sales_roll_std_7 is None
    # day 6 (open): previous open rows are days 0-4 (day 5 closed): mean of 10..14 euros
    assert roll[day(6)].sales_roll_mean_7 == pytest.approx(12.0)
    assert roll[day(6)].sales_roll_max_7 == 14.0
    full = {r.date: r for r in FE.add_rolling(df, full=True).collect()}
    assert full[day(6)].sales_roll_mean_7 is None
    assert full[day(7)].sales_roll_mean_7 is not None


def test_lag_k_is_shift_k(spark):
    df = one_store_20_days(spark)
    rows = sorted(FE.add_lags(df).collect(), key=lambda r: r.date)
    for k in FE.LAGS:
        for i in range(k, 20):
            assert rows[i][f"sales_lag_{k}"] == rows[i - k].sales_cents / 100


# ------------------------------------------------------------------ W8 / W9 / P3
def test_streaks_mode_tie_and_fallback(spark):
    runs = [5, 2, 5, 2, 3, 2]      # on, off, on, off, on, off
    rows, i, promo = [], 0, 1
    for n in runs:
        for _ in range(n):
            rows.append((1, i, 1, 100, 1, promo))
            i += 1
        promo = 1 - promo
    rows += [(2, j, 1, 100, 1, 0) for j in range(10)]            # never on promo
    tie = [(3, j, 1, 100, 1, p) for j, p in enumerate([1, 1, 0, 1, 1, 1, 0, 0])]
    df = sales_frame(spark, rows + tie)
    st = FC.promo_streaks(df)
    s1 = sorted((r.run_id, r.promo, r.length) for r in st.filter("store = 1").collect())
    assert [x[2] for x in s1] == runs
    cyc = {r.store: (r.days_on, r.days_off) for r in FC.suggest_cycle(st).collect()}
    assert cyc[1] == (5, 2)
    assert cyc[2] == (5, 9)            # no on-run: the default pair
    assert cyc[3] == (2, 1)            # on-runs 2 and 3 tie: shorter wins
    pat = FC.promo_pattern(FC.suggest_cycle(st).filter("store = 1"), "2002-01-01", "2002-01-10")
    assert [r.promo for r in pat.orderBy("date").collect()] == [1, 1, 1, 1, 1, 0, 0, 1, 1, 1]


def test_promo_pattern_rejects_reversed_range(spark):
    cyc = spark.createDataFrame([(1, 5, 9)], "store long, days_on long, days_off long")
    with pytest.raises(ValueError):
        FC.promo_pattern(cyc, "2002-02-01", "2002-01-01")


# ------------------------------------------------------------------ A13
def test_closure_count_is_null_without_closed_days(spark):
    df = sales_frame(spark, [(1, 0, 1, 100, 1, 0), (1, 1, 1, 300, 1, 0),
                             (2, 0, 0, 0, 0, 0), (2, 1, 1, 100, 1, 0)])
    st = spark.createDataFrame([(1, "a", "a0", 1.0, None), (2, "b", "a0", 1.0, None)], STORE_SCHEMA)
    got = {r.store_type: r for r in R.report_closures(df, st).collect()}
    assert got["a"].closed_days is None and got["a"].closure_pct is None
    assert got["a"].avg_open_sales == 2.0
    assert got["b"].closed_days == 1 and got["b"].closure_pct == 50.0


# ------------------------------------------------------------------ A15 / ST1-ST3 / J5
def test_threshold_after_rounding_and_baseline_rules(spark):
    hist = [(1, i, 1, 9000 if i % 2 else 11000, 1, 0) for i in range(8)]
    hist += [(2, i, 1, 5000, 1, 0) for i in range(5)]                    # zero std: dropped
    hist_rows = [(s, dt.date(2000, 1, 1) + dt.timedelta(days=i), o, c, cu, p, "O", 0)
                 for s, i, o, c, cu, p in hist]
    base = SC.store_baseline(spark.createDataFrame(hist_rows, SALES_SCHEMA), until=2000)
    b = {r.store: r for r in base.collect()}
    assert set(b) == {1} and b[1].base_mean_cents == 10000
    new = [(1, dt.date(2001, 1, 2), 1, 10500, 1, 0, "O", 0),
           (3, dt.date(2001, 1, 2), 1, 100, 1, 0, "O", 0)]                  # no baseline
    sc = SC.score(spark.createDataFrame(new, SALES_SCHEMA), base).collect()
    assert [r.store for r in sc] == [1]                                  # store 3 drops out
    zdf = spark.createDataFrame(
        [(1, D0, 1.0, 1.0, 1.0, 3.0, z_) for z_ in (3.0, 3.01, -3.01, 2.99)],
        "store long, date date, sales double, base_mean double, base_std double, "
        "deviation_pct double, z_score double")
    an = SC.anomalies(zdf).collect()
    assert sorted(r.z_score for r in an) == [-3.01, 3.01]
    assert {r.z_score: r.direction for r in an} == {-3.01: "drop", 3.01: "spike"}


def test_rounding_before_threshold_exact(spark):
    """z = 3.004 rounds to 3.00 (no anomaly); 3.005 and -3.005 round away."""
    hist = [(1, dt.date(2000, 1, 1) + dt.timedelta(days=i), 1, c, 1, 0, "O", 0)
            for i, c in enumerate([90000, 110000])]                     # mean 1000.00
    base = SC.store_baseline(spark.createDataFrame(hist, SALES_SCHEMA), until=2000)
    b = base.first()
    m, s = b.base_mean_cents, b.base_std_cents
    assert (m, s) == (100000, 14142)                                    # std 141.42
    x1 = m + int(3.004 * s)              # z = 3.0039.. -> 3.00
    x2 = m + int(3.005 * s) + 1          # z = 3.0050.. -> 3.01
    x3 = m - int(3.005 * s) - 1          # z = -3.0050.. -> -3.01
    new = [(1, dt.date(2001, 1, 1) + dt.timedelta(days=i), 1, x, 1, 0, "O", 0)
           for i, x in enumerate([x1, x2, x3])]
    sc = SC.score(spark.createDataFrame(new, SALES_SCHEMA), base)
    assert sorted(r.z_score for r in sc.collect()) == [-3.01, 3.0, 3.01]
    an = SC.anomalies(sc).collect()
    assert sorted(r.z_score for r in an) == [-3.01, 3.01]


# ------------------------------------------------------------------ A6
def test_histogram_counts_and_top_edge(spark):
    rows = [(1, i, 1, c, 1, 0) for i, c in enumerate([100, 200, 300, 400, 1100])]
    df = sales_frame(spark, rows)
    h = PR.histogram(df, bins=5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 2, 0, 0, 1]        # width 2.00 euros; 11.00 in the last bin
    assert h[0].bin_start == 1.0 and h[-1].bin_end == 11.0
    assert sum(r["count"] for r in h) == 5
    hl = PR.histogram(df, bins=5, log=True).collect()
    assert sum(r["count"] for r in hl) == 5


# ------------------------------------------------------------------ M1 / M2 / M5 / T5
def test_correlation_linear_and_constant(spark):
    df = spark.createDataFrame([(x, 2 * x + 1, 7) for x in range(1, 21)], "x long, y long, k long")
    r = {row.feature: row.r for row in PR.correlation_with(df, "y", ["x", "k"]).collect()}
    assert r == {"x": 1.0, "k": 0.0}


def test_f_test_p_value():
    # F(1, 10) upper 5 % point is 4.9646
    assert SE.f_sf(4.9646, 1, 10) == pytest.approx(0.05, abs=1e-4)
    assert SE.f_sf(0.0, 1, 10) == 1.0


def test_linear_model_recovers_exact_line(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression
    df = spark.createDataFrame([(float(x), 2.0 * x + 1.0) for x in range(50)], "x double, sales double")
    est = LinearRegression(featuresCol="features_scaled", labelCol="sales", maxIter=100)
    m = Pipeline(stages=TR.feature_stages(["x"]) + [est]).fit(df)
    met = TR.evaluate(m, df)
    assert met["rmse"] < 1e-6 and met["r2"] == pytest.approx(1.0)


# ------------------------------------------------------------------ T1 / ordering
def test_split_exact_with_boundary_date(spark):
    rows = [(s, dt.date(2001, 1, 1) + dt.timedelta(days=s // 10 if s < 70 else 7), 1)
            for s in range(100)]
    df = spark.createDataFrame(rows, "store long, date date, open long")
    tr, te = TR.chronological_split(df, 0.8)
    cnt = {r.split: r.n_rows for r in TR.split_counts(df, 0.8).collect()}
    assert cnt == {"train": 80, "test": 20}
    trs, tes = tr.collect(), te.collect()
    assert len(trs) == 80 and len(tes) == 20
    last = max((r.date, r.store) for r in trs)
    first = min((r.date, r.store) for r in tes)
    assert last < first and last[0] == first[0]        # the cut falls inside one date


def test_global_row_number_and_ntile(spark):
    df = spark.range(0, 1003).select(((F.col("id") * 7919) % 1003).alias("k"))
    rn = global_row_number(df, [F.col("k")], "rn", partitions=7)
    got = rn.select((F.col("rn") - F.col("k") - 1).alias("d")).distinct().collect()
    assert [r.d for r in got] == [0]
    nt = ntile(df, [F.col("k")], 4, "q")
    exp = df.withColumn("q", F.ntile(4).over(Window.orderBy("k")))
    assert sorted(nt.collect()) == sorted(exp.collect())


# ------------------------------------------------------------------ P4
def test_future_window_form_equals_row_by_row(spark):
    """Window form of the future features against a plain loop."""
    hist = [(1, i, 1, 1000 + (i * 37) % 500, (i * 3) % 7, i % 2) for i in range(25)]
    df = sales_frame(spark, hist)
    start, end = str(day(25)), str(day(29))
    ff = {r.date: r for r in FC.future_features(df, start, end).collect()}
    sales = [c for _, _, _, c, _, _ in hist]
    cust = [cu for _, _, _, _, cu, _ in hist]
    med = sorted(sales)[12]
    dow_mean = {}
    for i, cu in enumerate(cust):
        dow_mean.setdefault(day(i).isoweekday(), []).append(cu)
    dow_mean = {k: sum(v) / len(v) for k, v in dow_mean.items()}
    seq = [s / 100 for s in sales] + [med / 100] * 5
    cseq = cust + [None] * 5
    for j in range(5):
        i = 25 + j
        r = ff[day(i)]
        for k in FE.LAGS:
            assert r[f"sales_lag_{k}"] == seq[i - k]
            c = cseq[i - k]
            assert r[f"customers_lag_{k}"] == (c if c is not None else dow_mean[day(i).isoweekday()])
        for w in FE.WINDOWS:
            win = seq[i - w:i]
            assert r[f"sales_roll_mean_{w}"] == pytest.approx(sum(win) / len(win))
            assert r[f"sales_roll_max_{w}"] == max(win)


# ------------------------------------------------------------------ S4
def test_union_history_and_future(spark):
    h = sales_frame(spark, [(1, 0, 1, 100, 1, 0)])
    f = spark.createDataFrame([(1, day(1), 1)], "store long, date date, promo int")
    u = h.unionByName(f, allowMissingColumns=True)
    assert u.count() == 2 and u.filter("sales_cents is null").count() == 1


def test_fill_from_history_uses_store_median(spark):
    fut = spark.createDataFrame([(1, None), (2, None), (3, 5.0)], "store long, f double")
    hist = spark.createDataFrame([(1, 1.0), (1, 3.0), (1, 10.0), (3, 7.0)], "store long, f double")
    got = {r.store: r.f for r in FC.fill_from_history(fut, ["f"], hist).collect()}
    assert got == {1: 3.0, 2: 0.0, 3: 5.0}


def test_categories_sorted_and_not_capped(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    assert FE.categories(df, ["c"]) == {"c": ["a", "b"]}
    many = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    assert len(FE.categories(many, ["k"])["k"]) == 5000


@pytest.mark.parametrize("rows,partitions", [(5_000, 8), (20_000, 200), (200_000, 8)])
def test_numbering_with_payload_equals_plain_window(spark, rows, partitions):
    df = spark.range(rows).select(F.xxhash64("id").alias("k"), "id",
                                  F.concat(F.lit("payload-"), F.col("id")).alias("pay"))
    order = [F.col("k"), F.col("id")]
    got = global_row_number(df, order, "rn", partitions=partitions)
    plain = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "id")).cast("long"))
    assert got.select(plain.columns).exceptAll(plain).count() == 0 and got.count() == rows
    tiles = ntile(df, order, 4, "q")
    assert {r["count"] for r in tiles.groupBy("q").count().collect()} == {rows // 4}


def test_rolling_moments_of_very_large_sales(spark):
    import datetime as dt
    rows = [(1, dt.date(2001, 1, 1) + dt.timedelta(days=i), 10 ** 12 + i) for i in range(30)]
    df = FE.add_rolling(spark.createDataFrame(rows, "store long, date date, sales_cents long"))
    last = df.orderBy(F.col("date").desc()).first()
    assert last.sales_roll_mean_7 == pytest.approx((10 ** 12 + 25) / 100)
    assert last.sales_roll_std_7 == pytest.approx(0.0216024689946929)


def test_two_character_status_is_kept(spark, tmp_dir):
    import datetime as dt
    row = (1, 1, 10.0, 0.0, 0.0, "N", "ab", dt.datetime(2001, 1, 1))
    spark.createDataFrame([row], "l_orderkey long, l_suppkey long, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
                          ).write.parquet(f"{tmp_dir}/lineitem.parquet")
    from shopcast.sources.tables import daily_sales
    assert daily_sales(spark, tmp_dir).first().state_holiday == "ab"


def test_csv_folder_with_differing_headers_raises(spark, tmp_dir):
    from shopcast.sources import files
    head = ["Store", "DayOfWeek", "Date", "Sales", "Customers", "Open", "Promo", "StateHoliday", "SchoolHoliday"]
    swap = [{"Sales": "Customers", "Customers": "Sales"}.get(c, c) for c in head]
    for name, cols in (("a", head), ("b", swap)):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(",".join(cols) + "\n1,1,1/2/2001,200,10,1,0,0,0\n")
    with pytest.raises(Exception):
        files.read_sales(spark, tmp_dir).collect()


def test_zero_basket_takes_the_default(spark):
    from shopcast.operators import forecast as FC
    import datetime as dt
    hist = spark.createDataFrame([(1, dt.date(2001, 1, 1), 1, 0, 5, 0)],
                                 "store long, date date, open int, sales_cents long, customers long, promo int")
    pred = spark.createDataFrame([("base", 1, dt.date(2001, 1, 8), 0, 1, 10_000)],
                                 "scenario string, store long, date date, promo int, day_of_week long, pred_cents long")
    assert FC.finish_forecast(pred, hist, "2001-01-05").first().customers == 100 // FC.DEFAULT_BASKET
