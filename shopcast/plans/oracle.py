"""DuckDB oracle texts, one per catalogue key.

They restate each operator in plain SQL over the driver's raw tables, in
the shape of the original report (join first, then group), so they check
our optimised plans independently.  Rounding is the same exact integer
half-up rule as ``functions.exact``: ``hu(num, den)``.
"""

from __future__ import annotations

DAILY_SALES = """
SELECT CAST(l_suppkey AS BIGINT) AS store,
       CAST(l_shipdate AS DATE) AS date,
       MAX(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS open,
       CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS sales_cents,
       COUNT(DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END) AS customers,
       MAX(CASE WHEN l_discount >= 0.06 THEN 1 ELSE 0 END) AS promo,
       MIN(l_linestatus) AS state_holiday,
       MAX(CASE WHEN l_tax >= 0.08 THEN 1 ELSE 0 END) AS school_holiday
FROM lineitem
GROUP BY 1, 2
"""

STORES = """
SELECT s_suppkey AS store,
       CONCAT('t', CAST(n_regionkey AS STRING)) AS store_type,
       CONCAT('a', CAST(s_nationkey % 3 AS STRING)) AS assortment,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS competition_distance,
       CASE WHEN s_nationkey % 2 = 0 THEN NULL ELSE 'odd' END AS promo_interval
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""


def with_base(body: str, *extra: tuple[str, str]) -> str:
    ctes = [("daily_sales", DAILY_SALES), ("stores", STORES), *extra]
    head = ",\n".join(f"{name} AS ({text})" for name, text in ctes)
    return f"WITH {head}\n{body}"


def hu(num: str, den: str) -> str:
    """round(num/den) half away from zero, integers, den > 0."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return (f"(CASE WHEN {n} < 0 THEN -((-2*{n} + {d}) // (2*{d})) "
            f"ELSE ((2*{n} + {d}) // (2*{d})) END)")


def units(x: str, scale: int = 100) -> str:
    return f"(CAST(({x}) AS DOUBLE) / CAST({scale} AS DOUBLE))"


def euro_mean(s: str, n: str) -> str:
    return units(hu(s, n))


def ratio_units(num: str, den: str, digits: int = 2) -> str:
    k = 10 ** digits
    return units(hu(f"({num}) * {k}", den), k)


OPEN = "open = 1 AND sales_cents > 0"

REPORTS = {
    "report_store_type": with_base(f"""
SELECT s.store_type,
       COUNT(DISTINCT sa.store) AS n_stores,
       {euro_mean('SUM(sa.sales_cents)', 'COUNT(*)')} AS avg_sales,
       {units('SUM(sa.sales_cents)')} AS total_sales,
       {ratio_units('SUM(sa.customers)', 'COUNT(*)')} AS avg_customers
FROM daily_sales sa JOIN stores s ON sa.store = s.store
WHERE sa.open = 1 AND sa.sales_cents > 0
GROUP BY s.store_type"""),

    "report_promo_effect": with_base(f"""
SELECT CAST(promo AS BIGINT) AS promo,
       COUNT(*) AS n_days,
       {euro_mean('SUM(sales_cents)', 'COUNT(*)')} AS avg_sales,
       {ratio_units('SUM(customers)', 'COUNT(*)')} AS avg_customers,
       {units(hu('SUM(CAST(' + hu('sales_cents * 1000000', 'customers') + ' AS BIGINT))', 'COUNT(*) * 1000000'))} AS avg_sales_per_customer
FROM daily_sales
WHERE open = 1 AND sales_cents > 0 AND customers > 0
GROUP BY promo"""),

    "report_month": with_base(f"""
SELECT CAST(month(date) AS BIGINT) AS month,
       {euro_mean('SUM(sales_cents)', 'COUNT(*)')} AS avg_sales,
       {units('SUM(sales_cents)')} AS total_sales,
       {ratio_units('SUM(customers)', 'COUNT(*)')} AS avg_customers
FROM daily_sales WHERE {OPEN}
GROUP BY month(date)"""),

    "report_top_stores": with_base(f"""
SELECT store, store_type, avg_sales, total_sales, sales_rank FROM (
  SELECT sa.store, s.store_type,
         {euro_mean('SUM(sa.sales_cents)', 'COUNT(*)')} AS avg_sales,
         {units('SUM(sa.sales_cents)')} AS total_sales,
         CAST(RANK() OVER (PARTITION BY s.store_type
              ORDER BY CAST(SUM(sa.sales_cents) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) DESC) AS BIGINT) AS sales_rank
  FROM daily_sales sa JOIN stores s ON sa.store = s.store
  WHERE sa.open = 1 AND sa.sales_cents > 0
  GROUP BY sa.store, s.store_type) t
WHERE sales_rank <= 3"""),

    "report_growth": with_base(f"""
SELECT year, month, {units('s')} AS total_sales,
       {units('p')} AS prev_total_sales,
       {ratio_units('(s - p) * 100', 'p')} AS growth_pct
FROM (
  SELECT year, month, s, LAG(s) OVER (ORDER BY year, month) AS p FROM (
    SELECT CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
           SUM(sales_cents) AS s
    FROM daily_sales WHERE {OPEN}
    GROUP BY 1, 2) m) g"""),

    "report_below_mean": with_base(f"""
SELECT sa.store, s.store_type,
       {euro_mean('SUM(sa.sales_cents)', 'COUNT(*)')} AS avg_sales,
       {euro_mean('tb.ss', 'tb.sn')} AS system_avg,
       {units(hu('SUM(sa.sales_cents) * tb.sn - tb.ss * COUNT(*)', 'COUNT(*) * tb.sn'))} AS diff
FROM daily_sales sa
JOIN stores s ON sa.store = s.store
JOIN (SELECT SUM(sales_cents) AS ss, COUNT(*) AS sn FROM daily_sales WHERE {OPEN}) tb ON 1 = 1
WHERE sa.open = 1 AND sa.sales_cents > 0
GROUP BY sa.store, s.store_type, tb.ss, tb.sn
HAVING SUM(sa.sales_cents) * tb.sn < tb.ss * COUNT(*)
ORDER BY CAST(SUM(sa.sales_cents) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) ASC, sa.store ASC
LIMIT 20"""),

    "report_weekday": with_base(f"""
SELECT CAST(isodow(date) AS BIGINT) AS day_of_week,
       {euro_mean('SUM(sales_cents)', 'COUNT(*)')} AS avg_sales,
       {ratio_units('SUM(customers)', 'COUNT(*)')} AS avg_customers,
       COUNT(*) AS n_days
FROM daily_sales WHERE {OPEN}
GROUP BY 1"""),

    "report_competition": with_base(f"""
SELECT CASE WHEN s.competition_distance < 500 THEN 'under 500'
            WHEN s.competition_distance < 1000 THEN '500 to 1000'
            WHEN s.competition_distance < 5000 THEN '1000 to 5000'
            ELSE '5000 and over' END AS distance_band,
       COUNT(DISTINCT sa.store) AS n_stores,
       {euro_mean('SUM(sa.sales_cents)', 'COUNT(*)')} AS avg_sales,
       {ratio_units('SUM(sa.customers)', 'COUNT(*)')} AS avg_customers
FROM daily_sales sa JOIN stores s ON sa.store = s.store
WHERE sa.open = 1 AND sa.sales_cents > 0
GROUP BY 1"""),

    "report_cumulative": with_base(f"""
SELECT store, date, {units('sales_cents')} AS sales,
       {units('SUM(sales_cents) OVER (PARTITION BY store ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS cumulative_sales
FROM daily_sales
WHERE store IN (SELECT store FROM daily_sales WHERE {OPEN}
                GROUP BY store ORDER BY SUM(sales_cents) DESC, store LIMIT 5)
  AND open = 1"""),

    "report_quarter": with_base(f"""
SELECT CAST(year(sa.date) AS BIGINT) AS year, CAST(quarter(sa.date) AS BIGINT) AS quarter,
       s.store_type,
       {units('SUM(sa.sales_cents)')} AS total_sales,
       {euro_mean('SUM(sa.sales_cents)', 'COUNT(*)')} AS avg_sales,
       COUNT(DISTINCT sa.store) AS n_stores
FROM daily_sales sa JOIN stores s ON sa.store = s.store
WHERE sa.open = 1 AND sa.sales_cents > 0 AND year(sa.date) IN (2000, 2001)
GROUP BY 1, 2, 3"""),

    "report_quartiles": with_base(f"""
SELECT CAST(quartile AS BIGINT) AS quartile, COUNT(*) AS n_stores,
       {units('MIN(avg_cents)')} AS min_avg_sales,
       {units('MAX(avg_cents)')} AS max_avg_sales,
       {euro_mean('SUM(avg_cents)', 'COUNT(*)')} AS mean_avg_sales
FROM (
  SELECT store, {hu('SUM(sales_cents)', 'COUNT(*)')} AS avg_cents,
         NTILE(4) OVER (ORDER BY CAST(SUM(sales_cents) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) DESC, store ASC) AS quartile
  FROM daily_sales WHERE {OPEN}
  GROUP BY store) q
GROUP BY quartile"""),

    "report_closures": with_base(f"""
SELECT s.store_type, COUNT(*) AS total_days,
       CAST(SUM(CASE WHEN sa.open = 0 THEN 1 END) AS BIGINT) AS closed_days,
       {ratio_units('SUM(CASE WHEN sa.open = 0 THEN 1 END) * 100', 'COUNT(*)')} AS closure_pct,
       {euro_mean('SUM(CASE WHEN sa.open = 1 THEN sa.sales_cents END)', 'COUNT(CASE WHEN sa.open = 1 THEN 1 END)')} AS avg_open_sales
FROM daily_sales sa JOIN stores s ON sa.store = s.store
GROUP BY s.store_type"""),

    "network_kpis": with_base(f"""
SELECT COUNT(DISTINCT store) AS n_stores,
       {euro_mean("SUM(CASE WHEN date BETWEEN DATE '1997-03-01' AND DATE '2000-10-31' THEN sales_cents END)", "NULLIF(COUNT(CASE WHEN date BETWEEN DATE '1997-03-01' AND DATE '2000-10-31' THEN 1 END), 0)")} AS avg_sales,
       {ratio_units("SUM(CASE WHEN date BETWEEN DATE '1997-03-01' AND DATE '2000-10-31' THEN customers END)", "NULLIF(COUNT(CASE WHEN date BETWEEN DATE '1997-03-01' AND DATE '2000-10-31' THEN 1 END), 0)")} AS avg_customers
FROM daily_sales"""),
}




def rnd(x: str, digits: int) -> str:
    """floor-based half-up rounding of a double (same as round_half_up)."""
    k = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(FLOOR(({x}) * {k} + 0.5) / {k})"


def msd(n: str, s1: str, s2: str) -> str:
    """sample std from exact moments (same as functions.exact.moment_std)."""
    return (f"(CASE WHEN {n} >= 2 THEN sqrt(greatest(CAST({n} * {s2} - {s1} * {s1} AS DOUBLE), 0.0)"
            f" / CAST({n} * ({n} - 1) AS DOUBLE)) END)")


CLEAN_STORES = """
SELECT store, store_type, assortment,
       COALESCE(competition_distance,
                (SELECT quantile_disc(competition_distance, 0.5) FROM stores)) AS competition_distance,
       COALESCE(promo_interval, '0') AS promo_interval
FROM stores"""

CLEAN_JOIN = """
SELECT d.*, c.store_type, c.assortment, c.competition_distance, c.promo_interval
FROM daily_sales d LEFT JOIN clean_stores c ON d.store = c.store"""

PROFILE_COLS = ("sales_cents", "customers", "open", "promo", "school_holiday")


def _profile_sql() -> str:
    parts = []
    for c in PROFILE_COLS:
        parts.append(f"""
SELECT '{c}' AS "column", COUNT({c}) AS n,
       {units(hu(f'SUM({c}) * 10000', f'NULLIF(COUNT({c}), 0)'), 10000)} AS mean,
       {rnd(msd(f'COUNT({c})', f'SUM(CAST({c} AS HUGEINT))', f'SUM(CAST({c} AS HUGEINT) * {c})'), 4)} AS std,
       CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max
FROM daily_sales""")
    return with_base(" UNION ALL ".join(parts))


def _hist_sql(log: bool) -> str:
    if not log:
        v = "sales_cents"
        b = "CASE WHEN r.hi > r.lo THEN LEAST((v - r.lo) * 50 // (r.hi - r.lo), 49) ELSE 0 END"
        lo_e = "CAST(lo * 50 + bin * (hi - lo) AS DOUBLE) / CAST(5000 AS DOUBLE)"
        hi_e = "CAST(lo * 50 + (bin + 1) * (hi - lo) AS DOUBLE) / CAST(5000 AS DOUBLE)"
        ctr = "CAST(lo * 100 + (bin * 2 + 1) * (hi - lo) AS DOUBLE) / CAST(10000 AS DOUBLE)"
    else:
        v = "ln(1 + CAST(sales_cents AS DOUBLE) / CAST(100 AS DOUBLE))"
        b = "CASE WHEN r.hi > r.lo THEN LEAST(FLOOR((v - r.lo) * 50 / (r.hi - r.lo)), 49) ELSE 0 END"
        lo_e = rnd("lo + bin * ((hi - lo) / 50)", 6)
        hi_e = rnd("lo + (bin + 1) * ((hi - lo) / 50)", 6)
        ctr = rnd("lo + (bin + 0.5) * ((hi - lo) / 50)", 6)
    return with_base(f"""
SELECT bin, {lo_e} AS bin_start, {hi_e} AS bin_end, {ctr} AS center, count FROM (
  SELECT e.bin, e.lo, e.hi, COALESCE(c.cnt, 0) AS count
  FROM (SELECT CAST(i AS BIGINT) AS bin, lo, hi FROM r, range(50) t(i)) e
  LEFT JOIN (SELECT CAST({b} AS BIGINT) AS cbin, COUNT(*) AS cnt FROM x, r GROUP BY 1) c
         ON e.bin = c.cbin) h""",
        ("x", f"SELECT {v} AS v FROM daily_sales WHERE sales_cents > 0"),
        ("r", "SELECT MIN(v) AS lo, MAX(v) AS hi FROM x"))


CORR_COLS = ("store", "open", "customers", "promo", "school_holiday", "competition_distance")
INTEGRAL = {"store", "open", "customers", "promo", "school_holiday", "sales_cents"}


def _corr_sql(target: str = "sales_cents") -> str:
    def x(c):
        return f"CAST({c} AS HUGEINT)" if c in INTEGRAL else f"CAST({c} AS DOUBLE)"
    aggs = ["COUNT(*) AS n", f"SUM({x(target)}) AS ys", f"SUM({x(target)} * {target}) AS yq"]
    rows = []
    for c in CORR_COLS:
        aggs += [f"SUM({x(c)}) AS {c}_s", f"SUM({x(c)} * {c}) AS {c}_q",
                 f"SUM({x(c)} * {x(target)}) AS {c}_xy"]
        va = f"CAST(n * {c}_q - {c}_s * {c}_s AS DOUBLE)"
        vb = "CAST(n * yq - ys * ys AS DOUBLE)"
        cov = f"CAST(n * {c}_xy - {c}_s * ys AS DOUBLE)"
        r = f"(CASE WHEN {va} > 0 AND {vb} > 0 THEN {cov} / sqrt({va} * {vb}) ELSE 0.0 END)"
        rows.append(f"SELECT '{c}' AS feature, {rnd(r, 4)} AS r, abs({rnd(r, 4)}) AS abs_r FROM m")
    cols = ", ".join(list(CORR_COLS) + [target])
    return with_base(" UNION ALL ".join(rows),
                     ("clean_stores", CLEAN_STORES), ("clean", CLEAN_JOIN),
                     ("data", f"SELECT {cols} FROM clean WHERE " +
                      " AND ".join(f"{c} IS NOT NULL" for c in list(CORR_COLS) + [target])),
                     ("m", f"SELECT {', '.join(aggs)} FROM data"))


W_STORE = "PARTITION BY store ORDER BY date"


def _rolling_sql(full: bool) -> str:
    cols = []
    for w in (7, 14):
        fr = f"OVER ({W_STORE} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        cols += [f"COUNT(sales_cents) {fr} AS n{w}",
                 f"CAST(SUM(sales_cents) {fr} AS BIGINT) AS s{w}",
                 f"CAST(SUM(sales_cents * sales_cents) {fr} AS BIGINT) AS q{w}",
                 f"MAX(sales_cents) {fr} AS m{w}"]
    outs = []
    for w in (7, 14):
        ok = f"n{w} = {w}" if full else f"n{w} > 0"
        outs += [f"CASE WHEN {ok} THEN CAST(s{w} AS DOUBLE) / CAST(n{w} * 100 AS DOUBLE) END AS sales_roll_mean_{w}",
                 f"CASE WHEN {ok} THEN {msd(f'n{w}', f's{w}', f'q{w}')} / CAST(100 AS DOUBLE) END AS sales_roll_std_{w}",
                 f"CASE WHEN {ok} THEN {units(f'm{w}')} END AS sales_roll_max_{w}"]
    where = "" if full else "WHERE open = 1"
    return with_base(f"SELECT store, date, {', '.join(outs)} FROM "
                     f"(SELECT store, date, {', '.join(cols)} FROM daily_sales {where}) t")


def _lags_sql() -> str:
    cols = []
    for k in (1, 3, 7, 14):
        cols += [f"{units(f'LAG(sales_cents, {k}) OVER ({W_STORE})')} AS sales_lag_{k}",
                 f"LAG(customers, {k}) OVER ({W_STORE}) AS customers_lag_{k}"]
    return with_base(f"SELECT store, date, {', '.join(cols)} FROM daily_sales")


CAL = """CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
       CAST(quarter(date) AS BIGINT) AS quarter, CAST(weekofyear(date) AS BIGINT) AS week_of_year,
       CAST(isodow(date) AS BIGINT) AS day_of_week,
       CAST(CASE WHEN isodow(date) IN (6, 7) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend"""

# Category values of the driver tables (line status F/O,
# regions 0-4, nation key modulo 3); the first of each is dropped.
ONE_HOT_SQL = with_base(
    "SELECT store, date, "
    + ", ".join(f"CAST(CASE WHEN isodow(date) = {d} THEN 1 ELSE 0 END AS BIGINT) AS day_of_week_{d}"
                for d in range(1, 8))
    + ", CAST(CASE WHEN state_holiday = 'O' THEN 1 ELSE 0 END AS BIGINT) AS state_holiday_O, "
    + ", ".join(f"CAST(CASE WHEN store_type = 't{t}' THEN 1 ELSE 0 END AS BIGINT) AS store_type_t{t}"
                for t in range(1, 5))
    + ", " + ", ".join(f"CAST(CASE WHEN assortment = 'a{a}' THEN 1 ELSE 0 END AS BIGINT) AS assortment_a{a}"
                       for a in (1, 2))
    + " FROM clean", ("clean_stores", CLEAN_STORES), ("clean", CLEAN_JOIN))

CLEANING = {
    "null_counts_sales": with_base("SELECT " + ", ".join(
        f"COUNT(CASE WHEN {c} IS NULL THEN 1 END) AS {c}" for c in (
            "store", "date", "open", "sales_cents", "customers", "promo", "state_holiday", "school_holiday"))
        + " FROM daily_sales"),
    "null_counts": with_base("""
SELECT COUNT(CASE WHEN store IS NULL THEN 1 END) AS store,
       COUNT(CASE WHEN store_type IS NULL THEN 1 END) AS store_type,
       COUNT(CASE WHEN assortment IS NULL THEN 1 END) AS assortment,
       COUNT(CASE WHEN competition_distance IS NULL THEN 1 END) AS competition_distance,
       COUNT(CASE WHEN promo_interval IS NULL THEN 1 END) AS promo_interval
FROM stores"""),
    "impute_distance": with_base("""
SELECT store, store_type, assortment,
       COALESCE(competition_distance,
                (SELECT quantile_disc(competition_distance, 0.5) FROM stores)) AS competition_distance,
       promo_interval
FROM stores"""),
    "fill_defaults": with_base("SELECT * FROM clean_stores", ("clean_stores", CLEAN_STORES)),
    "clean_join": with_base("SELECT * FROM clean", ("clean_stores", CLEAN_STORES),
                            ("clean", CLEAN_JOIN)),
    "sales_by_day": with_base(f"""
SELECT date, {units('SUM(sales_cents)')} AS total_sales FROM daily_sales
WHERE sales_cents > 0 GROUP BY date"""),
    "promo_sales_by_day": with_base(f"""
SELECT date, {euro_mean('SUM(sales_cents)', 'COUNT(*)')} AS avg_sales FROM daily_sales
WHERE sales_cents > 0 AND promo = 1 GROUP BY date"""),
    "sales_by_weekday": with_base(f"""
SELECT CAST(isodow(date) AS BIGINT) AS day_of_week,
       {euro_mean('SUM(sales_cents)', 'COUNT(*)')} AS avg_sales FROM daily_sales
WHERE sales_cents > 0 GROUP BY 1"""),
    "sales_by_month": with_base(f"""
SELECT CAST(month(date) AS BIGINT) AS month,
       {euro_mean('SUM(sales_cents)', 'COUNT(*)')} AS avg_sales FROM daily_sales
WHERE sales_cents > 0 GROUP BY 1"""),
    "profile": _profile_sql(),
    "histogram_sales": _hist_sql(False),
    "histogram_log_sales": _hist_sql(True),
    "correlation_with_sales": _corr_sql(),
    "calendar_features": with_base(f"""
SELECT store, date, {CAL},
       CAST(promo * CASE WHEN isodow(date) IN (6, 7) THEN 1 ELSE 0 END AS BIGINT) AS promo_weekend,
       CAST(promo * month(date) AS BIGINT) AS promo_month
FROM daily_sales"""),
    "one_hot": ONE_HOT_SQL,
    "lags": _lags_sql(),
    "rolling_open": _rolling_sql(False),
    "rolling_full": _rolling_sql(True),
}




BASELINE = f"""
SELECT store, mc, sc, n AS base_count FROM (
  SELECT store, n, {hu('s1', 'n')} AS mc,
         CAST(FLOOR({msd('n', 's1', 's2')} + 0.5) AS BIGINT) AS sc
  FROM (SELECT store, COUNT(*) AS n, SUM(CAST(sales_cents AS HUGEINT)) AS s1,
               SUM(CAST(sales_cents AS HUGEINT) * sales_cents) AS s2
        FROM daily_sales WHERE open = 1 AND sales_cents > 0 AND year(date) <= 2000
        GROUP BY store) g) b
WHERE sc IS NOT NULL AND sc > 0"""

SCORED = f"""
SELECT d.store, d.date, {units('d.sales_cents')} AS sales, {units('b.mc')} AS base_mean,
       {units('b.sc')} AS base_std,
       {units(hu('(d.sales_cents - b.mc) * 100', 'b.sc'))} AS z_score,
       {units(hu('(d.sales_cents - b.mc) * 1000', 'b.mc'), 10)} AS deviation_pct
FROM daily_sales d JOIN baseline b ON d.store = b.store
WHERE d.open = 1 AND d.sales_cents > 0 AND year(d.date) = 2001"""

ANOMS = """
SELECT store, date, sales, base_mean, base_std, deviation_pct, z_score,
       CASE WHEN z_score < 0 THEN 'drop' ELSE 'spike' END AS direction
FROM scored WHERE abs(z_score) > 3.0"""

_SC = (("baseline", BASELINE), ("scored", SCORED))
SCORING = {
    "store_baseline": with_base(
        f"SELECT store, {units('mc')} AS base_mean, {units('sc')} AS base_std, base_count FROM baseline",
        ("baseline", BASELINE)),
    "scored": with_base("SELECT store, date, sales, base_mean, z_score, deviation_pct FROM scored", *_SC),
    "anomalies": with_base(ANOMS, *_SC),
    "top_anomalies": with_base(
        f"SELECT * FROM ({ANOMS}) a ORDER BY abs(z_score) DESC, store, date LIMIT 15", *_SC),
    "anomaly_summary": with_base(f"""
SELECT COUNT(*) AS n_anomalies, COUNT(CASE WHEN z_score < 0 THEN 1 END) AS n_drop,
       COUNT(CASE WHEN z_score > 0 THEN 1 END) AS n_spike FROM ({ANOMS}) a""", *_SC),
    "stream_scored": with_base(
        "SELECT store, date, sales, base_mean, z_score, deviation_pct FROM scored", *_SC),
}




# ---------------------------------------------------------------- forecast
H_START = "(SELECT MAX(date) + 1 FROM daily_sales)"
DATES = "SELECT last + CAST(i AS INTEGER) AS date FROM (SELECT MAX(date) AS last FROM daily_sales) m, range(1, 31) r(i)"
HIST = f"SELECT * FROM clean WHERE date < {H_START}"
ELIG = "SELECT store FROM hist GROUP BY store HAVING COUNT(*) >= 20"
WS = "PARTITION BY store ORDER BY date"

STREAKS = f"""
SELECT store, CAST(run_id AS BIGINT) AS run_id, MIN(promo) AS promo, MIN(date) AS start_date,
       MAX(date) AS end_date, COUNT(*) AS length
FROM (SELECT store, date, promo,
             SUM(chg) OVER ({WS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_id
      FROM (SELECT store, date, CAST(promo AS BIGINT) AS promo,
                   CASE WHEN LAG(promo) OVER ({WS}) = promo THEN 0 ELSE 1 END AS chg
            FROM hist) c) r
GROUP BY store, run_id"""

CYCLE = """
SELECT store,
       CAST(CASE WHEN on_ IS NOT NULL AND off_ IS NOT NULL THEN on_ ELSE 5 END AS BIGINT) AS days_on,
       CAST(CASE WHEN on_ IS NOT NULL AND off_ IS NOT NULL THEN off_ ELSE 9 END AS BIGINT) AS days_off
FROM (SELECT store, MAX(CASE WHEN promo = 1 THEN length END) AS on_,
             MAX(CASE WHEN promo = 0 THEN length END) AS off_
      FROM (SELECT store, promo, length,
                   ROW_NUMBER() OVER (PARTITION BY store, promo ORDER BY k DESC, length ASC) AS rn
            FROM (SELECT store, promo, length, COUNT(*) AS k FROM streaks GROUP BY ALL) a) b
      WHERE rn = 1 GROUP BY store) p"""

PATTERN = f"""
SELECT c.store, d.date,
       CAST(CASE WHEN date_diff('day', {H_START}, d.date) % (c.days_on + c.days_off) < c.days_on
            THEN 1 ELSE 0 END AS BIGINT) AS promo
FROM cycle c, dates d"""

MED_SALES = f"""
SELECT store, CAST(MAX(CASE WHEN rn = (n + 1) // 2 THEN v END) + MAX(CASE WHEN rn = n // 2 + 1 THEN v END) AS BIGINT) AS h_med
FROM (SELECT store, sales_cents AS v, ROW_NUMBER() OVER (PARTITION BY store ORDER BY sales_cents) AS rn,
             COUNT(*) OVER (PARTITION BY store) AS n FROM h2 WHERE sales_cents IS NOT NULL) t
GROUP BY store"""

SPC = """
SELECT store, (MAX(CASE WHEN rn = (n + 1) // 2 THEN v END) + MAX(CASE WHEN rn = n // 2 + 1 THEN v END)) / CAST(2 AS DOUBLE) AS spc_median
FROM (SELECT store, v, ROW_NUMBER() OVER (PARTITION BY store ORDER BY v) AS rn,
             COUNT(*) OVER (PARTITION BY store) AS n
      FROM (SELECT store, CASE WHEN customers = 0 THEN CAST(0 AS DOUBLE)
                  ELSE CAST(sales_cents AS DOUBLE) / CAST(customers * 100 AS DOUBLE) END AS v FROM h2) x WHERE v IS NOT NULL) t
GROUP BY store"""

CDOW = """
SELECT store, CAST(isodow(date) AS BIGINT) AS day_of_week,
       CAST(SUM(customers) AS DOUBLE) / CAST(COUNT(customers) AS DOUBLE) AS avg_customers
FROM h2 GROUP BY 1, 2"""

BASKET = """
SELECT store, CAST(isodow(date) AS BIGINT) AS day_of_week, CAST(promo AS BIGINT) AS promo,
       CAST(SUM(sales_cents) AS DOUBLE) / CAST(SUM(customers) * 100 AS DOUBLE) AS basket
FROM h2 WHERE customers > 0 GROUP BY 1, 2, 3"""


def _future_features_sql(planted: bool = False) -> str:
    lags = []
    for k in (1, 3, 7, 14):
        lags += [f"LAG(h, {k}) OVER ({WS}) AS hl{k}", f"LAG(customers, {k}) OVER ({WS}) AS cl{k}"]
    rolls = []
    for w in (7, 14):
        fr = f"OVER ({WS} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        rolls += [f"COUNT(h) {fr} AS n{w}", f"CAST(SUM(h) {fr} AS BIGINT) AS s{w}",
                  f"CAST(SUM(h * h) {fr} AS BIGINT) AS q{w}", f"MAX(h) {fr} AS m{w}"]
    out = []
    for k in (1, 3, 7, 14):
        out += [f"CAST(hl{k} AS DOUBLE) / CAST(200 AS DOUBLE) AS sales_lag_{k}",
                f"COALESCE(CAST(cl{k} AS DOUBLE), cd.avg_customers, CAST(0 AS DOUBLE)) AS customers_lag_{k}"]
    for w in (7, 14):
        out += [f"CASE WHEN n{w} > 0 THEN CAST(s{w} AS DOUBLE) / CAST(n{w} * 200 AS DOUBLE) END AS sales_roll_mean_{w}",
                f"CASE WHEN n{w} > 1 THEN {msd(f'n{w}', f's{w}', f'q{w}')} / CAST(200 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS sales_roll_std_{w}",
                f"CASE WHEN n{w} > 0 THEN CAST(m{w} AS DOUBLE) / CAST(200 AS DOUBLE) END AS sales_roll_max_{w}"]
    names = [c.split(' AS ')[-1] for c in out] + ["sales_per_customer"]
    mids = ", ".join(f"(quantile_disc({c}, 0.5) - quantile_disc(-{c}, 0.5)) / CAST(2 AS DOUBLE) AS {c}" for c in names)
    body = f"""
SELECT f.store, f.date, {', '.join(f'COALESCE(f.{c}, g.{c}, CAST(0 AS DOUBLE)) AS {c}' for c in names)}
FROM feats f LEFT JOIN (SELECT store, {mids} FROM feats WHERE is_future = 0 GROUP BY store) g ON g.store = f.store
WHERE f.is_future = 1"""
    feats = f"""
SELECT store, date, is_future, {', '.join(names[:-1])},
       COALESCE(CASE WHEN customers_lag_1 <> 0 THEN sales_lag_1 / customers_lag_1 END, spc_median) AS sales_per_customer
FROM (SELECT w.store, w.date, w.is_future, {', '.join(out)}, sp.spc_median
      FROM (SELECT l.*, {', '.join('r.' + c.split(' AS ')[-1] for c in rolls)}
            FROM (SELECT store, date, is_future, {', '.join(lags)} FROM u) l
            JOIN (SELECT store, date, {', '.join(rolls)} FROM u WHERE open = 1) r
                 ON r.store = l.store AND r.date = l.date) w
      LEFT JOIN cdow cd ON cd.store = w.store AND cd.day_of_week = isodow(w.date)
      LEFT JOIN spc sp ON sp.store = w.store) f"""
    u = f"""
SELECT store, date, 2 * sales_cents AS h, customers, open, 0 AS is_future FROM h2
UNION ALL
SELECT e.store, d.date, m.h_med AS h, CAST(NULL AS BIGINT) AS customers, 1 AS open, 1 AS is_future
FROM elig e CROSS JOIN dates d JOIN med m ON m.store = e.store"""
    base = PLANTED_BASE if planted else FC_BASE
    return with_base(body, *base, ("med", MED_SALES), ("u", u), ("cdow", CDOW), ("spc", SPC), ("feats", feats))


FC_BASE = (("clean_stores", CLEAN_STORES), ("clean", CLEAN_JOIN), ("hist", HIST),
           ("elig", ELIG), ("h2", "SELECT h.* FROM hist h JOIN elig USING (store)"),
           ("dates", DATES))
# the key with planted nulls: no figures on a third of the last ten days
PLANTED_BASE = tuple((n, t if n != "h2" else """
SELECT h.* REPLACE (CASE WHEN gap THEN NULL ELSE sales_cents END AS sales_cents,
                    CASE WHEN gap THEN NULL ELSE customers END AS customers)
FROM (SELECT h.*, h.date > (SELECT MAX(date) FROM daily_sales) - 10 AND (h.store + day(h.date)) % 3 = 0 AS gap
      FROM hist h JOIN elig USING (store)) h""") for n, t in FC_BASE)
CYC = (("streaks", STREAKS), ("cycle", CYCLE))

FUTURE_ROWS = f"""
SELECT e.store, p.date, p.promo,
       CAST(year(p.date) AS BIGINT) AS year, CAST(month(p.date) AS BIGINT) AS month,
       CAST(quarter(p.date) AS BIGINT) AS quarter, CAST(weekofyear(p.date) AS BIGINT) AS week_of_year,
       CAST(isodow(p.date) AS BIGINT) AS day_of_week,
       CAST(CASE WHEN isodow(p.date) IN (6, 7) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
       CAST(p.promo * CASE WHEN isodow(p.date) IN (6, 7) THEN 1 ELSE 0 END AS BIGINT) AS promo_weekend,
       CAST(p.promo * month(p.date) AS BIGINT) AS promo_month,
       '0' AS state_holiday, CAST(0 AS BIGINT) AS school_holiday,
       l.store_type, l.assortment, l.competition_distance, l.promo_interval
FROM elig e JOIN pattern p ON p.store = e.store
LEFT JOIN (SELECT store, arg_max(store_type, date) AS store_type, arg_max(assortment, date) AS assortment,
                  arg_max(competition_distance, date) AS competition_distance,
                  arg_max(promo_interval, date) AS promo_interval
           FROM hist GROUP BY store) l ON l.store = e.store"""

PROMOS = f"""
SELECT 'base' AS scenario, e.store, d.date, CAST(0 AS BIGINT) AS promo FROM elig e CROSS JOIN dates d
UNION ALL
SELECT 'promo' AS scenario, p.store, p.date, p.promo FROM pattern p JOIN elig e ON e.store = p.store"""

FORECAST = f"""
SELECT p.scenario, p.store, p.date, p.promo,
       CAST(GREATEST(pc, 0) AS BIGINT) AS sales_cents,
       CAST(GREATEST(pc, 0) AS DOUBLE) / CAST(100 AS DOUBLE) AS sales,
       CAST(CASE WHEN pc > 0 THEN FLOOR((CAST(pc AS DOUBLE) / CAST(100 AS DOUBLE))
                 / COALESCE(b.basket, CAST(10 AS DOUBLE))) ELSE 0 END AS BIGINT) AS customers
FROM (SELECT p.*, CAST(COALESCE(w.pc, o.sc, 0) AS BIGINT) AS pc, CAST(isodow(p.date) AS BIGINT) AS dow
      FROM promos p
      LEFT JOIN (SELECT store, CAST(isodow(date) AS BIGINT) AS dow, CAST(promo AS BIGINT) AS promo,
                        {hu('SUM(sales_cents)', 'COUNT(*)')} AS pc
                 FROM hist WHERE open = 1 AND sales_cents > 0 GROUP BY 1, 2, 3) w
             ON w.store = p.store AND w.dow = isodow(p.date) AND w.promo = p.promo
      LEFT JOIN (SELECT store, {hu('SUM(sales_cents)', 'COUNT(*)')} AS sc
                 FROM hist WHERE open = 1 AND sales_cents > 0 GROUP BY store) o ON o.store = p.store) p
LEFT JOIN basket b ON b.store = p.store AND b.day_of_week = p.dow AND b.promo = p.promo"""

FC = FC_BASE + CYC + (("pattern", PATTERN), ("promos", PROMOS),
                      ("basket", BASKET.replace("FROM h2", "FROM hist")), ("fc", FORECAST))

FORECASTING = {
    "promo_streaks": with_base("SELECT * FROM streaks", *FC_BASE, ("streaks", STREAKS)),
    "suggest_cycle": with_base("SELECT * FROM cycle", *FC_BASE, *CYC),
    "promo_pattern": with_base("SELECT * FROM pattern", *FC_BASE, *CYC, ("pattern", PATTERN)),
    "customers_by_weekday": with_base(CDOW.replace("FROM h2", "FROM hist"), *FC_BASE),
    "basket": with_base(BASKET.replace("FROM h2", "FROM hist"), *FC_BASE),
    "future_rows": with_base(FUTURE_ROWS, *FC_BASE, *CYC, ("pattern", PATTERN)),
    "future_features": _future_features_sql(),
    "future_features_gaps": _future_features_sql(planted=True),
    "forecast": with_base("SELECT scenario, store, date, promo, sales, customers FROM fc", *FC),
    "uplift": with_base(f"""
SELECT store, CAST(b AS DOUBLE) / CAST(100 AS DOUBLE) AS total_base,
       CAST(p AS DOUBLE) / CAST(100 AS DOUBLE) AS total_promo,
       CAST(p - b AS DOUBLE) / CAST(100 AS DOUBLE) AS uplift,
       CASE WHEN b > 0 THEN {units(hu('(p - b) * 10000', 'b'))} ELSE CAST(0 AS DOUBLE) END AS uplift_pct
FROM (SELECT store, SUM(CASE WHEN scenario = 'base' THEN sales_cents END) AS b,
             SUM(CASE WHEN scenario = 'promo' THEN sales_cents END) AS p FROM fc GROUP BY store) g""", *FC),
    "extra_staff": with_base("""
SELECT store, CAST(CASE WHEN n > 0 THEN (t + n - 1) // n ELSE 0 END AS BIGINT) AS extra_staff
FROM (SELECT p.store, COUNT(CASE WHEN p.promo = 1 THEN 1 END) AS n,
             SUM(CASE WHEN p.promo = 1 THEN
                 CAST(GREATEST(CEIL(((CAST(p.sales_cents - b.sales_cents AS DOUBLE) / CAST(100 AS DOUBLE)) / s.avg_basket)
                                    / CAST(100 AS DOUBLE)), 0) AS BIGINT) END) AS t
      FROM fc p JOIN fc b ON b.store = p.store AND b.date = p.date AND b.scenario = 'base'
      JOIN (SELECT store, CAST(SUM(sales_cents) AS DOUBLE) / CAST(NULLIF(SUM(customers), 0) * 100 AS DOUBLE) AS avg_basket
            FROM fc WHERE scenario = 'base' GROUP BY store) s ON s.store = p.store
      WHERE p.scenario = 'promo' GROUP BY p.store) g""", *FC),
    "forecast_kpis": with_base(f"""
SELECT g.store, g.scenario, CAST(g.s AS DOUBLE) / CAST(100 AS DOUBLE) AS total_sales,
       {units(hu('g.s', 'g.n'))} AS avg_sales, CAST(g.c AS BIGINT) AS total_customers,
       CASE WHEN g.scenario = 'promo' AND b.s > 0 THEN CAST(g.s - b.s AS DOUBLE) / CAST(100 AS DOUBLE) END AS lift,
       CASE WHEN g.scenario = 'promo' AND b.s > 0 THEN {units(hu('(g.s - b.s) * 10000', 'b.s'))} END AS lift_pct
FROM (SELECT store, scenario, COUNT(*) AS n, SUM(sales_cents) AS s, SUM(customers) AS c FROM fc GROUP BY 1, 2) g
LEFT JOIN (SELECT store, SUM(sales_cents) AS s FROM fc WHERE scenario = 'base' GROUP BY store) b
       ON b.store = g.store""", *FC),
    "split_counts": with_base("""
SELECT split, COUNT(*) AS n_rows, MIN(date) AS first_date, MAX(date) AS last_date
FROM (SELECT date, CASE WHEN rn <= FLOOR(n * 0.8) THEN 'train' ELSE 'test' END AS split
      FROM (SELECT date, ROW_NUMBER() OVER (ORDER BY date, store) AS rn, COUNT(*) OVER () AS n
            FROM (SELECT store, date, open, rn_all,
                         COUNT(sales_cents) OVER (PARTITION BY store ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS prev7
                  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY store ORDER BY date) AS rn_all FROM clean) a
                  WHERE open = 1) b
            WHERE rn_all >= 15 AND prev7 >= 2) c) d
GROUP BY split""", ("clean_stores", CLEAN_STORES), ("clean", CLEAN_JOIN)),
}


def _corr_matrix_sql() -> str:
    cols = list(CORR_COLS) + ["sales_cents"]

    def x(c):
        return f"CAST({c} AS HUGEINT)" if c in INTEGRAL else f"CAST({c} AS DOUBLE)"
    aggs = ["COUNT(*) AS n"]
    for c in cols:
        aggs += [f"SUM({x(c)}) AS {c}_s", f"SUM({x(c)} * {c}) AS {c}_q"]
    rows = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            aggs.append(f"SUM({x(a)} * {x(b)}) AS {a}__{b}")
            va = f"CAST(n * {a}_q - {a}_s * {a}_s AS DOUBLE)"
            vb = f"CAST(n * {b}_q - {b}_s * {b}_s AS DOUBLE)"
            cov = f"CAST(n * {a}__{b} - {a}_s * {b}_s AS DOUBLE)"
            r = f"(CASE WHEN {va} > 0 AND {vb} > 0 THEN {cov} / sqrt({va} * {vb}) ELSE 0.0 END)"
            rows.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {rnd(r, 4)} AS r FROM m")
    return with_base(" UNION ALL ".join(rows),
                     ("clean_stores", CLEAN_STORES), ("clean", CLEAN_JOIN),
                     ("data", f"SELECT {', '.join(cols)} FROM clean WHERE " +
                      " AND ".join(f"{c} IS NOT NULL" for c in cols)),
                     ("m", f"SELECT {', '.join(aggs)} FROM data"))


EXTRA = {
    "stream_anomalies": with_base(ANOMS, *_SC),
    "correlation_matrix": _corr_matrix_sql(),
    "categories": with_base("""
SELECT "column", CAST(ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY value) - 1 AS BIGINT) AS position, value
FROM (SELECT DISTINCT 'day_of_week' AS "column", CAST(isodow(date) AS VARCHAR) AS value FROM clean
      UNION SELECT DISTINCT 'state_holiday', state_holiday FROM clean WHERE state_holiday IS NOT NULL
      UNION SELECT DISTINCT 'store_type', store_type FROM clean WHERE store_type IS NOT NULL
      UNION SELECT DISTINCT 'assortment', assortment FROM clean WHERE assortment IS NOT NULL) d""",
                            ("clean_stores", CLEAN_STORES), ("clean", CLEAN_JOIN)),
    "eligible_stores": with_base("SELECT * FROM elig", *FC_BASE),
    "forecast_detail": with_base("""
SELECT scenario, strftime(date, '%Y-%m-%d') AS date, store, promo,
       CAST(sales_cents AS DOUBLE) / CAST(100 AS DOUBLE) AS sales, customers FROM fc""", *FC),
}


def _f_report_sql(moments: str, f: str) -> str:
    """The report from (feature, n, r): F, and its tail as twice that of
    Student's t: the density integrated by Simpson's rule from 0 to
    sqrt(F), 2,000 steps.  The constant goes by lgamma."""
    return f"""
SELECT feature, ROUND(abs(r), 4) AS abs_corr, ROUND(f, 2) AS f_stat, p AS p_value, p_exact < 0.05 AND abs(r) > 0 AS selected
FROM (SELECT *, ROUND(p_exact, 6) AS p FROM (
  SELECT feature, any_value(r) AS r, any_value(f) AS f,
         greatest(0.0, 1.0 - 2.0 * any_value(c) * any_value(h) / 3.0
           * SUM(CASE WHEN i IN (0, 2000) THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END
                 * exp(-(v + 1.0) / 2.0 * ln(1.0 + pow(i * h, 2) / v)))) AS p_exact
  FROM (SELECT *, CAST(n - 2 AS DOUBLE) AS v, least(sqrt(f), 60.0) / 2000.0 AS h,
               exp(lgamma((n - 1) / 2.0) - lgamma((n - 2) / 2.0)) / sqrt((n - 2) * pi()) AS c
        FROM (SELECT *, {f} AS f FROM ({moments}) a) b) t, range(2001) g(i)
  GROUP BY feature) x) y"""


def _f_tests_sql() -> str:
    corr = _corr_sql()
    ctes, rows = corr[:corr.index("SELECT 'store' AS feature")], []
    for c in CORR_COLS:
        va, vb = f"CAST(n * {c}_q - {c}_s * {c}_s AS DOUBLE)", "CAST(n * yq - ys * ys AS DOUBLE)"
        cov = f"CAST(n * {c}_xy - {c}_s * ys AS DOUBLE)"
        rows.append(f"SELECT '{c}' AS feature, n, CASE WHEN {va} > 0 AND {vb} > 0 "
                    f"THEN {cov} / sqrt({va} * {vb}) ELSE 0.0 END AS r FROM m")
    return ctes + _f_report_sql(" UNION ALL ".join(rows), "(n - 2) * r * r / (CAST(1 AS DOUBLE) - r * r + 1e-12)")


# one-hot columns of the driver tables' categories, the first of each dropped
HOT_TYPES = {f"store_type_t{t}": f"store_type = 't{t}'" for t in range(1, 5)}
HOT_TYPES |= {f"assortment_a{a}": f"assortment = 'a{a}'" for a in (1, 2)}
HOT_DAYS = {f"day_of_week_{k}": f"isodow(date) = {k}" for k in range(1, 8)} | {"state_holiday_O": "state_holiday = 'O'"}


def _flags(tests: dict[str, str]) -> str:
    return ", ".join(f"CAST(CASE WHEN {t} THEN 1 ELSE 0 END AS BIGINT) AS {n}" for n, t in tests.items())


def _feature_report_sql() -> str:
    """The whole feature table in SQL, then one corr() for each column."""
    lags, rolls = [], []
    for k in (1, 3, 7, 14):
        lags += [f"{units(f'LAG(sales_cents, {k}) OVER ({W_STORE})')} AS sales_lag_{k}",
                 f"LAG(customers, {k}) OVER ({W_STORE}) AS customers_lag_{k}"]
    for w in (7, 14):
        fr = f"OVER ({W_STORE} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        rolls += [f"AVG(sales_cents / CAST(100 AS DOUBLE)) {fr} AS sales_roll_mean_{w}",
                  f"STDDEV_SAMP(sales_cents / CAST(100 AS DOUBLE)) {fr} AS sales_roll_std_{w}",
                  f"{units(f'MAX(sales_cents) {fr}')} AS sales_roll_max_{w}"]
    names = ["open", "promo", "school_holiday", "competition_distance", "year", "month", "week_of_year", "is_weekend",
             *(c.split(" AS ")[-1] for c in lags + rolls), "promo_weekend", "promo_month", *HOT_DAYS, *HOT_TYPES]
    feats = f"""
SELECT *, {CAL.replace("CAST(quarter(date) AS BIGINT) AS quarter, ", "").replace(
        "CAST(isodow(date) AS BIGINT) AS day_of_week,", "")},
       promo * CASE WHEN isodow(date) IN (6, 7) THEN 1 ELSE 0 END AS promo_weekend, promo * month(date) AS promo_month,
       {_flags(HOT_DAYS)}, {_flags(HOT_TYPES)}, {units('sales_cents')} AS y
FROM (SELECT *, {', '.join(rolls)} FROM (SELECT *, {', '.join(lags)} FROM clean) a WHERE open = 1) b
WHERE customers_lag_14 IS NOT NULL AND sales_roll_std_7 IS NOT NULL"""
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COUNT(*) AS n, CASE WHEN stddev_pop({c}) > 0 THEN corr(CAST({c} AS DOUBLE), y) "
        f"ELSE 0.0 END AS r FROM feats" for c in names)
    return with_base(_f_report_sql(rows, "(n - 2) * r * r / (CAST(1 AS DOUBLE) - r * r + 1e-12)"),
                     ("clean_stores", CLEAN_STORES), ("clean", CLEAN_JOIN), ("feats", feats))


# ---------------------------------------------------------------- ridge
KNOWN = ["promo", "is_weekend", "month", "school_holiday", *HOT_TYPES]
LINEAR_ROWS = f"""
SELECT store, date, promo, CASE WHEN isodow(date) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend, month(date) AS month,
       school_holiday, {_flags(HOT_TYPES)}, {units('sales_cents')} AS y,
       ROW_NUMBER() OVER (ORDER BY date, store) <= FLOOR(COUNT(*) OVER () * 0.8) AS train
FROM clean WHERE {OPEN}"""


def _ridge(name: str, feats: list[str]) -> tuple[tuple[str, str], ...]:
    """Ridge in closed form: with R the correlations of the features and r
    those with the label, (R + l I) b = r, l = 0.01 / sd(label), solved by
    Gauss-Jordan elimination (the matrix is positive definite)."""
    k = len(feats)
    sd = [f"stddev_pop({x}) AS s{i}, AVG({x}) AS a{i}" for i, x in enumerate(feats)]
    cov = [f"covar_pop({x}, {z}) AS c{i}_{j}" for i, x in enumerate(feats) for j, z in enumerate(feats) if j > i]
    xy = [f"covar_pop({x}, y) AS y{i}" for i, x in enumerate(feats)]

    def cell(i: int, j: int) -> str:
        if i == j:
            return "1.0 + 0.01 / sy"
        return f"c{min(i, j)}_{max(i, j)} / (s{i} * s{j})"
    rows = ", ".join("[" + ", ".join([cell(i, j) for j in range(k)] + [f"y{i} / (s{i} * sy)"]) + "]" for i in range(k))
    moments = f"SELECT COUNT(*) AS n, AVG(y) AS ay, stddev_pop(y) AS sy, {', '.join(sd + cov + xy)} FROM lin WHERE train"
    steps = f"""
SELECT 0 AS p, [{rows}] AS m FROM {name}_m
UNION ALL
SELECT p + 1, list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {k + 2}), lambda j:
  CASE WHEN i = p + 1 THEN m[i][j] / m[p + 1][p + 1] ELSE m[i][j] - m[i][p + 1] * m[p + 1][j] / m[p + 1][p + 1] END))
FROM {name}_s WHERE p < {k}"""
    solved = f"SELECT {', '.join(f'm[{i + 1}][{k + 1}] AS b{i}' for i in range(k))} FROM {name}_s WHERE p = {k}"
    slopes = ", ".join(f"b{i} * sy / s{i} AS w{i}" for i in range(k))
    coefs = ", ".join(f"b{i} * sy * sqrt(CAST(n AS DOUBLE) / (n - 1)) AS k{i}" for i in range(k))
    icept = " - ".join(["ay", *(f"b{i} * sy / s{i} * a{i}" for i in range(k))])
    model = f"SELECT {slopes}, {coefs}, {icept} AS w FROM {name}_m, {name}_b"
    return ((f"{name}_m", moments), (f"{name}_s(p, m)", steps), (f"{name}_b", solved), (name, model))


def _predicted(feats: list[str]) -> str:
    return " + ".join(["w", *(f"w{i} * {x}" for i, x in enumerate(feats))])


def _linear_sql(body: str, *extra: tuple[str, str]) -> str:
    text = with_base(body, *_CLEAN, ("lin", LINEAR_ROWS), *_ridge("known", KNOWN), *_ridge("promo_only", KNOWN[:1]), *extra)
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


def _linear_keys() -> dict[str, str]:
    def scores(name, model, feats):
        return f"""
SELECT '{name}' AS model, ROUND(sqrt(SUM(e * e) / COUNT(*)), 4) AS rmse, ROUND(SUM(abs(e)) / COUNT(*), 4) AS mae,
       ROUND(1.0 - SUM(e * e) / (var_pop(y) * COUNT(*)), 4) AS r2
FROM (SELECT y, y - ({_predicted(feats)}) AS e FROM lin, {model} WHERE NOT train) x"""
    def rmse(model, feats):
        return f"(SELECT sqrt(AVG(pow(y - ({_predicted(feats)}), 2))) FROM lin, {model} WHERE NOT train)"
    best = ("best", f"SELECT CASE WHEN {rmse('known', KNOWN)} <= {rmse('promo_only', KNOWN[:1])} "
                    "THEN 'known' ELSE 'promo' END AS model")
    coefs = " UNION ALL ".join(
        f"SELECT '{name}' AS model, '{x}' AS feature, k{i} AS k FROM {model}"
        for name, model, feats in (("known", "known", KNOWN), ("promo", "promo_only", KNOWN[:1]))
        for i, x in enumerate(feats))
    design = f"""
SELECT p.*, CASE WHEN isodow(p.date) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend, month(p.date) AS month,
       0 AS school_holiday, {_flags(HOT_TYPES)}
FROM promos p LEFT JOIN (SELECT store, arg_max(store_type, date) AS store_type, arg_max(assortment, date) AS assortment
                         FROM hist GROUP BY store) l ON l.store = p.store"""
    fc = f"""
SELECT p.scenario, p.store, p.date, p.promo, CAST(GREATEST(pc, 0) AS DOUBLE) / CAST(100 AS DOUBLE) AS sales,
       CAST(CASE WHEN pc > 0 THEN FLOOR((CAST(pc AS DOUBLE) / CAST(100 AS DOUBLE))
                 / COALESCE(b.basket, CAST(10 AS DOUBLE))) ELSE 0 END AS BIGINT) AS customers
FROM (SELECT d.*, CAST(FLOOR(CASE WHEN b.model = 'known' THEN a.y ELSE o.y END * 100.0 + 0.5) AS BIGINT) AS pc
      FROM design d, best b, LATERAL (SELECT {_predicted(KNOWN)} AS y FROM known) a,
           LATERAL (SELECT {_predicted(KNOWN[:1])} AS y FROM promo_only) o) p
LEFT JOIN basket b ON b.store = p.store AND b.day_of_week = isodow(p.date) AND b.promo = p.promo"""
    return {
        "linear_comparison": _linear_sql(f"""
SELECT *, rmse = MIN(rmse) OVER () AS best
FROM ({scores('known', 'known', KNOWN)} UNION ALL {scores('promo', 'promo_only', KNOWN[:1])}) s"""),
        "linear_importance": _linear_sql(f"""
SELECT model, ROW_NUMBER() OVER (ORDER BY abs(k) DESC, feature) AS rank, feature, ROUND(k, 4) AS importance
FROM ({coefs}) c JOIN best USING (model)""", best),
        "linear_forecast": _linear_sql(fc, *FC[2:-1], ("design", design), best),
    }


FOLD_ROWS = """
SELECT *, CAST(CAST('0x' || substr(md5(store || '|' || strftime(date, '%Y-%m-%d') || '|42|fold'), 1, 8) AS BIGINT) % 2 AS INTEGER) AS fold,
       isodow(date) AS dow
FROM daily_sales
WHERE open = 1 AND sales_cents > 0
  AND CAST('0x' || substr(md5(store || '|' || strftime(date, '%Y-%m-%d') || '|42'), 1, 8) AS BIGINT) < 429496729"""


_CLEAN = (("clean_stores", CLEAN_STORES), ("clean", CLEAN_JOIN))
FILES = {
    "written_table": with_base("SELECT *, CAST(year(date) AS BIGINT) AS year FROM clean", *_CLEAN),
    "sql_views": with_base("""
SELECT st.store_type, sa.promo, COUNT(*) AS n_days, CAST(SUM(sa.sales_cents) AS BIGINT) AS sales_cents
FROM daily_sales sa JOIN stores st ON sa.store = st.store WHERE sa.open = 1 GROUP BY 1, 2"""),
    "csv_sales": with_base("SELECT * FROM daily_sales"),
    "csv_stores": with_base("SELECT * FROM stores"),
    "date_rejects": with_base("""
SELECT COUNT(CASE WHEN open = 0 THEN 1 END) AS rejected, COUNT(*) AS rows FROM daily_sales"""),
    "forecast_export": with_base("""
SELECT f.scenario, strftime(f.date, '%Y-%m-%d') AS date, f.store, f.promo, f.sales, f.customers, t.*
FROM fc f, (SELECT CASE WHEN COUNT(DISTINCT store) = 1 THEN 'S' || MIN(store)
                   ELSE 'S' || MIN(store) || '-S' || MAX(store) || '_' || COUNT(DISTINCT store) || 'stores' END AS store_tag,
                   strftime(MIN(date), '%Y%m%d') AS run_from, strftime(MAX(date), '%Y%m%d') AS run_to FROM fc) t""", *FC),
    "sales_per_customer": with_base("""
SELECT store, date, CASE WHEN customers = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(sales_cents AS DOUBLE) / CAST(customers * 100 AS DOUBLE) END AS sales_per_customer FROM daily_sales"""),
    "drop_incomplete": with_base(
        "SELECT * FROM stores WHERE competition_distance IS NOT NULL AND promo_interval IS NOT NULL"),
}
MODELING = {
    "stream_totals": with_base(f"""
SELECT (SELECT CAST(CEIL(COUNT(DISTINCT (dayofyear(date) - 1) // 7) / 16.0) AS BIGINT) FROM daily_sales WHERE year(date) = 2001) AS batches,
       (SELECT COUNT(*) FROM daily_sales WHERE open = 1 AND sales_cents > 0 AND year(date) = 2001) AS records,
       (SELECT COUNT(*) FROM ({ANOMS}) a) AS anomalies""", *_SC),
    "tuning_sample": with_base("""
SELECT * FROM daily_sales
WHERE CAST('0x' || substr(md5(store || '|' || strftime(date, '%Y-%m-%d') || '|42'), 1, 8) AS BIGINT) < 429496729"""),
    "mean_metrics": with_base("""
SELECT COUNT(*) AS n, ROUND(sqrt(CAST(SUM(e * e) AS DOUBLE) / COUNT(*)), 6) AS rmse,
       ROUND(CAST(SUM(abs(e)) AS DOUBLE) / COUNT(*), 6) AS mae,
       ROUND(1.0 - CAST(SUM(e * e) AS DOUBLE) / (var_pop(y) * COUNT(*)), 6) AS r2
FROM (SELECT d.sales_cents AS y, d.sales_cents - b.mc AS e
      FROM daily_sales d JOIN baseline b ON d.store = b.store
      WHERE d.open = 1 AND d.sales_cents > 0 AND year(d.date) = 2001) x""", *_SC),
    "f_tests": _f_tests_sql(),
    "feature_report": _feature_report_sql(),
    "fold_counts": with_base("""
SELECT fold, COUNT(*) AS n, MIN(date) AS first_date, CAST(SUM(sales_cents) AS BIGINT) AS sales_cents
FROM rows_ GROUP BY fold""", ("rows_", FOLD_ROWS)),
    "fold_metrics": with_base(f"""
SELECT fold, COUNT(*) AS n, ROUND(sqrt(SUM(e * e) / COUNT(*)), 6) AS rmse, ROUND(SUM(abs(e)) / COUNT(*), 6) AS mae,
       ROUND(1.0 - SUM(e * e) / (var_pop(y) * COUNT(*)), 6) AS r2
FROM (SELECT r.fold, CAST(r.sales_cents AS DOUBLE) AS y, r.sales_cents - CAST(o.pc AS DOUBLE) AS e
      FROM rows_ r JOIN (SELECT f.fold, x.dow, {hu('SUM(x.sales_cents)', 'COUNT(*)')} AS pc
                         FROM (SELECT DISTINCT fold FROM rows_) f JOIN rows_ x ON x.fold <> f.fold
                         GROUP BY f.fold, x.dow) o ON o.fold = r.fold AND o.dow = r.dow) z
GROUP BY fold""", ("rows_", FOLD_ROWS)),
    **_linear_keys(),
}


def oracle_sql() -> dict[str, str]:
    out = dict(REPORTS)
    out.update(CLEANING)
    out.update(SCORING)
    out.update(FORECASTING)
    out.update(EXTRA)
    out.update(FILES)
    out.update(MODELING)
    return out
