"""Plan shapes that matter at scale (read from ``explain``)."""

import contextlib
import io

from shopcast.operators import features as FE
from shopcast.plans import catalog
from shopcast.plans import reports as R
from shopcast.sources.tables import daily_sales, stores

from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_base_table_is_aggregated_and_pruned(spark):
    p = plan(daily_sales(spark, SF_SMALL))
    assert "partial_min(l_linestatus" in p and "partial_sum(" in p  # a string MIN is sort-based
    assert "l_partkey" not in p.split("ReadSchema")[1].splitlines()[0]


def test_year_range_reaches_the_scan(spark):
    p = plan(catalog.queries()["scored"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p


def test_lags_and_rolling_share_one_exchange(spark):
    df = FE.add_rolling(FE.add_lags(daily_sales(spark, SF_SMALL)))
    p = plan(df)
    window_part = p.split("Window")[0]
    assert p.count("hashpartitioning(store") == 1, window_part


def test_rank_report_uses_window_group_limit(spark):
    p = plan(R.report_top_stores(daily_sales(spark, SF_SMALL), stores(spark, SF_SMALL)))
    assert p.count("WindowGroupLimit") >= 2        # partial and final


def test_no_single_partition_window_over_rows_in_split(spark):
    from shopcast.operators.train import split_label
    df = daily_sales(spark, SF_SMALL).select("store", "date")
    p = plan(split_label(df, 0.8))
    assert "SinglePartition" not in p
