"""The stream scores exactly like the batch; retried batches, restarts and
compaction neither lose nor double rows."""

import time

import pytest
from pyspark.sql import functions as F

from shopcast.session import run_dir

from shopcast.operators import scoring as SC
from shopcast.operators.clean import in_years
from shopcast.sources.tables import daily_sales
from shopcast.streaming import anomaly as ST
from shopcast.streaming import runs

from conftest import SF_SMALL


def year_files(facts, n_files, fmt="parquet"):
    """``facts`` as files in date order, in a fresh folder."""
    base = run_dir(facts.sparkSession, "stream")
    files = facts.repartitionByRange(n_files, "date", "store").write
    files.option("header", "true").csv(f"{base}/input") if fmt == "csv" else files.parquet(f"{base}/input")
    return base


def score_year(spark, facts, baseline, n_files=3, fmt="parquet"):
    """One file to a batch; the output folder."""
    base = year_files(facts, n_files, fmt)
    return ST.score_directory(spark, f"{base}/input", baseline, f"{base}/out", f"{base}/checkpoint",
                              max_files=1, trigger="0 seconds", fmt=fmt)


def same_rows(got, expected):
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_stream_equals_batch_and_is_idempotent(spark, tmp_dir):
    sales = daily_sales(spark, SF_SMALL)
    base = SC.store_baseline(sales, 2000)
    facts = in_years(sales, 2001)
    out = score_year(spark, facts, base)
    got = ST.read_scored(spark, out)
    exp = SC.scored_year(sales, base, 2001)
    assert got.count() == exp.count() == 454
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    assert ST.read_anomalies(spark, out).count() == 5
    # replay batch 0: same rows, no duplicates
    writer = ST.make_batch_writer(ST.prepare_baseline(base), out)
    batch0 = spark.read.parquet(f"{out}/scored").filter("batch_id = 0")
    n0 = batch0.count()
    ids = batch0.select("store", "date")
    replay = facts.join(ids, ["store", "date"], "left_semi")
    writer(replay, 0)
    assert spark.read.parquet(f"{out}/scored").filter("batch_id = 0").count() == n0
    assert ST.read_scored(spark, out).count() == 454


def test_csv_stream_and_counters(spark):
    sales = daily_sales(spark, SF_SMALL)
    base = SC.store_baseline(sales, 2000)
    facts = in_years(sales, 2001)
    out = score_year(spark, facts, base, n_files=2, fmt="csv")
    stats = ST.stream_stats(spark, out)
    n_open = facts.filter("open = 1 AND sales_cents > 0").count()
    assert stats["batches"] == 2
    assert stats["records"] == n_open
    assert stats["anomalies"] == 5
    exp = SC.scored_year(sales, base, 2001)
    got = ST.read_scored(spark, out)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_calm_stream_has_no_anomalies(spark, tmp_dir):
    import datetime as dt
    from pyspark.sql import functions as F
    sales = daily_sales(spark, SF_SMALL)
    base = SC.store_baseline(sales, 2000)
    facts = in_years(sales, 2001).filter(F.col("date") < dt.date(2001, 1, 8))
    writer = ST.make_batch_writer(ST.prepare_baseline(base), tmp_dir, k=1000.0)
    for batch in range(3):
        writer(facts, batch)
    assert ST.read_anomalies(spark, tmp_dir).count() == 0
    stats = ST.stream_stats(spark, tmp_dir)
    assert stats["batches"] == 3 and stats["records"] == 3 * facts.count()


def test_failure_inside_a_batch_restarts_from_the_checkpoint(spark):
    """ST4, ST5, ST7: the fourth batch fails once between its sinks and its
    commit; the query starts again and the output is the batch's."""
    sales = daily_sales(spark, SF_SMALL)
    base = SC.store_baseline(sales, 2000)
    facts = in_years(sales, 2001)
    root = year_files(facts, 5)
    prepared = ST.prepare_baseline(base)
    write, calls = ST.make_batch_writer(prepared, f"{root}/out"), []

    def failing(batch_df, batch_id):
        calls.append(batch_id)
        if batch_id == 3 and calls.count(3) == 1:
            scored = SC.score(batch_df, prepared).select(SC.SCORED_COLUMNS)
            runs.write_batch(scored, f"{root}/out", "scored", batch_id)
            assert {r["last"] for r in runs.live(spark, f"{root}/out").collect()} == {0, 1, 2}
            raise OSError("lost between sink and commit")
        write(batch_df, batch_id)

    live = ST.LiveCounters("restarted")
    spark.streams.addListener(live)
    try:
        used = ST.supervise(lambda: ST.start_anomaly_query(
            ST.read_sales_stream(spark, f"{root}/input"), prepared, f"{root}/out", f"{root}/checkpoint",
            trigger="1 second", name="restarted", writer=failing))
        until = time.time() + 30
        while live.totals["batches"] < 5 and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(live)
    assert used == 1 and calls == [0, 1, 2, 3, 3, 4]
    same_rows(ST.read_scored(spark, f"{root}/out"), SC.scored_year(sales, base, 2001))
    same_rows(ST.read_anomalies(spark, f"{root}/out"), SC.anomalies(SC.score(facts, base)))
    n_open = facts.filter("open = 1 AND sales_cents > 0").count()
    assert ST.stream_stats(spark, f"{root}/out") == {"batches": 5, "records": n_open, "anomalies": 5}
    assert live.totals == {"batches": 5, "records": n_open}


def test_a_query_that_keeps_failing_stops(spark, tmp_dir):
    sales = daily_sales(spark, SF_SMALL)
    root = year_files(in_years(sales, 2001), 1)
    starts = []

    def broken(batch_df, batch_id):
        starts.append(batch_id)
        raise OSError("always")

    with pytest.raises(ST.StreamingQueryException):
        ST.supervise(lambda: ST.start_anomaly_query(
            ST.read_sales_stream(spark, f"{root}/input"), None, f"{root}/out", f"{root}/checkpoint",
            trigger="0 seconds", name="broken", writer=broken), restarts=2)
    assert starts == [0, 0, 0]
    assert ST.read_scored(spark, f"{root}/out").count() == 0
    assert ST.stream_stats(spark, f"{root}/out") == {"batches": 0, "records": 0, "anomalies": 0}


def folders(spark, out, name):
    fs, p = runs._path(spark, f"{out}/{name}")
    return {f.getPath().getName() for f in fs.listStatus(p)} if fs.exists(p) else set()


def test_compaction_keeps_rows_and_bounds_folders(spark, tmp_dir):
    sales = daily_sales(spark, SF_SMALL)
    base = ST.prepare_baseline(SC.store_baseline(sales, 2000))
    facts = in_years(sales, 2001).filter("open = 1 AND sales_cents > 0").cache()
    write = ST.make_batch_writer(base, tmp_dir, every=4)
    part = lambda k: facts.filter(F.pmod(F.dayofyear("date"), F.lit(13)) == k)
    for k in range(13):
        write(part(k), k)
    keep, gone = runs._spans(spark, tmp_dir)
    # 0-2 at batch 3 (3 waits), 3-6 with 0-2 at batch 7, then 7-10 after batch 11
    assert [(r["first"], r["last"]) for r in keep][-1] == (12, 12) and len(keep) <= 6
    assert len(folders(spark, tmp_dir, "scored")) <= 2 * 4 + 1
    scored, found = SC.score(facts, base).select(SC.SCORED_COLUMNS), SC.anomalies(SC.score(facts, base))
    same_rows(ST.read_scored(spark, tmp_dir), scored)
    same_rows(ST.read_anomalies(spark, tmp_dir), found)
    assert ST.stream_stats(spark, tmp_dir) == {"batches": 13, "records": facts.count(), "anomalies": 5}

    write(part(12), 12)  # the newest batch runs again
    same_rows(ST.read_scored(spark, tmp_dir), scored)
    assert runs.compact(spark, tmp_dir, ST.TABLES, every=2) in (True, False)
    same_rows(ST.read_scored(spark, tmp_dir), scored)
    # replaced folders have gone with the compaction after
    runs.compact(spark, tmp_dir, ST.TABLES, every=2)
    left = {f"batch_id={r['first']}" for r in runs._spans(spark, tmp_dir)[0] if r["first"] == r["last"]}
    assert {f for f in folders(spark, tmp_dir, "scored") if f.startswith("batch")} == left
    same_rows(ST.read_scored(spark, tmp_dir), scored)
    facts.unpersist()


def test_a_compaction_that_breaks_off_shows_nothing(spark, tmp_dir, monkeypatch):
    sales = daily_sales(spark, SF_SMALL)
    base = ST.prepare_baseline(SC.store_baseline(sales, 2000))
    facts = in_years(sales, 2001).filter("open = 1 AND sales_cents > 0")
    write = ST.make_batch_writer(base, tmp_dir, every=1000)
    for k in range(4):
        write(facts.filter(F.pmod(F.dayofyear("date"), F.lit(4)) == k), k)
    whole = SC.score(facts, base).select(SC.SCORED_COLUMNS)
    with monkeypatch.context() as m:
        m.setattr(runs, "_one_row", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            runs.compact(spark, tmp_dir, ST.TABLES, every=2)
    assert folders(spark, tmp_dir, "runs/scored") == {"first=0"}
    assert all(r["first"] == r["last"] for r in runs._spans(spark, tmp_dir)[0])
    same_rows(ST.read_scored(spark, tmp_dir), whole)
    assert runs.compact(spark, tmp_dir, ST.TABLES, every=2)
    same_rows(ST.read_scored(spark, tmp_dir), whole)


def test_spans_stay_few():
    """A day of batches every five seconds, and then ten days."""
    sizes, most = [], 0
    for batch in range(172_800):
        sizes.append(1)
        if (batch + 1) % 100 == 0:
            at = runs.to_merge(sizes[:-1])
            if at is not None:
                sizes[at:-1] = [sum(sizes[at:-1])]
        most = max(most, len(sizes))
    assert sum(sizes) == 172_800 and max(sizes) <= runs.RUN_BATCHES
    assert most <= 200 + 12 + 172_800 // (runs.RUN_BATCHES // 2)
    assert runs.to_merge([]) is None and runs.to_merge([1, 1], every=100) is None
