"""User-level jobs end to end in fresh databases."""

from pyspark.sql import functions as F

from daybook.plans import fixtures as fx
from daybook.plans import jobs
from daybook.plans.oracle import WINDOW_A, WINDOW_B

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def _daily_runs(spark, db, **kw):
    orders = fx.read_table(spark, SF_SMALL, "orders")
    pop, hist = fx.population_from(orders), fx.history_from(orders)
    for start, end, since in (WINDOW_A, WINDOW_B):
        shown = jobs.daily_publish_merge(spark, start, end, f"{db}.pub", f"{db}.copy", pop, hist, since=since, **kw)
        assert shown.count() <= 10
        assert shown.where(F.col(jobs.HIRE) <= 0).count() == 0
    return spark.table(f"{db}.copy")


def test_window_scoped_merge_equals_full_table_merge(spark, db):
    full = _rows(_daily_runs(spark, db))
    other = db + "_w"
    from daybook.operators.catalog import create_database
    from daybook.session import shared_dir

    create_database(spark, other, location=shared_dir(spark, other))
    assert _rows(_daily_runs(spark, other, merge_scope="window", persist=True)) == full


def test_first_day_copy_equals_published(spark, db):
    orders = fx.read_table(spark, SF_SMALL, "orders")
    start, end, since = WINDOW_A
    jobs.daily_publish_merge(
        spark, start, end, f"{db}.pub", f"{db}.copy", fx.population_from(orders), fx.history_from(orders), since=since
    )
    assert _rows(spark.table(f"{db}.copy")) == _rows(spark.table(f"{db}.pub"))


def test_compute_replace_keeps_only_last_run(spark, db):
    orders = fx.read_table(spark, SF_SMALL, "orders")
    pop, hist = fx.population_from(orders), fx.history_from(orders)
    for start, end, since in (WINDOW_A, WINDOW_B):
        jobs.compute_replace(spark, start, end, f"{db}.t", pop, hist, since=since)
    start, end, since = WINDOW_B
    assert _rows(spark.table(f"{db}.t")) == _rows(jobs.compute_features(spark, start, end, pop, hist, since=since))


def test_inspect_returns_five_and_ten_rows(spark, db):
    jobs.reload_table(spark, fx.table_path(SF_SMALL, "customer"), db, "c")
    first5, first10 = jobs.inspect_table(spark, f"{db}.c")
    assert first5.count() == 5 and first10.count() == 10


def test_reload_replaces_existing_table(spark, db):
    jobs.reload_table(spark, fx.table_path(SF_SMALL, "nation"), db, "t")
    df = jobs.reload_table(spark, fx.table_path(SF_SMALL, "customer"), db, "t")
    assert df.count() == fx.read_table(spark, SF_SMALL, "customer").count()


def test_daily_job_rerun_is_idempotent(spark, db):
    """A failed day can simply be run again: publish, copy and merge are idempotent
    (the feature table has no NULL keys: dates are filtered, clients zero-filled)."""
    orders = fx.read_table(spark, SF_SMALL, "orders")
    pop, hist = fx.population_from(orders), fx.history_from(orders)
    start, end, since = WINDOW_A
    jobs.daily_publish_merge(spark, start, end, f"{db}.pub", f"{db}.copy", pop, hist, since=since)
    once = (_rows(spark.table(f"{db}.pub")), _rows(spark.table(f"{db}.copy")))
    jobs.daily_publish_merge(spark, start, end, f"{db}.pub", f"{db}.copy", pop, hist, since=since)
    assert (_rows(spark.table(f"{db}.pub")), _rows(spark.table(f"{db}.copy"))) == once


def test_daily_runs_on_totals_equal_the_full_computation(spark, db):
    import pytest

    from daybook.operators.pit import point_in_time_features, totals_day

    pop, hist = fx.population(spark, SF_SMALL), fx.history(spark, SF_SMALL)
    since, days = "1996-01-01", [f"1998-06-{d:02d}" for d in range(1, 9)]
    pop = pop.unionByName(pop.limit(1).withColumn("date", F.expr(f"DATE'{days[5]}'")))
    table, totals = f"{db}.f", f"{db}.totals"
    windows = [(days[0], days[1]), (days[1], days[4]), (days[4], days[4 + 1]), (days[5], days[7])]
    for start, end in windows:
        jobs.daily_features(spark, start, end, table, totals, pop, hist, since=since)
    full = point_in_time_features(pop, hist, days[0], days[-1], since=since)
    assert _rows(spark.table(table)) == _rows(full) and full.count()
    assert totals_day(spark.table(totals)) == days[5]
    jobs.daily_features(spark, *windows[-1], table, totals, pop, hist, since=since)  # again
    assert _rows(spark.table(table)) == _rows(full)
    with pytest.raises(ValueError):
        jobs.daily_features(spark, *windows[0], table, totals, pop, hist, since=since)

    # a row that arrives after the totals passed its date is refused until they are built anew
    client = pop.where(f"date = DATE'{days[5]}'").first().client_id
    row = hist.limit(1).withColumns({"employer": F.lit(client).cast("long"), "end_date": F.expr("DATE'1998-01-01'"), "start_date": F.expr("DATE'1997-12-01'")})
    more = hist.unionByName(row)
    jobs.daily_features(spark, *windows[-1], table, totals, pop, more, since=since)
    assert _rows(spark.table(table)) == _rows(full)
    spark.sql(f"DROP TABLE {totals}")
    jobs.daily_features(spark, *windows[-1], table, totals, pop, more, since=since)
    anew = point_in_time_features(pop, more, *windows[-1], since=since)
    assert _rows(spark.table(table).where(f"date >= DATE'{days[5]}'")) == _rows(anew) != _rows(full.where(f"date >= DATE'{days[5]}'"))
