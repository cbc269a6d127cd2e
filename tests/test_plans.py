"""Plan shape: filters reach the scans, history is combined map side, no
static broadcast, and the merge reads only touched partitions."""

import contextlib
import io

import pytest

from daybook.operators import tables as tb
from daybook.plans import fixtures as fx
from daybook.plans.jobs import compute_features

from .conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def tables(spark):
    """Population partitioned by date and history with DATE columns, as catalog tables."""
    import uuid

    from daybook.operators.catalog import create_database
    from daybook.session import shared_dir

    db = f"plans_{uuid.uuid4().hex[:8]}"
    create_database(spark, db, location=shared_dir(spark, db))
    tb.create_or_replace(fx.population(spark, SF_SMALL), f"{db}.active_clients", partition_by="date")
    tb.create_or_replace(fx.history(spark, SF_SMALL), f"{db}.outcomes")
    return db


def test_filters_and_partition_pruning_reach_scans(spark, tables):
    df = compute_features(
        spark, "1998-03-01", "1998-03-05", f"{tables}.active_clients", f"{tables}.outcomes", since="1996-01-01"
    )
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(date" in plan and "date#" in plan
    assert "GreaterThanOrEqual(start_date,1996-01-01)" in plan
    # end_date < date < 1998-03-05 implies end_date < 1998-03-04, pushed to the history scan
    assert "LessThan(end_date,1998-03-04)" in plan


def test_history_is_combined_before_shuffle(spark, tables):
    df = compute_features(
        spark, "1998-03-01", "1998-03-05", f"{tables}.active_clients", f"{tables}.outcomes", since="1996-01-01"
    )
    plan = _plan(df)
    assert "Functions [6]: [partial_count(1), partial_sum(" in plan
    assert "BroadcastExchange" not in plan  # static estimates never broadcast


def test_merge_slice_uses_partition_filter(spark, tables):
    from daybook.operators.merge import _within

    target = spark.table(f"{tables}.active_clients")
    day = target.orderBy("date").first().date
    source = target.where(f"date = DATE'{day}'")
    plan = _plan(_within(target, source, ["date"]))
    pruning = plan.split("PartitionFilters")[1].split("\n")[0]
    assert str(day) in pruning


def test_history_is_reduced_to_the_population_below_the_union(spark, tables):
    df = compute_features(
        spark, "1998-03-01", "1998-03-05", f"{tables}.active_clients", f"{tables}.outcomes", since="1996-01-01",
        reduce_history=True,
    )
    tree = df._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("Union") < tree.index("LeftSemi")


@pytest.mark.parametrize("method", ["prefix_sum", "chunked"])
def test_population_and_history_are_scanned_once(spark, tables, method):
    df = compute_features(
        spark, "1998-03-01", "1998-03-05", f"{tables}.active_clients", f"{tables}.outcomes", since="1996-01-01", method=method
    )
    if method == "prefix_sum":
        tree = df._jdf.queryExecution().executedPlan().toString()
        assert tree.count("FileScan") == 2 and tree.count("active_clients") == 1
        assert "Join" not in tree
    else:  # both were read into the sorted chunks, which alone are read again
        tree = df._jdf.queryExecution().optimizedPlan().toString()
        assert "active_clients" not in tree and "outcomes" not in tree


def test_daily_run_reads_the_new_days_alone(spark, tables):
    from daybook.operators.pit import running_totals

    history = spark.table(f"{tables}.outcomes")
    carried = running_totals(history, "1998-03-01", since="1996-01-01").persist()
    plan = _plan(running_totals(history, "1998-03-02", carried, since="1996-01-01"))
    assert "GreaterThanOrEqual(end_date,1998-03-01)" in plan and "LessThan(end_date,1998-03-02)" in plan
    carried.unpersist()
