"""Registered queries: one callable per inventory item, ``(spark, sf_dir) -> DataFrame``.

Each reads the test tables under ``sf_dir`` (or tables Spark writes from
them) so its work grows with the data. Write-type queries run in a fresh
database located under the session's shared checkpoint folder and return the
rows left in the table afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.features import CORRECTED_FEATURES, Feature
from daybook.functions.flags import flag_columns, json_answers
from daybook.operators import catalog as cat
from daybook.operators import tables as tb
from daybook.operators.merge import merge_into
from daybook.operators.pit import (
    fill_zero,
    history_since,
    pit_grouped,
    pit_join,
    point_in_time_features,
    population_left_join,
    restrict_dates,
)
from daybook.plans import fixtures as fx
from daybook.plans import jobs
from daybook.plans.oracle import DAYS, ONE_DAY, SELECTED_FEATURE_NAMES, WINDOW_A, WINDOW_B
from daybook.session import shared_dir
from daybook.sources import preview, read_parquet, read_path, read_sql, read_table

Query = Callable[[SparkSession, str], DataFrame]


# -- point-in-time features -------------------------------------------------


def _features(spark: SparkSession, sf_dir: str, *, distinct: bool = True, window=None, **kw) -> DataFrame:
    start, end, since = window or (fx.POPULATION_START, fx.POPULATION_END, fx.HISTORY_SINCE)
    orders = fx.read_table(spark, sf_dir, "orders")
    return point_in_time_features(
        fx.population_from(orders, distinct), fx.history_from(orders), start, end, since=since, **kw
    )


def pit_features(spark, sf_dir):
    return _features(spark, sf_dir)


def pit_features_dup_population(spark, sf_dir):
    return _features(spark, sf_dir, distinct=False)


def pit_features_prefix_sum(spark, sf_dir):
    return _features(spark, sf_dir, method="prefix_sum")


def pit_features_range_join(spark, sf_dir):
    return _features(spark, sf_dir, method="join")


def pit_features_direct(spark, sf_dir):
    return _features(spark, sf_dir, method="direct")


def pit_features_one_day(spark, sf_dir):
    return _features(spark, sf_dir, window=ONE_DAY)


def pit_features_selected(spark, sf_dir):
    return _features(spark, sf_dir, features=SELECTED_FEATURE_NAMES)


def pit_features_corrected(spark, sf_dir):
    return _features(spark, sf_dir, registry=CORRECTED_FEATURES)


def pit_features_chunked(spark, sf_dir):
    return _features(spark, sf_dir, method="chunked")


def pit_features_instants(spark, sf_dir):
    """TIMESTAMP population and history: every instant is a day of its own."""
    orders = fx.read_table(spark, sf_dir, "orders")
    pop = fx.population_from(orders, True).withColumn("date", F.expr("CAST(date AS TIMESTAMP) + make_interval(0, 0, 0, 0, 12)"))
    hist = fx.history_from(orders).withColumn("end_date", F.expr("CAST(end_date AS TIMESTAMP) + make_interval(0, 0, 0, 0, CAST(pmod(employer, 24) AS INT))"))
    rows = point_in_time_features(pop, hist, fx.POPULATION_START, fx.POPULATION_END, since=fx.HISTORY_SINCE, method="chunked")
    return rows.withColumn("date", F.expr("CAST(date AS DATE)"))


def features_positive_only(spark, sf_dir):
    return _features(spark, sf_dir).where(F.col("cl_count_of_hire_v1") > 0)


# -- scans, filters, functions ------------------------------------------------


def scan_parquet_project(spark, sf_dir):
    return read_parquet(spark, fx.table_path(sf_dir, "customer")).select("c_custkey", "c_name", "c_nationkey")


def scan_table(spark, sf_dir):
    t = _scratch_db(spark, "scan") + ".t"
    tb.create_table(_customer(spark, sf_dir), t)
    return read_table(spark, f"spark_catalog.{t}")


def scan_sql(spark, sf_dir):
    t = _scratch_db(spark, "sql") + ".t"
    tb.create_table(read_parquet(spark, fx.table_path(sf_dir, "nation")), t)
    return read_sql(spark, t)


def scan_path(spark, sf_dir):
    return read_path(spark, fx.table_path(sf_dir, "customer"), "parquet")


def date_range_half_open(spark, sf_dir):
    o = fx.dated_orders(spark, sf_dir).select("o_orderkey", "o_custkey", F.col("d").alias("date"))
    return restrict_dates(o, fx.POPULATION_START, fx.POPULATION_END)


def filter_unselected_column(spark, sf_dir):
    # The filter names a column the projection dropped; the analyzer resolves it.
    h = fx.history(spark, sf_dir).select(
        "client_uid", "employer", "client_recom_score_answer", "contractor_recom_score_answer", "outcome", "end_date"
    )
    return h.filter(F.col("start_date") >= F.lit(fx.HISTORY_SINCE))


def json_answer_extract(spark, sf_dir):
    h = fx.history(spark, sf_dir)
    return h.select(
        "employer", "end_date", "contractor_recom_score_answer",
        json_answers("contractor_recom_score_answer").alias("contractor_answers"),
    )


def json_code_flags(spark, sf_dir):
    flags = flag_columns()
    names = ["client_weakness_is_unclear_requirements", "client_weakness_is_poor_communication",
             "client_weakness_is_something_else"]
    return fx.history(spark, sf_dir).select("employer", "end_date", *[flags[n].alias(n) for n in names])


def outcome_one_hot(spark, sf_dir):
    flags = flag_columns()
    names = ["outcome_is_good", "outcome_is_neutral", "outcome_is_bad"]
    return fx.history(spark, sf_dir).select("employer", "end_date", "outcome", *[flags[n].alias(n) for n in names])


# -- joins, aggregation, fill, previews ----------------------------------------


def _population(spark, sf_dir):
    return restrict_dates(fx.population(spark, sf_dir), fx.POPULATION_START, fx.POPULATION_END)


def _flagged_history(spark, sf_dir):
    h = history_since(fx.history(spark, sf_dir), fx.HISTORY_SINCE)
    return h.select("employer", "end_date", "outcome", flag_columns()["outcome_is_good"].alias("outcome_is_good"))


def pit_join_rows(spark, sf_dir):
    rows = pit_join(_flagged_history(spark, sf_dir), _population(spark, sf_dir))
    return rows.select("client_id", "date", "employer", "end_date", "outcome")


# count / sum / avg over the point-in-time join rows, computed from daily
# pre-aggregates (equal to grouping the join output, without its skew).
GROUP_FEATURES = (
    Feature("n_rows", "count"),
    Feature("n_good", "sum", "outcome_is_good"),
    Feature("rate_good", "avg", "outcome_is_good"),
)


def _grouped(spark, sf_dir):
    h = history_since(fx.history(spark, sf_dir), fx.HISTORY_SINCE)
    return pit_grouped(_population(spark, sf_dir), h, GROUP_FEATURES)


def group_count_sum_avg(spark, sf_dir):
    return _grouped(spark, sf_dir)


def population_left_join_query(spark, sf_dir):
    return population_left_join(_population(spark, sf_dir), _grouped(spark, sf_dir), ("client_id", "date"))


def fill_zero_query(spark, sf_dir):
    return fill_zero(population_left_join_query(spark, sf_dir))


def preview_ordered(spark, sf_dir):
    return preview(features_positive_only(spark, sf_dir), 10, order_by=["date", "client_id"])


def limit_rows_only(spark, sf_dir):
    t = _scratch_db(spark, "limit") + ".t"
    tb.create_table(_customer(spark, sf_dir), t)
    return _looks(spark.table(t), limit=read_sql(spark, t, limit=10))


def _looks(table: DataFrame, **looks: DataFrame) -> DataFrame:
    """For each look: its rows, and how many of them the table doesn't hold."""
    parts = [
        rows.agg(F.lit(name).alias("look"), F.count(F.lit(1)).alias("n_rows")).crossJoin(
            rows.exceptAll(table).agg(F.count(F.lit(1)).alias("n_foreign"))
        )
        for name, rows in looks.items()
    ]
    return reduce(DataFrame.unionAll, parts)


# -- table writes ---------------------------------------------------------------


def _scratch_db(spark: SparkSession, key: str) -> str:
    name = f"dbk_{key}_{uuid.uuid4().hex[:10]}"
    cat.create_database(spark, name, location=shared_dir(spark, name))
    return name


def _customer(spark, sf_dir):
    return read_parquet(spark, fx.table_path(sf_dir, "customer"))


def _window(spark, sf_dir, window):
    return _features(spark, sf_dir, window=window)


def create_only(spark, sf_dir):
    t = _scratch_db(spark, "create") + ".t"
    tb.create_table(_customer(spark, sf_dir), t)
    return spark.table(t)


def append_by_name(spark, sf_dir):
    t = _scratch_db(spark, "append") + ".t"
    c = _customer(spark, sf_dir)
    tb.create_table(c, t)
    tb.append_by_name(c.select(*reversed(c.columns)), t)
    return spark.table(t)


def create_or_replace(spark, sf_dir):
    t = _scratch_db(spark, "replace") + ".t"
    tb.create_or_replace(read_parquet(spark, fx.table_path(sf_dir, "nation")), t)
    tb.create_or_replace(_customer(spark, sf_dir), t)
    return spark.table(t)


def create_or_replace_partitioned(spark, sf_dir):
    t = _scratch_db(spark, "replace_part") + ".t"
    tb.create_or_replace(_window(spark, sf_dir, WINDOW_A), t, partition_by="date")
    tb.create_or_replace(_window(spark, sf_dir, WINDOW_B), t, partition_by="date")
    return spark.table(t)


def dynamic_partition_overwrite(spark, sf_dir):
    t = _scratch_db(spark, "dyn") + ".t"
    tb.create_table(_window(spark, sf_dir, WINDOW_A), t, partition_by="date")
    tb.overwrite_partitions(_window(spark, sf_dir, WINDOW_B), t)
    return spark.table(t)


def publish_first_run(spark, sf_dir):
    t = _scratch_db(spark, "pub1") + ".t"
    done = tb.publish(_window(spark, sf_dir, WINDOW_A), t)
    if done != "create":
        raise AssertionError(f"first publish did {done}")
    return spark.table(t)


def publish_second_run(spark, sf_dir):
    t = _scratch_db(spark, "pub2") + ".t"
    tb.publish(_window(spark, sf_dir, WINDOW_A), t)
    done = tb.publish(_window(spark, sf_dir, WINDOW_B), t)
    if done != "overwrite":
        raise AssertionError(f"second publish did {done}")
    return spark.table(t)


def ctas_if_not_exists(spark, sf_dir):
    db = _scratch_db(spark, "ctas")
    tb.publish(_window(spark, sf_dir, WINDOW_A), f"{db}.a")
    tb.publish(_window(spark, sf_dir, WINDOW_B), f"{db}.b")
    tb.create_table_as_select_if_absent(spark, f"{db}.copy", f"{db}.a", partition_by="date")
    tb.create_table_as_select_if_absent(spark, f"{db}.copy", f"{db}.b", partition_by="date")
    return spark.table(f"{db}.copy")


def merge_update_insert(spark, sf_dir):
    t = _scratch_db(spark, "merge") + ".t"
    tb.create_or_replace(_window(spark, sf_dir, WINDOW_A), t, partition_by="date")
    merge_into(_window(spark, sf_dir, WINDOW_B), t, persist_source=True)
    return spark.table(t)


def merge_first_run_noop(spark, sf_dir):
    db = _scratch_db(spark, "merge_noop")
    tb.publish(_window(spark, sf_dir, WINDOW_A), f"{db}.pub")
    tb.create_table_as_select_if_absent(spark, f"{db}.copy", f"{db}.pub", partition_by="date")
    merge_into(spark.table(f"{db}.pub"), f"{db}.copy")
    return spark.table(f"{db}.copy")


def _merge_tables(spark, sf_dir, key: str, partition: str):
    """Nations by ``partition``, then merged with changed and new rows."""
    t = _scratch_db(spark, key) + ".t"
    c = _customer(spark, sf_dir).selectExpr(
        "c_custkey AS id", "CAST(c_custkey % 7 AS INT) AS part", "c_nationkey AS n",
        "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('p', c_custkey % 4) END AS name",
    )
    tb.create_table(c.where("id % 3 <> 0").select("id", "n", partition), t, partition_by=partition)
    return c, t


def merge_key_without_partition(spark, sf_dir):
    c, t = _merge_tables(spark, sf_dir, "merge_free", "part")
    # the matches lie in other partitions than the source names
    merge_into(c.where("id % 2 = 0").selectExpr("id", "n + 100 AS n", "CAST(99 AS INT) AS part"), t, keys=("id",), update_cols=("n",))
    return spark.table(t)


def merge_string_partition(spark, sf_dir):
    c, t = _merge_tables(spark, sf_dir, "merge_text", "name")
    merge_into(c.where("id % 2 = 0").selectExpr("id", "n + 100 AS n", "name"), t, keys=("id", "name"), update_cols=("n",))
    return spark.table(t)


def merge_bucketed(spark, sf_dir):
    """Merge into a target bucketed by a key: changed rows, and new ones in old and new partitions."""
    c = _customer(spark, sf_dir).selectExpr("c_custkey AS id", "c_nationkey AS n", "CAST(c_custkey % 7 AS INT) AS part")
    t = _scratch_db(spark, "merge_buckets") + ".t"
    tb.create_table(c.where("id % 3 <> 0"), t, partition_by="part", bucket_by=(4, ["id"]))
    source = c.where("id % 2 = 0").selectExpr("id", "n + 100 AS n", "IF(id % 4 = 0, part, CAST(99 AS INT)) AS part")
    merge_into(source, t, keys=("id", "part"), update_cols=("n",))
    return spark.table(t)


def path_append_partitioned(spark, sf_dir):
    db = _scratch_db(spark, "path_append_part")
    path = shared_dir(spark, "path_append_part_files")
    c = _customer(spark, sf_dir)
    tb.append_path(c.where("c_nationkey < 10"), path, f"{db}.t", partition_by="c_nationkey")
    tb.append_path(c.where("c_nationkey >= 5"), path, f"{db}.t")
    return spark.table(f"{db}.t")


def external_partitioned_replace(spark, sf_dir):
    db = _scratch_db(spark, "external_part")
    path = shared_dir(spark, "external_part_files")
    c = _customer(spark, sf_dir)
    with tb.session_conf(spark, tb.OVERWRITE_MODE, "dynamic"):
        tb.save_external(c.where("c_nationkey < 10"), f"{db}.t", path, partition_by="c_nationkey")
        tb.save_external(c.where("c_nationkey >= 5"), f"{db}.t", path, partition_by="c_nationkey")
    return read_path(spark, path).unionByName(spark.table(f"{db}.t"))


def replace_three_part_name(spark, sf_dir):
    t = "spark_catalog." + _scratch_db(spark, "replace3") + ".t"
    tb.create_or_replace(_customer(spark, sf_dir).limit(0), t)
    tb.create_or_replace(_customer(spark, sf_dir), t)
    tb.create_or_replace(spark.table(t).where("c_nationkey >= 5"), t)
    return spark.table(t)


def replace_external(spark, sf_dir):
    t = _scratch_db(spark, "replace_ext") + ".t"
    path = shared_dir(spark, "replace_ext_files")
    tb.save_external(_customer(spark, sf_dir).where("c_nationkey < 10"), t, path, partition_by="c_nationkey")
    tb.create_or_replace(_customer(spark, sf_dir).where("c_nationkey >= 5"), t, partition_by="c_nationkey")
    if cat.table_info(spark, t)["Type"] != "EXTERNAL":
        raise AssertionError("the external table has become a managed one")
    by_path = read_path(spark, path)
    return spark.table(t).unionByName(by_path)


def merge_unpartitioned_three_part(spark, sf_dir):
    c = _customer(spark, sf_dir).selectExpr("c_custkey AS id", "c_nationkey AS n")
    t = "spark_catalog." + _scratch_db(spark, "merge3") + ".t"
    tb.create_table(c.where("id % 3 <> 0"), t)
    merge_into(c.where("id % 2 = 0").selectExpr("id", "n + 100 AS n"), t, keys=("id",), update_cols=("n",))
    return spark.table(t)


def path_text_partition(spark, sf_dir):
    """A date written as text comes back as text, by path and by name."""
    db = _scratch_db(spark, "text_part")
    path = shared_dir(spark, "text_part_files")
    orders = fx.read_table(spark, sf_dir, "orders").selectExpr("o_orderkey", "date_format(o_orderdate, 'yyyy-MM') AS date")
    tb.append_path(orders.where("o_orderkey % 2 = 0"), path, partition_by="date")
    tb.append_path(orders.where("o_orderkey % 2 = 1"), path, f"{db}.t")
    by_path, by_name = read_path(spark, path), spark.table(f"{db}.t")
    return by_path.selectExpr("o_orderkey", "date", "typeof(date) AS kind").unionByName(by_name.selectExpr("o_orderkey", "date", "typeof(date) AS kind"))


def daily_totals_runs(spark, sf_dir):
    """Four daily runs on running totals."""
    db = _scratch_db(spark, "totals")
    pop, hist = fx.population(spark, sf_dir), fx.history(spark, sf_dir)
    for start, end in zip(DAYS[:-1], DAYS[1:], strict=True):
        jobs.daily_features(spark, start, end, f"{db}.features", f"{db}.totals", pop, hist, since=WINDOW_A[2])
    return spark.table(f"{db}.features")


def append_partitioned(spark, sf_dir):
    t = _scratch_db(spark, "append_part") + ".t"
    tb.create_table(_window(spark, sf_dir, WINDOW_A), t, partition_by="date")
    tb.append_by_name(_window(spark, sf_dir, WINDOW_B), t)
    return spark.table(t)


def path_overwrite(spark, sf_dir):
    path = shared_dir(spark, "path_overwrite")
    tb.overwrite_path(read_parquet(spark, fx.table_path(sf_dir, "nation")), path)
    tb.overwrite_path(_customer(spark, sf_dir), path)
    return read_path(spark, path)


def path_append_registered(spark, sf_dir):
    db = _scratch_db(spark, "path_append")
    path = shared_dir(spark, "path_append_files")
    tb.append_path(_customer(spark, sf_dir), path, f"{db}.t")
    tb.append_path(_customer(spark, sf_dir), path, f"{db}.t")
    return spark.table(f"{db}.t")


def external_save_as_table(spark, sf_dir):
    db = _scratch_db(spark, "external")
    path = shared_dir(spark, "external_files")
    tb.save_external(read_parquet(spark, fx.table_path(sf_dir, "nation")), f"{db}.t", path)
    tb.save_external(_customer(spark, sf_dir), f"{db}.t", path)
    return read_path(spark, path).unionByName(spark.table(f"{db}.t"))


def register_location(spark, sf_dir):
    db = _scratch_db(spark, "register")
    path = shared_dir(spark, "register_files")
    tb.overwrite_path(_window(spark, sf_dir, WINDOW_A), path, partition_by="date")
    cat.register_location(spark, f"{db}.t", path)
    cat.register_location(spark, f"{db}.t", path)  # second call is a no-op
    return spark.table(f"{db}.t")


def database_lifecycle(spark, sf_dir):
    before = cat.current_database(spark)
    db = _scratch_db(spark, "lifecycle")
    cat.create_database(spark, db)  # again: IF NOT EXISTS makes it a no-op
    if cat.current_database(spark) != before:
        raise AssertionError("creating a database must not switch to it")
    t = f"{db}.t"
    cat.drop_table(spark, t)
    tb.create_table(_customer(spark, sf_dir), t)
    if not cat.table_exists(spark, t):
        raise AssertionError("table missing after create")
    cat.drop_table(spark, t)
    if cat.table_exists(spark, t):
        raise AssertionError("table present after drop")
    tb.create_table(_customer(spark, sf_dir), t)
    return spark.table(t)


# -- jobs -------------------------------------------------------------------------


def reload_job(spark, sf_dir):
    db = _scratch_db(spark, "reload")
    jobs.reload_table(spark, fx.table_path(sf_dir, "customer"), db, "t")
    return jobs.reload_table(spark, fx.table_path(sf_dir, "customer"), db, "t")


def path_table_job(spark, sf_dir):
    name = f"dbk_pathjob_{uuid.uuid4().hex[:10]}"
    return jobs.path_table(spark, fx.table_path(sf_dir, "customer"), name, "t", shared_dir(spark, name))


def external_table_job(spark, sf_dir):
    name = f"dbk_extjob_{uuid.uuid4().hex[:10]}"
    by_path, by_name = jobs.external_table(
        spark, fx.table_path(sf_dir, "customer"), name, "t", shared_dir(spark, name + "_files")
    )
    return by_path.unionByName(by_name)


def register_job(spark, sf_dir):
    path = shared_dir(spark, "register_job_files")
    tb.overwrite_path(_window(spark, sf_dir, WINDOW_A), path, partition_by="date")
    name = f"dbk_regjob_{uuid.uuid4().hex[:10]}"
    current = jobs.register_existing(spark, name, shared_dir(spark, name), "t", path)
    if current == name:
        raise AssertionError("register job switched the current database")
    return spark.table(f"{name}.t")


def inspect_job(spark, sf_dir):
    t = _scratch_db(spark, "inspect") + ".t"
    tb.create_table(_customer(spark, sf_dir), t)
    by_api, by_sql = jobs.inspect_table(spark, t)
    return _looks(spark.table(t), api=by_api, sql=by_sql)


def daily_publish_merge(spark, sf_dir):
    db = _scratch_db(spark, "daily")
    pop, hist = fx.population(spark, sf_dir), fx.history(spark, sf_dir)
    for start, end, since in (WINDOW_A, WINDOW_B):
        jobs.daily_publish_merge(spark, start, end, f"{db}.pub", f"{db}.copy", pop, hist, since=since)
    return spark.table(f"{db}.copy")


def compute_replace(spark, sf_dir):
    db = _scratch_db(spark, "replace_job")
    pop, hist = fx.population(spark, sf_dir), fx.history(spark, sf_dir)
    for start, end, since in (WINDOW_A, WINDOW_B):
        jobs.compute_replace(spark, start, end, f"{db}.t", pop, hist, since=since)
    return spark.table(f"{db}.t")


QUERIES: dict[str, Query] = {
    "pit_features": pit_features,
    "pit_features_dup_population": pit_features_dup_population,
    "pit_features_prefix_sum": pit_features_prefix_sum,
    "pit_features_range_join": pit_features_range_join,
    "pit_features_direct": pit_features_direct,
    "pit_features_one_day": pit_features_one_day,
    "pit_features_selected": pit_features_selected,
    "pit_features_corrected": pit_features_corrected,
    "pit_features_chunked": pit_features_chunked,
    "pit_features_instants": pit_features_instants,
    "daily_totals_runs": daily_totals_runs,
    "replace_three_part_name": replace_three_part_name,
    "replace_external": replace_external,
    "merge_unpartitioned_three_part": merge_unpartitioned_three_part,
    "merge_bucketed": merge_bucketed,
    "path_text_partition": path_text_partition,
    "features_positive_only": features_positive_only,
    "scan_parquet_project": scan_parquet_project,
    "scan_table": scan_table,
    "scan_sql": scan_sql,
    "scan_path": scan_path,
    "date_range_half_open": date_range_half_open,
    "filter_unselected_column": filter_unselected_column,
    "json_answer_extract": json_answer_extract,
    "json_code_flags": json_code_flags,
    "outcome_one_hot": outcome_one_hot,
    "pit_join_rows": pit_join_rows,
    "population_left_join": population_left_join_query,
    "group_count_sum_avg": group_count_sum_avg,
    "fill_zero": fill_zero_query,
    "preview_ordered": preview_ordered,
    "limit_rows_only": limit_rows_only,
    "create_only": create_only,
    "append_by_name": append_by_name,
    "create_or_replace": create_or_replace,
    "create_or_replace_partitioned": create_or_replace_partitioned,
    "dynamic_partition_overwrite": dynamic_partition_overwrite,
    "publish_first_run": publish_first_run,
    "publish_second_run": publish_second_run,
    "ctas_if_not_exists": ctas_if_not_exists,
    "merge_update_insert": merge_update_insert,
    "merge_first_run_noop": merge_first_run_noop,
    "merge_key_without_partition": merge_key_without_partition,
    "merge_string_partition": merge_string_partition,
    "append_partitioned": append_partitioned,
    "path_append_partitioned": path_append_partitioned,
    "external_partitioned_replace": external_partitioned_replace,
    "path_overwrite": path_overwrite,
    "path_append_registered": path_append_registered,
    "external_save_as_table": external_save_as_table,
    "register_location": register_location,
    "database_lifecycle": database_lifecycle,
    "reload_job": reload_job,
    "path_table_job": path_table_job,
    "external_table_job": external_table_job,
    "register_job": register_job,
    "inspect_job": inspect_job,
    "daily_publish_merge": daily_publish_merge,
    "compute_replace": compute_replace,
}
