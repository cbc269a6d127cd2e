"""User-level jobs composed from the operators (the published batch jobs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import catalog as cat
from daybook.operators import tables as tb
from daybook.operators.merge import merge_into
from daybook.operators.pit import point_in_time_features, restrict_dates, running_totals, totals_day
from daybook.sources import preview, read_parquet, read_path, read_sql, read_table

HIRE = "cl_count_of_hire_v1"


def _frame(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    return spark.table(table) if isinstance(table, str) else table


def compute_features(
    spark: SparkSession,
    start: str,
    end: str,
    population: str | DataFrame,
    history: str | DataFrame,
    features: Iterable[str] | None = None,
    **options,
) -> DataFrame:
    """The feature table for ``[start, end)`` from a population table and an
    outcome history table (names or DataFrames)."""
    return point_in_time_features(
        _frame(spark, population), _frame(spark, history), start, end, features, **options
    )


def positive_preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Rows with at least one earlier hire, as shown before publishing."""
    return preview(df.where(F.col(HIRE) > 0), n)


def daily_publish_merge(
    spark: SparkSession,
    start: str,
    end: str,
    table: str,
    merge_table: str,
    population: str | DataFrame,
    history: str | DataFrame,
    *,
    merge_scope: str = "table",
    persist: bool = False,
    **options,
) -> DataFrame:
    """Compute, publish (partition overwrite or create), copy to the merge
    table if absent, then merge the published table into it (hire count
    updated on match, new rows inserted). ``merge_scope="window"`` merges
    only the partitions just published, which equals the full merge when
    earlier days were merged. With ``persist`` the features are computed
    once: the preview's few rows are taken while they are cached, then the same
    cache feeds the publish. A population with repeated rows publishes and then
    fails in the merge, which several rows of one key may not enter. Returns the preview."""
    if merge_scope not in ("table", "window"):
        raise ValueError('merge_scope must be "table" or "window"')
    df = compute_features(spark, start, end, population, history, **options)
    if persist:
        df = df.persist()
    try:
        shown = positive_preview(df)
        if persist:  # the few rows shown, so that they outlive the cache
            shown = spark.createDataFrame(shown.collect(), shown.schema)
        tb.publish(df, table, partition_by="date")
    finally:
        if persist:
            df.unpersist()
    tb.create_table_as_select_if_absent(spark, merge_table, table, partition_by="date")
    source = spark.table(table)
    if merge_scope == "window":
        source = restrict_dates(source, start, end)
    merge_into(source, merge_table, keys=("date", "client_id"), update_cols=(HIRE,))
    return shown


def daily_features(
    spark: SparkSession,
    start: str,
    end: str,
    table: str,
    totals_table: str,
    population: str | DataFrame,
    history: str | DataFrame,
    features: Iterable[str] | None = None,
    since: str | None = "2014-01-01",
) -> None:
    """One daily run on running totals: publish the features of ``[start, end)``, equal to those of the
    full computation, but read only the history since the run before.

    ``totals_table`` holds every entity's totals over the history before a day. It
    is first advanced to ``start`` (built from all history on the first run), then
    the window's own days are added for the features. A run can be repeated; a
    window before the totals' day raises ``ValueError``. A row that arrives after
    the totals have passed its date is refused: it counts in no later run. Drop the
    totals table to count such rows; the next run builds it anew. ``since`` must
    stay the same from run to run."""
    pop, hist = _frame(spark, population), _frame(spark, history)
    known = spark.catalog.tableExists(totals_table)
    carried = spark.table(totals_table) if known else None
    day = totals_day(carried) if known else None
    if day and day > start:
        raise ValueError(f"{totals_table} has passed {start}: it counts all days before {day}")
    if day != start:
        tb.create_or_replace(running_totals(hist, start, carried, since=since), totals_table)
    new_days = hist.where(f"end_date >= DATE'{start}'")
    df = point_in_time_features(pop, new_days, start, end, features, since=since, carried=spark.table(totals_table))
    tb.publish(df, table, partition_by="date")


def compute_replace(
    spark: SparkSession,
    start: str,
    end: str,
    table: str,
    population: str | DataFrame,
    history: str | DataFrame,
    **options,
) -> DataFrame:
    """Compute, then replace ``table`` (unpartitioned). Returns the preview."""
    df = compute_features(spark, start, end, population, history, **options)
    tb.create_or_replace(df, table)
    return positive_preview(df)


def reload_table(spark: SparkSession, data_file: str, database: str, table: str) -> DataFrame:
    """Parquet file -> drop old table -> ensure database -> create -> table."""
    df = read_parquet(spark, data_file)
    name = f"{database}.{table}"
    cat.drop_table(spark, name)
    cat.create_database(spark, database)
    tb.create_table(df, name)
    return read_table(spark, name)


def path_table(
    spark: SparkSession, data_file: str, database: str, table: str, warehouse_path: str
) -> DataFrame:
    """Parquet file -> database at a location -> overwrite files at
    ``<warehouse>/<table>`` -> register them -> read back by path."""
    df = read_parquet(spark, data_file)
    cat.create_database(spark, database, location=warehouse_path)
    path = f"{warehouse_path.rstrip('/')}/{table}"
    tb.overwrite_path(df, path)
    cat.register_location(spark, f"{database}.{table}", path)
    return read_path(spark, path)


def external_table(
    spark: SparkSession, data_file: str, database: str, table: str, path: str
) -> tuple[DataFrame, DataFrame]:
    """Parquet file -> new schema (must not exist) -> external table at
    ``path`` -> (read by path, read by name through SQL)."""
    df = read_parquet(spark, data_file)
    cat.create_schema(spark, database)
    name = f"{database}.{table}"
    tb.save_external(df, name, path)
    return read_path(spark, path), read_sql(spark, name)


def register_existing(
    spark: SparkSession, database: str, database_location: str, table: str, table_location: str
) -> str:
    """Ensure a database at a location, then register existing files as a
    table in it. Returns the current database (unchanged by the create)."""
    cat.create_database(spark, database, location=database_location)
    current = cat.current_database(spark)
    cat.register_location(spark, f"{database}.{table}", table_location)
    return current


def inspect_table(spark: SparkSession, name: str) -> tuple[DataFrame, DataFrame]:
    """Two looks at a table: 5 rows through the table API, 10 through SQL."""
    return preview(read_table(spark, name), 5), read_sql(spark, name, limit=10)
