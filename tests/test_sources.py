"""Scans, previews and limits."""

from pyspark.sql import functions as F

from daybook.plans import fixtures as fx
from daybook.sources import limit_rows, preview, read_parquet, read_path, read_sql, read_table, register_view

from .conftest import SF_SMALL


def test_scans_agree(spark):
    path = fx.table_path(SF_SMALL, "customer")
    by_file = read_parquet(spark, path)
    view = register_view(by_file, "t_src_customer")
    for df in (read_path(spark, path), read_table(spark, view), read_sql(spark, view)):
        assert df.schema == by_file.schema
        assert sorted(df.collect()) == sorted(by_file.collect())


def test_projection_prunes_scan_columns(spark):
    df = read_parquet(spark, fx.table_path(SF_SMALL, "customer")).select("c_custkey", "c_name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan


def test_preview_ordered_is_deterministic_top_n(spark):
    df = read_parquet(spark, fx.table_path(SF_SMALL, "customer"))
    got = [r.c_custkey for r in preview(df, 7, order_by=[F.col("c_custkey").desc()]).collect()]
    assert got == sorted((r.c_custkey for r in df.collect()), reverse=True)[:7]


def test_limits(spark):
    df = read_parquet(spark, fx.table_path(SF_SMALL, "nation"))
    view = register_view(df, "t_src_nation")
    assert limit_rows(df, 5).count() == 5
    assert read_sql(spark, view, limit=10).count() == 10
    assert limit_rows(df, 1000).count() == df.count()
