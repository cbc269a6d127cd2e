"""Merge (upsert) semantics on partitioned and unpartitioned Parquet tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.operators import merge
from daybook.operators import tables as tb
from daybook.operators.catalog import table_info
from daybook.operators.merge import MergeCardinalityError, merge_into

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
SCHEMA = "date date, client_id bigint, n bigint, z string"


def _rows(df):
    return sorted((tuple(r) for r in df.select("date", "client_id", "n", "z").collect()), key=str)


def _target(spark, db, rows, partitioned=True):
    t = f"{db}.t"
    tb.create_or_replace(spark.createDataFrame(rows, SCHEMA), t, partition_by="date" if partitioned else None)
    return t


@pytest.mark.parametrize("partitioned", [True, False])
def test_merge_golden(spark, db, partitioned):
    t = _target(spark, db, [(D1, 1, 10, "keep"), (D1, 2, 20, "keep"), (D2, None, 5, "k")], partitioned)
    src = spark.createDataFrame([(D1, 1, 11, "new"), (D3, 7, 70, "new"), (D2, None, 6, "k2")], SCHEMA)
    merge_into(src, t, keys=("date", "client_id"), update_cols=("n",))
    assert _rows(spark.table(t)) == sorted([
        (D1, 1, 11, "keep"),
        (D1, 2, 20, "keep"),
        (D3, 7, 70, "new"),
        (D2, None, 5, "k"),
        (D2, None, 6, "k2"),
    ], key=str)


def test_merge_twice_equals_once_for_non_null_keys(spark, db):
    t = _target(spark, db, [(D1, 1, 10, "a")])
    src = spark.createDataFrame([(D1, 1, 11, "b"), (D2, 2, 20, "b")], SCHEMA)
    merge_into(src, t, update_cols=("n",))
    once = _rows(spark.table(t))
    merge_into(src, t, update_cols=("n",))
    assert _rows(spark.table(t)) == once == sorted([(D1, 1, 11, "a"), (D2, 2, 20, "b")], key=str)


def test_null_key_source_row_is_inserted_each_run(spark, db):
    t = _target(spark, db, [(D1, 1, 10, "a")])
    src = spark.createDataFrame([(D1, None, 1, "n")], SCHEMA)
    merge_into(src, t, update_cols=("n",))
    merge_into(src, t, update_cols=("n",))
    assert spark.table(t).where("client_id IS NULL").count() == 2


def test_null_partition_value_keeps_existing_rows(spark, db):
    t = _target(spark, db, [(None, 1, 10, "old"), (D1, 2, 20, "x")])
    src = spark.createDataFrame([(None, 3, 30, "new")], SCHEMA)
    merge_into(src, t, update_cols=("n",))
    assert _rows(spark.table(t)) == sorted([(None, 1, 10, "old"), (None, 3, 30, "new"), (D1, 2, 20, "x")], key=str)


def test_target_row_matching_two_source_rows_raises(spark, db):
    t = _target(spark, db, [(D1, 1, 10, "a")])
    src = spark.createDataFrame([(D1, 1, 11, "b"), (D1, 1, 12, "c")], SCHEMA)
    with pytest.raises(MergeCardinalityError):
        merge_into(src, t, update_cols=("n",))
    assert _rows(spark.table(t)) == [(D1, 1, 10, "a")]


def test_duplicate_unmatched_source_keys_are_all_inserted(spark, db):
    t = _target(spark, db, [(D1, 1, 10, "a")])
    src = spark.createDataFrame([(D2, 5, 1, "x"), (D2, 5, 2, "y")], SCHEMA)
    merge_into(src, t, update_cols=("n",))
    assert spark.table(t).where("client_id = 5").count() == 2


def test_untouched_partitions_are_not_rewritten(spark, db):
    t = _target(spark, db, [(D1, 1, 10, "a"), (D2, 2, 20, "b")])
    before = set(spark.table(t).where(f"date = DATE'{D1}'").inputFiles())
    merge_into(spark.createDataFrame([(D2, 2, 21, "c")], SCHEMA), t, update_cols=("n",))
    assert set(spark.table(t).where(f"date = DATE'{D1}'").inputFiles()) == before
    assert _rows(spark.table(t)) == sorted([(D1, 1, 10, "a"), (D2, 2, 21, "b")], key=str)


def test_hot_duplicated_target_key_is_updated_row_by_row(spark, db):
    """Many target rows share (date, 0), as NULL clients do after the zero fill."""
    from pyspark.sql import functions as F

    t = f"{db}.t"
    hot = spark.range(6000).select(
        F.lit(D1).alias("date"), F.lit(0).cast("bigint").alias("client_id"), F.col("id").alias("n"),
        F.lit("z").alias("z"),
    )
    tb.create_or_replace(hot.union(spark.createDataFrame([(D2, 5, 1, "q")], SCHEMA)), t, partition_by="date")
    src = spark.createDataFrame([(D1, 0, 99, "new"), (D1, 3, 30, "new")], SCHEMA)
    merge_into(src, t, update_cols=("n",))
    out = spark.table(t)
    assert out.where("client_id = 0 AND n = 99 AND z = 'z'").count() == 6000
    assert out.where("client_id = 3").count() == 1 and out.where("client_id = 5").count() == 1
    assert out.count() == 6002



def test_merge_touching_many_partitions(spark, db):
    """A source spanning hundreds of dates: the touched-partition filter is one
    SQL expression, results as for any merge."""
    import time

    from pyspark.sql import functions as F

    t = f"{db}.t"
    days = spark.range(400).select(
        F.date_add(F.lit(D1), F.col("id").cast("int")).alias("date"), F.col("id").alias("client_id"),
        F.col("id").alias("n"), F.lit("old").alias("z"),
    )
    tb.create_or_replace(days, t, partition_by="date")
    src = days.where("client_id % 2 = 0").selectExpr("date", "client_id", "n + 1000 AS n", "'src' AS z")
    t0 = time.perf_counter()
    merge_into(src, t, update_cols=("n",))
    assert time.perf_counter() - t0 < 120
    out = spark.table(t)
    assert out.count() == 400
    assert out.where("client_id % 2 = 0 AND n = client_id + 1000 AND z = 'old'").count() == 200
    assert out.where("client_id % 2 = 1 AND n = client_id").count() == 200


def test_unchanged_merge_keeps_every_file(spark, db):
    t = f"{db}.t"
    days = spark.range(40).selectExpr("date_add(DATE'2024-01-01', CAST(id % 8 AS INT)) AS date", "id AS client_id", "id AS n")
    tb.create_table(days, t, partition_by="date")
    before = sorted(spark.table(t).inputFiles())
    merge_into(days, t, update_cols=("n",))
    assert sorted(spark.table(t).inputFiles()) == before
    merge_into(days.where("client_id = 3").withColumn("n", F.lit(-1).cast("long")), t, update_cols=("n",))
    after = set(spark.table(t).inputFiles())
    assert len(set(before) - after) == 1  # one partition was rewritten
    assert spark.table(t).where("n = -1").count() == 1 and spark.table(t).count() == 40
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect() if not r.isTemporary] == ["t"]  # no staging left


def test_timestamp_partition_with_another_session_zone(spark, db):
    t = f"{db}.t"
    rows = "SELECT TIMESTAMP'2024-01-01 05:00:00' AS date, id AS client_id, id AS n FROM range(3)"
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        tb.create_table(spark.sql(rows), t, partition_by="date")
        merge_into(spark.sql(rows).where("client_id = 1").withColumn("n", F.lit(9).cast("long")), t, update_cols=("n",))
        assert sorted(tuple(r) for r in spark.table(t).select("client_id", "n").collect()) == [(0, 0), (1, 9), (2, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_decimal_and_quoted_text_partitions(spark, db):
    t = f"{db}.t"
    rows = spark.range(30).selectExpr(
        "CAST(id % 5 AS DECIMAL(10,2)) AS d", 'concat("a\'", id % 3) AS s', "id AS k", "id AS n"
    )
    tb.create_table(rows, t, partition_by=["d", "s"])
    merge_into(rows.where("k % 2 = 0").withColumn("n", F.col("n") + 100), t, keys=("d", "s", "k"), update_cols=("n",))
    out = spark.table(t)
    assert out.count() == 30 and out.where("n = k + 100").count() == 15


def test_letter_case_and_partition_updates(spark, db):
    t = f"{db}.t"
    tb.create_table(spark.range(3).selectExpr("DATE'2024-01-01' AS date", "id AS client_id", "id AS n"), t, partition_by="date")
    merge_into(spark.range(2, 5).selectExpr("DATE'2024-01-01' AS DATE", "id AS Client_ID", "7L AS N"), t, update_cols=("n",))
    assert sorted(tuple(r) for r in spark.table(t).select("client_id", "n").collect()) == [(0, 0), (1, 1), (2, 7), (3, 7), (4, 7)]
    with pytest.raises(ValueError):
        merge_into(spark.table(t), t, keys=("client_id",), update_cols=("date",))


def _bucketed(spark, db, rows, keys, partitioned):
    t = f"{db}.b"
    tb.create_table(spark.createDataFrame(rows, SCHEMA), t, partition_by="date" if partitioned else None, bucket_by=(4, keys))
    return t


@pytest.mark.parametrize("partitioned", [True, False])
def test_merge_into_buckets_golden(spark, db, partitioned):
    keys = ["client_id"] if partitioned else ["date", "client_id"]
    t = _bucketed(spark, db, [(D1, 1, 10, "keep"), (D1, 2, 20, "keep"), (D2, 1, 30, "keep"), (D2, None, 5, "k")], keys, partitioned)
    src = spark.createDataFrame(
        [(D1, 1, 11, "new"), (D3, 7, 70, "new"), (D3, 7, 71, "new"), (D2, None, 6, "k2"), (None, 2, 8, "k3")], SCHEMA
    )
    merge_into(src, t, keys=("date", "client_id"), update_cols=("n",))
    assert _rows(spark.table(t)) == sorted([
        (D1, 1, 11, "keep"), (D1, 2, 20, "keep"), (D2, 1, 30, "keep"), (D2, None, 5, "k"),
        (D3, 7, 70, "new"), (D3, 7, 71, "new"), (D2, None, 6, "k2"), (None, 2, 8, "k3"),
    ], key=str)
    assert table_info(spark, t)["Num Buckets"] == "4"
    twice = spark.createDataFrame([(D1, 1, 1, "x"), (D1, 1, 2, "x")], SCHEMA)
    with pytest.raises(MergeCardinalityError):
        merge_into(twice, t, keys=("date", "client_id"), update_cols=("n",))


def test_merge_into_buckets_equals_merge_into_plain(spark, db):
    days = "date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS date"
    rows = spark.range(3000).where("id % 3 <> 0").selectExpr(days, "id % 700 + 1000 * (id DIV 700) AS client_id", "id AS n", "'t' AS z")
    src = spark.range(0, 3000, 4).selectExpr(days, "id % 700 + 1000 * (id DIV 700) AS client_id", "-id AS n", "'s' AS z")
    tb.create_table(rows, f"{db}.plain", partition_by="date")
    tb.create_table(rows, f"{db}.b", partition_by="date", bucket_by=(4, ["client_id"]))
    for t in ("plain", "b"):
        merge_into(src, f"{db}.{t}", keys=("date", "client_id"), update_cols=("n",))
    assert _rows(spark.table(f"{db}.b")) == _rows(spark.table(f"{db}.plain"))
    tb.append_by_name(src.withColumn("client_id", F.col("client_id") + 10**6), f"{db}.b")
    # every row lies in a file of its own bucket, merged and appended ones alike
    placed = spark.table(f"{db}.b").selectExpr(
        "CAST(regexp_extract(_metadata.file_name, '_([0-9]+)[.]c', 1) AS INT) AS bucket", "pmod(hash(client_id), 4) AS own"
    )
    assert placed.where("bucket <> own OR bucket IS NULL").count() == 0 and placed.count() > src.count()


def _exchanges_of(tree: str, table: str) -> list[str]:
    """The exchanges that a scan of ``table`` passes under, read from the indented plan, below the nearest aggregate or join."""
    lines = tree.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line and f".{table}[" in line:
            at = depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    at = depth[j]
                    if "Join" in lines[j]:
                        break
                    if "Exchange" in lines[j]:
                        found.append(lines[j])
    return found


@pytest.mark.parametrize("buckets", [True, False])
def test_merge_probes_buckets_without_exchange(spark, db, buckets, monkeypatch):
    rows = spark.range(100).selectExpr(
        "date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS date", "id AS client_id", "id AS n", "'t' AS z"
    )
    tb.create_table(rows, f"{db}.probed", partition_by="date", bucket_by=(3, ["client_id"]) if buckets else None)
    trees = []

    def note(df):
        trees.append(df._jdf.queryExecution().executedPlan().toString())

    staged, overwrite = merge.staged, merge.overwrite_partitions
    monkeypatch.setattr(merge, "staged", lambda df, name: (note(df), staged(df, name))[1])
    monkeypatch.setattr(merge, "overwrite_partitions", lambda df, name: (note(df), overwrite(df, name))[1])
    src = rows.where("client_id < 50").withColumn("n", F.col("n") + 1)
    merge_into(src, f"{db}.probed", keys=("date", "client_id"), update_cols=("n",))
    assert len(trees) == 2
    passed = [_exchanges_of(t, "probed") for t in trees]
    assert all(".probed[" in t for t in trees)
    assert (passed == [[], []]) == buckets, "\n".join(trees)
    assert spark.table(f"{db}.probed").agg(F.sum("n")).first()[0] == sum(range(100)) + 50
