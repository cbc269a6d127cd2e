"""Table writes and catalog operations in a fresh database per test."""

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daybook.operators import catalog as cat
from daybook.operators import tables as tb
from daybook.sources import read_parquet, read_path, read_sql, read_table

D = dt.date


def _frame(spark, rows):
    return spark.createDataFrame(rows, "client_id bigint, n bigint, date date")


def _rows(df, cols=("date", "client_id", "n")):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_create_only_then_error(spark, db):
    df = _frame(spark, [(1, 10, D(2024, 1, 1))])
    tb.create_table(df, f"{db}.t")
    assert _rows(spark.table(f"{db}.t")) == [(D(2024, 1, 1), 1, 10)]
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        tb.create_table(df, f"{db}.t")


def test_append_matches_by_name_with_partitioned_table(spark, db):
    tb.create_table(_frame(spark, [(1, 10, D(2024, 1, 1))]), f"{db}.t", partition_by="date")
    assert spark.table(f"{db}.t").columns[-1] == "date"  # partition column moved last
    tb.append_by_name(_frame(spark, [(2, 20, D(2024, 1, 2))]).select("date", "n", "client_id"), f"{db}.t")
    assert _rows(spark.table(f"{db}.t")) == [(D(2024, 1, 1), 1, 10), (D(2024, 1, 2), 2, 20)]
    with pytest.raises(ValueError):
        tb.append_by_name(_frame(spark, [(3, 30, D(2024, 1, 3))]).drop("n"), f"{db}.t")


def test_dynamic_overwrite_keeps_other_partitions(spark, db):
    t = f"{db}.t"
    tb.create_or_replace(_frame(spark, [(1, 1, D(2024, 1, 1)), (2, 2, D(2024, 1, 2))]), t, partition_by="date")
    tb.overwrite_partitions(_frame(spark, [(9, 9, D(2024, 1, 2)), (3, 3, D(2024, 1, 3))]), t)
    assert _rows(spark.table(t)) == [(D(2024, 1, 1), 1, 1), (D(2024, 1, 2), 9, 9), (D(2024, 1, 3), 3, 3)]
    tb.overwrite_partitions(_frame(spark, []), t)  # empty input: no-op
    assert spark.table(t).count() == 3
    assert spark.conf.get(tb.OVERWRITE_MODE).lower() == "static"  # scoped conf restored


def test_replace_partitioned_replaces_everything(spark, db):
    t = f"{db}.t"
    tb.create_or_replace(_frame(spark, [(1, 1, D(2024, 1, 1))]), t, partition_by="date")
    tb.create_or_replace(_frame(spark, [(2, 2, D(2024, 1, 2))]), t, partition_by="date")
    assert _rows(spark.table(t)) == [(D(2024, 1, 2), 2, 2)]


def test_publish_twice_equals_once(spark, db):
    df = _frame(spark, [(1, 1, D(2024, 1, 1)), (2, 2, D(2024, 1, 2))])
    assert tb.publish(df, f"{db}.a") == "create"
    assert tb.publish(df, f"{db}.a") == "overwrite"
    tb.publish(df, f"{db}.b")
    assert _rows(spark.table(f"{db}.a")) == _rows(spark.table(f"{db}.b"))
    assert [c.name for c in spark.catalog.listColumns(f"{db}.a") if c.isPartition] == ["date"]


def test_ctas_if_absent_is_noop_on_rerun(spark, db):
    tb.create_table(_frame(spark, [(1, 1, D(2024, 1, 1))]), f"{db}.a")
    tb.create_table(_frame(spark, [(2, 2, D(2024, 1, 2))]), f"{db}.b")
    tb.create_table_as_select_if_absent(spark, f"{db}.c", f"{db}.a", partition_by="date")
    tb.create_table_as_select_if_absent(spark, f"{db}.c", f"{db}.b", partition_by="date")
    assert _rows(spark.table(f"{db}.c")) == [(D(2024, 1, 1), 1, 1)]


def test_path_append_registers_and_refreshes(spark, db, scratch):
    path = scratch("append")
    df = _frame(spark, [(1, 1, D(2024, 1, 1)), (2, 2, D(2024, 1, 2))])
    tb.append_path(df, path, f"{db}.t")
    assert spark.table(f"{db}.t").count() == 2
    tb.append_path(df, path, f"{db}.t")
    assert spark.table(f"{db}.t").count() == 4
    assert read_path(spark, path).count() == 4


def test_external_table_by_path_and_name_and_drop_keeps_files(spark, db, scratch):
    path = scratch("ext")
    tb.save_external(_frame(spark, [(1, 1, D(2024, 1, 1))]), f"{db}.t", path)
    tb.save_external(_frame(spark, [(2, 2, D(2024, 1, 2))]), f"{db}.t", path)
    assert _rows(read_path(spark, path)) == [(D(2024, 1, 2), 2, 2)]
    assert _rows(read_sql(spark, f"{db}.t")) == [(D(2024, 1, 2), 2, 2)]
    cat.drop_table(spark, f"{db}.t")
    assert not cat.table_exists(spark, f"{db}.t")
    assert read_path(spark, path).count() == 1


def test_register_partitioned_location_repairs_partitions(spark, db, scratch):
    path = scratch("reg")
    tb.overwrite_path(_frame(spark, [(1, 1, D(2024, 1, 1)), (2, 2, D(2024, 1, 2))]), path, partition_by="date")
    cat.register_location(spark, f"{db}.t", path)
    assert _rows(read_table(spark, f"{db}.t")) == [(D(2024, 1, 1), 1, 1), (D(2024, 1, 2), 2, 2)]
    assert dict(spark.table(f"{db}.t").dtypes)["date"] == "date"


def test_register_empty_location_fails(spark, db, scratch):
    path = scratch("empty")
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with pytest.raises(AnalysisException, match="UNABLE_TO_INFER_SCHEMA"):
        cat.register_location(spark, f"{db}.t", path)


def test_missing_parquet_path_fails(spark, scratch):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_parquet(spark, scratch("missing") + "/nothing.parquet").schema


def test_database_lifecycle(spark, scratch):
    import uuid

    name = f"t_{uuid.uuid4().hex[:10]}"
    before = cat.current_database(spark)
    cat.create_database(spark, name, location=scratch(name))
    cat.create_database(spark, name)  # IF NOT EXISTS: no error
    assert cat.current_database(spark) == before
    with pytest.raises(AnalysisException, match="SCHEMA_ALREADY_EXISTS"):
        cat.create_schema(spark, name)
    cat.drop_table(spark, f"{name}.absent")  # IF EXISTS: no error
    assert not cat.table_exists(spark, f"{name}.absent")


def test_malformed_date_literal_raises(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),)], "date date")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.where(F.col("date") >= F.lit("2024-13-45")).collect()


def test_partition_columns_and_odd_names(spark, db):
    df = spark.createDataFrame([(1, D(2024, 1, 1), "a b")], "client_id bigint, date date, `odd col` string")
    tb.create_or_replace(df, f"{db}.p", partition_by=["date", "odd col"])
    tb.create_or_replace(df, f"{db}.u")
    assert cat.partition_columns(spark, f"{db}.p") == ["date", "odd col"]
    assert cat.partition_columns(spark, f"{db}.u") == []
    tb.overwrite_partitions(df.selectExpr("client_id + 1 AS client_id", "date", "`odd col`"), f"{db}.p")
    assert [r.client_id for r in spark.table(f"{db}.p").collect()] == [2]


def test_failed_replace_keeps_old_table(spark, db):
    t = f"{db}.t"
    tb.create_or_replace(_frame(spark, [(1, 1, D(2024, 1, 1))]), t)
    boom = _frame(spark, [(2, 2, D(2024, 1, 2))]).selectExpr(
        "client_id", "CAST(raise_error('boom') AS BIGINT) AS n", "date")
    with pytest.raises(Exception, match="boom"):
        tb.create_or_replace(boom, t)
    assert _rows(spark.table(t)) == [(D(2024, 1, 1), 1, 1)]


def test_replace_from_itself(spark, db):
    t = f"{db}.t"
    tb.create_or_replace(_frame(spark, [(1, 1, D(2024, 1, 1))]), t, partition_by="date")
    tb.create_or_replace(spark.table(t).selectExpr("client_id", "n + 1 AS n", "date"), t, partition_by="date")
    assert _rows(spark.table(t)) == [(D(2024, 1, 1), 1, 2)]


def test_path_overwrite_stays_static_under_dynamic_session_mode(spark, scratch):
    path = scratch("static")
    tb.overwrite_path(_frame(spark, [(1, 1, D(2024, 1, 1)), (2, 2, D(2024, 1, 2))]), path, partition_by="date")
    with tb.session_conf(spark, tb.OVERWRITE_MODE, "dynamic"):
        tb.overwrite_path(_frame(spark, [(3, 3, D(2024, 1, 2))]), path, partition_by="date")
    assert _rows(read_path(spark, path)) == [(D(2024, 1, 2), 3, 3)]


BROKEN = "CAST(raise_error('broken') AS BIGINT)"


def test_failing_final_write_keeps_the_old_table(spark, db, scratch):
    t, path = f"{db}.t", scratch("kept")
    old, bad = spark.range(5), spark.range(3).selectExpr(f"CASE WHEN id = 2 THEN {BROKEN} ELSE id END AS id")
    tb.create_table(old, t)
    tb.overwrite_path(old, path)
    for write in (lambda: tb.create_or_replace(bad, t), lambda: tb.replace_rows(bad, t)):
        with pytest.raises(Exception):
            write()
        assert spark.table(t).count() == 5
    for write in (lambda: tb.overwrite_path(bad, path), lambda: tb.save_external(bad, f"{db}.e", path)):
        with pytest.raises(Exception):
            write()
        assert spark.read.parquet(path).count() == 5
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect() if not r.isTemporary] == ["t"]


def test_append_writes_a_file_per_partition_and_not_per_task(spark, db):
    t = f"{db}.t"
    rows = spark.range(0, 4000, 1, 8).selectExpr("id", "CAST(id % 20 AS INT) AS p")
    tb.create_table(rows, t, partition_by="p")
    before = len(spark.table(t).inputFiles())
    tb.append_by_name(rows, t)
    assert len(spark.table(t).inputFiles()) - before == 20


def test_append_to_another_layout_is_refused(spark, db, scratch):
    path = scratch("layout")
    rows = spark.range(6).selectExpr("id", "CAST(id % 2 AS INT) AS p")
    tb.append_path(rows, path, partition_by="p")
    with pytest.raises(ValueError):
        tb.append_path(rows, path, partition_by="id")
    tb.append_path(rows, path, f"{db}.t")
    assert spark.table(f"{db}.t").count() == 12


def test_publish_refuses_an_unpartitioned_table(spark, db):
    tb.create_table(spark.range(3), f"{db}.t")
    with pytest.raises(ValueError):
        tb.publish(spark.range(2), f"{db}.t")


# -- replace and publish never lose a table or a partition ---------------------------


def _names(spark, db):
    return [f"{db}.t", f"spark_catalog.{db}.t", f"`{db}`.`t`", f"spark_catalog.`{db}`.`t`"]


@pytest.mark.parametrize("which", range(4))
@pytest.mark.parametrize("parts", [None, "date"])
def test_replace_twice_by_any_name(spark, db, which, parts):
    t = _names(spark, db)[which]
    for n in (1, 2, 3):
        tb.create_or_replace(_frame(spark, [(n, n, D(2024, 1, n)), (9, n, D(2024, 1, 9))]), t, partition_by=parts)
        assert _rows(spark.table(t)) == [(D(2024, 1, n), n, n), (D(2024, 1, 9), 9, n)]
    tb.create_or_replace(spark.range(3), t)  # another schema
    assert spark.table(t).columns == ["id"] and spark.table(t).count() == 3
    tb.replace_rows(spark.table(t).where("id > 0"), t)
    assert spark.table(t).count() == 2
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect() if not r.isTemporary] == ["t"]


def test_replace_in_the_current_database_by_one_name(spark, db):
    before = cat.current_database(spark)
    spark.catalog.setCurrentDatabase(db)
    try:
        tb.create_or_replace(spark.range(3), "t")
        tb.create_or_replace(spark.range(5), "t")
        tb.create_or_replace(spark.range(2).selectExpr("id AS other"), "t")
        assert spark.table("t").columns == ["other"]
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_odd_table_names(spark, db):
    t = f"spark_catalog.{db}.`_odd_name`"
    tb.create_or_replace(spark.range(3), t)
    tb.create_or_replace(spark.range(4), t)
    tb.create_or_replace(spark.range(5).selectExpr("id AS n"), t)
    assert spark.table(t).count() == 5
    assert cat.name_parts("a.`b.c`.`d``e`") == ["a", "b.c", "d`e"]


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("parts", [None, "date"])
def test_table_is_there_at_every_step_of_a_replace(spark, db, scratch, monkeypatch, external, parts):
    t, path = f"{db}.t", scratch("ext")
    old, new = [(i, 1, D(2024, 1, i)) for i in (1, 2)], [(i, 2, D(2024, 1, i)) for i in (1, 2)]
    if external:
        tb.save_external(_frame(spark, old), t, path, partition_by=parts)
    else:
        tb.create_or_replace(_frame(spark, old), t, partition_by=parts)
    seen = []

    def look(f):
        def call(*args, **kw):
            seen.append(_rows(spark.table(t)))
            return f(*args, **kw)

        return call

    monkeypatch.setattr(cat, "CALLS_AT_ONCE", 1)
    for name in ("set_location", "delete_path"):
        monkeypatch.setattr(cat, name, look(getattr(cat, name)))
        monkeypatch.setattr(tb, name, look(getattr(tb, name)))
    tb.create_or_replace(_frame(spark, new), t, partition_by=parts)
    assert len(seen) >= 2
    for rows in seen:  # every partition old or new, none absent; without partitions all old or all new
        assert [r[:2] for r in rows] == [(D(2024, 1, i), i) for i in (1, 2)]
        assert parts or len({r[2] for r in rows}) == 1
    assert {r[2] for r in _rows(spark.table(t))} == {2}
    info = cat.table_info(spark, t)
    assert info["Type"] == ("EXTERNAL" if external else "MANAGED")
    if external:
        assert info["Location"].rstrip("/").endswith(path.split(":")[-1])
        assert _rows(read_path(spark, path)) == _rows(spark.table(t))


def test_external_table_of_another_schema_stays_external(spark, db, scratch):
    t, path = f"spark_catalog.{db}.t", scratch("ext")
    tb.save_external(spark.range(3), f"{db}.t", path)
    tb.create_or_replace(_frame(spark, [(1, 1, D(2024, 1, 1))]), t, partition_by="date")
    assert cat.table_info(spark, t)["Type"] == "EXTERNAL"
    assert _rows(spark.table(t)) == [(D(2024, 1, 1), 1, 1)]
    assert read_path(spark, path).count() == 1


@pytest.mark.parametrize("parts", [None, "date"])
def test_failing_rename_gives_the_old_table_back(spark, db, monkeypatch, parts):
    from pyspark.sql import SparkSession

    t = f"spark_catalog.{db}.t"
    rows = [(1, 1, D(2024, 1, 1)), (2, 2, D(2024, 1, 2))]
    tb.create_or_replace(_frame(spark, rows), t, partition_by=parts)
    if parts:
        tb.overwrite_partitions(_frame(spark, [(1, 5, D(2024, 1, 1))]), t)
    before, run = _rows(spark.table(t)), SparkSession.sql

    def sql(self, text, *args, **kw):
        if "__new_" in text and "RENAME TO" in text:
            raise RuntimeError("no rename")
        return run(self, text, *args, **kw)

    monkeypatch.setattr(SparkSession, "sql", sql)
    with pytest.raises(RuntimeError):
        tb.create_or_replace(spark.range(3), t)
    monkeypatch.undo()
    spark.catalog.refreshTable(t)
    assert _rows(spark.table(t)) == before
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect() if not r.isTemporary] == ["t"]
    tb.create_or_replace(spark.range(3), t)
    assert spark.table(t).count() == 3


def test_publish_stopped_half_way_leaves_each_partition_old_or_new(spark, db, monkeypatch):
    t = f"{db}.t"
    days = [D(2024, 1, i) for i in range(1, 6)]
    tb.publish(_frame(spark, [(1, 1, d) for d in days]), t)
    new = _frame(spark, [(1, 2, d) for d in [*days, D(2024, 1, 9)]])
    swap, calls = cat.set_location, []

    def stop(*args, **kw):
        calls.append(1)
        if len(calls) > 2:
            raise RuntimeError("driver lost")
        return swap(*args, **kw)

    monkeypatch.setattr(cat, "CALLS_AT_ONCE", 1)
    monkeypatch.setattr(cat, "set_location", stop)
    with pytest.raises(RuntimeError):
        tb.publish(new, t)
    monkeypatch.undo()
    spark.catalog.refreshTable(t)
    rows = _rows(spark.table(t))
    assert [r[0] for r in rows] == days and sorted(r[2] for r in rows) == [1, 1, 1, 2, 2]
    tb.publish(new, t)  # again, to the end
    assert _rows(spark.table(t)) == [(d, 1, 2) for d in [*days, D(2024, 1, 9)]]


def test_overwrite_leaves_no_old_files(spark, db):
    t = f"{db}.t"
    tb.publish(_frame(spark, [(1, 0, D(2024, 1, i)) for i in (1, 2, 3)]), t)
    for n in (1, 2, 3):
        tb.publish(_frame(spark, [(1, n, D(2024, 1, i)) for i in range(1, n + 1)]), t)
    tb.append_by_name(_frame(spark, [(2, 7, D(2024, 1, 1))]), t)  # goes to the partition's place
    assert _rows(spark.table(t)) == [(D(2024, 1, 1), 1, 3), (D(2024, 1, 1), 2, 7), (D(2024, 1, 2), 1, 3), (D(2024, 1, 3), 1, 3)]
    root = cat.table_info(spark, t)["Location"].replace("file:", "")
    files = [f for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
    assert len(files) == len(spark.table(t).inputFiles()) == 4
    assert len([d for d in os.listdir(root) if d.startswith(tb.SWAP)]) == 1


def test_overwrite_of_odd_partition_values(spark, db):
    t = f"{db}.t"
    rows = spark.createDataFrame([(1, "a b/c:d%", 1), (2, "é=x'y\\", 2), (3, None, 3), (4, "", 4)], "id long, s string, p int")
    tb.create_or_replace(rows, t, partition_by=["s", "p"])
    tb.overwrite_partitions(rows.selectExpr("id + 10 AS id", "s", "p"), t)
    assert sorted(r.id for r in spark.table(t).collect()) == [11, 12, 13, 14]
    tb.create_or_replace(rows.where("id > 1"), t, partition_by=["s", "p"])
    assert sorted((r.id, r.s) for r in spark.table(t).collect() if r.s) == [(2, "é=x'y\\")]
    assert sorted(r.id for r in spark.table(t).collect()) == [2, 3, 4]
    cat.drop_table(spark, t)
    tb.create_or_replace(spark.range(1), t)  # its name and folder are free again


# -- paths ---------------------------------------------------------------------------


def test_append_registers_only_what_it_wrote(spark, db, scratch, monkeypatch):
    from pyspark.sql import SparkSession

    t, path = f"{db}.t", scratch("many")
    rows = spark.range(0, 1000, 1, 4).selectExpr("id", "CAST(id AS INT) AS p")
    tb.append_path(rows, path, t, partition_by="p")
    assert len(cat.partition_names(spark, t)) == 1000
    texts, run = [], SparkSession.sql
    monkeypatch.setattr(SparkSession, "sql", lambda self, text, *a, **k: (texts.append(text), run(self, text, *a, **k))[1])
    tb.append_path(spark.createDataFrame([(1, 5), (2, 1000), (3, 1001), (4, None)], "id long, p int"), path, t)
    monkeypatch.undo()
    assert not [x for x in texts if "MSCK" in x]
    added = [x for x in texts if " ADD IF NOT EXISTS " in x]
    assert len(added) == 1 and added[0].count("PARTITION (") == 4
    assert spark.table(t).count() == 1004
    assert len(cat.partition_names(spark, t)) == 1003


def test_text_partitions_come_back_as_text(spark, db, scratch):
    path = scratch("text")
    df = spark.createDataFrame([(1, "2024-01-01", "007"), (2, "2024-01-02", "1.0")], "id long, date string, code string")
    tb.overwrite_path(df, path, partition_by=["date", "code"])
    tb.append_path(df.selectExpr("id + 2 AS id", "date", "code"), path, f"{db}.t")
    for back in (read_path(spark, path), spark.table(f"{db}.t")):
        assert dict(back.dtypes) == dict(df.dtypes)
        assert sorted((r.id, r.date, r.code) for r in back.collect()) == [
            (1, "2024-01-01", "007"), (2, "2024-01-02", "1.0"), (3, "2024-01-01", "007"), (4, "2024-01-02", "1.0"),
        ]
    tb.overwrite_path(df.selectExpr("id", "CAST(date AS DATE) AS date"), path, partition_by="date")
    assert dict(read_path(spark, path).dtypes)["date"] == "date"
