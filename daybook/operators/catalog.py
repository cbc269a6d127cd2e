"""Catalog operations: databases, existence, drop, and registering files as tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession

from daybook.functions.flags import sql_ident, sql_str
from daybook.sources.readers import kept_schema

# The folder name that stands for NULL in a partitioned layout.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Partitions that one ALTER TABLE statement adds or drops.
PARTITIONS_AT_ONCE = 200
#: Calls for single partitions that are under way together.
CALLS_AT_ONCE = 8


def _quote(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def create_database(
    spark: SparkSession, name: str, location: str | None = None, if_not_exists: bool = True
) -> None:
    """``CREATE DATABASE [IF NOT EXISTS] name [LOCATION p]``. Without
    ``if_not_exists`` a second call raises ``SCHEMA_ALREADY_EXISTS``. The
    current database does not change."""
    sql = "CREATE DATABASE " + ("IF NOT EXISTS " if if_not_exists else "") + name
    if location:
        sql += f" LOCATION '{_quote(location)}'"
    spark.sql(sql)


def create_schema(spark: SparkSession, name: str) -> None:
    """Strict form: fails when the schema already exists."""
    create_database(spark, name, if_not_exists=False)


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    """Drop a table; the files of an external table stay where they are."""
    spark.sql("DROP TABLE " + ("IF EXISTS " if if_exists else "") + name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def current_database(spark: SparkSession) -> str:
    return spark.catalog.currentDatabase()


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a table, in order, from ``DESCRIBE TABLE``.

    A metadata command answered on the driver; ``catalog.listColumns``
    would instead run one small job per partition of its result.
    """
    rows = spark.sql(f"DESCRIBE TABLE {name}").collect()
    names = [r[0] for r in rows]
    if "# Partition Information" not in names:
        return []
    out = []
    for col_name in names[names.index("# Partition Information") + 1:]:
        if not col_name or col_name.startswith("#"):
            if out:
                break
            continue
        out.append(col_name)
    return out


def name_parts(name: str) -> list[str]:
    """The parts of a table name, without their backticks."""
    return [p[1:-1].replace("``", "`") if p.startswith("`") else p for p in re.findall(r"`(?:[^`]|``)*`|[^.`]+", name)]


def two_part_name(spark: SparkSession, name: str) -> tuple[str, str]:
    """(database, table) of a name of one, two or three parts in the built-in catalog."""
    parts = name_parts(name)
    return (parts[-2] if len(parts) > 1 else current_database(spark)), parts[-1]


def quoted(*parts: str) -> str:
    return ".".join(sql_ident(p) for p in parts)


def table_info(spark: SparkSession, name: str, partition: str | None = None) -> dict[str, str]:
    """What ``DESCRIBE TABLE EXTENDED`` tells of a table, or of one of its partitions (a PARTITION
    clause): ``Location``, ``Type``, ``Provider`` and so on."""
    rows = [tuple(r)[:2] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition or ''}").collect()]
    section = "# Detailed Partition Information" if partition else "# Detailed Table Information"
    rows = rows[[r[0] for r in rows].index(section) + 1 :]
    end = next((i for i, r in enumerate(rows) if not r[0]), len(rows))
    return dict(rows[:end])


# -- partitions and their folders ---------------------------------------------------


def partition_clause(values: Mapping[str, str | None]) -> str:
    """``PARTITION (...)`` of values rendered as text; ``''`` and None are the NULL partition."""
    return "PARTITION (" + ", ".join(f"{sql_ident(c)} = {sql_str(v) if v else 'NULL'}" for c, v in values.items()) + ")"


def folder_values(folder: str) -> dict[str, str | None]:
    """Partition values of a folder like ``a=1/b=x%2Fy``."""
    pairs = [level.split("=", 1) for level in folder.split("/")]
    return {unquote(c): None if v == NULL_PARTITION else unquote(v) for c, v in pairs}


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def at_once(call: Callable, items: Sequence) -> None:
    """One catalog or file system call for each item, a few at a time: they wait for each other's
    answers otherwise. The first failure is raised when the calls under way have ended."""
    with ThreadPoolExecutor(CALLS_AT_ONCE) as pool:
        for done in [pool.submit(call, x) for x in items]:
            done.result()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def partition_folders(spark: SparkSession, path: str, levels: int) -> list[str]:
    """Partition folders below ``path`` (which may be a pattern), relative to it: a listing, no job."""
    return sorted({"/".join(f.split("/")[-levels:]) for f in partition_paths(spark, path, levels)})


def partition_paths(spark: SparkSession, path: str, levels: int) -> list[str]:
    """Partition folders below ``path``, whole."""
    fs, _ = _hadoop(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path + "/*=*" * levels)) or []
    return [f.getPath().toString() for f in found if f.isDirectory()]


def partition_names(spark: SparkSession, name: str) -> set[str]:
    """Partitions in the catalog, named like their folders."""
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def _in_runs(clauses: Sequence[str]) -> Iterable[Sequence[str]]:
    return (clauses[i : i + PARTITIONS_AT_ONCE] for i in range(0, len(clauses), PARTITIONS_AT_ONCE))


def add_partitions(spark: SparkSession, name: str, values: Iterable[Mapping[str, str | None]], root: str | None = None, folders: Sequence[str] = ()) -> None:
    """Add partitions that the catalog lacks: at their default folders, or at ``folders`` below ``root``."""
    clauses = [partition_clause(v) for v in values]
    if root:
        clauses = [f"{c} LOCATION '{_quote(f'{root}/{f}')}'" for c, f in zip(clauses, folders, strict=True)]
    for run in _in_runs(clauses):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(run)}")


def drop_partitions(spark: SparkSession, name: str, folders: Sequence[str]) -> None:
    """Drop partitions, named like their folders; a managed table's files go with them."""
    for run in _in_runs([partition_clause(folder_values(f)) for f in folders]):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(run)}")


def set_location(spark: SparkSession, name: str, path: str, partition: str = "") -> None:
    spark.sql(f"ALTER TABLE {name} {partition} SET LOCATION '{_quote(path)}'")


def point_partitions(spark: SparkSession, name: str, root: str, folders: Sequence[str]) -> None:
    """Let the partitions of ``folders`` be those below ``root``, each by one catalog call: any of them
    is the old or the new one at every moment."""
    have = partition_names(spark, name)
    at_once(lambda f: set_location(spark, name, f"{root}/{f}", partition_clause(folder_values(f))), [f for f in folders if f in have])
    new = [f for f in folders if f not in have]
    add_partitions(spark, name, [folder_values(f) for f in new], root, new)


def _repair_if_partitioned(spark: SparkSession, name: str) -> None:
    if partition_columns(spark, name):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def register_location(
    spark: SparkSession, name: str, location: str, fmt: str = "parquet", if_not_exists: bool = True
) -> None:
    """Register existing files as an external table; schema and partition
    columns are those kept with the files, or inferred from them. Partition
    folders already there are added to the catalog, otherwise a partitioned table
    would read empty. An empty location raises ``UNABLE_TO_INFER_SCHEMA``."""
    existed = if_not_exists and spark.catalog.tableExists(name)
    kept = None if existed else kept_schema(spark, location)
    columns, layout = "", ""
    if kept:
        schema, parts = kept
        columns = " (" + ", ".join(f"{sql_ident(f.name)} {f.dataType.simpleString()}" for f in schema) + ")"
        layout = f" PARTITIONED BY ({', '.join(sql_ident(p) for p in parts)})"
    spark.sql(
        "CREATE TABLE " + ("IF NOT EXISTS " if if_not_exists else "")
        + f"{name}{columns} USING {fmt}{layout} LOCATION '{_quote(location)}'"
    )
    if not existed:
        _repair_if_partitioned(spark, name)


def ensure_registered(spark: SparkSession, name: str, location: str, fmt: str = "parquet") -> bool:
    """Register ``location`` under ``name`` unless the name exists; refresh
    either way so cached file listings see new files. Returns True when it
    registered."""
    if spark.catalog.tableExists(name):
        _repair_if_partitioned(spark, name)
        spark.catalog.refreshTable(name)
        return False
    register_location(spark, name, location, fmt, if_not_exists=False)
    return True
