"""Table writes on the built-in catalog with Parquet files.

The contracts are those of a table format with create / append / replace /
overwrite-partitions verbs; on plain Parquet tables they map to
``DataFrameWriter`` calls and by-name ``INSERT`` statements. Every write is a
distributed job: tasks write files on executors, the driver only commits.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.functions.flags import sql_ident
from daybook.operators.catalog import (
    add_partitions,
    at_once,
    delete_path,
    drop_partitions,
    drop_table,
    partition_clause,
    partition_columns,
    partition_folders,
    partition_names,
    partition_paths,
    folder_values,
    point_partitions,
    quoted,
    register_location,
    set_location,
    table_info,
    two_part_name,
)
from daybook.sources.readers import keep_schema, read_path

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a SQL conf for the duration of one statement, then restore it."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _parts(partition_by: str | Sequence[str] | None) -> list[str]:
    if partition_by is None:
        return []
    return [partition_by] if isinstance(partition_by, str) else list(partition_by)


def clustered_for_write(df: DataFrame, partition_by=None) -> DataFrame:
    """Group rows by partition value before a partitioned write.

    Without this every task writes a file into every partition it holds
    (tasks x partitions small files). The rebalance hint shuffles on the
    partition columns and lets AQE merge small partitions and split a hot
    one, so file count tracks data size and one huge date never lands in a
    single task.
    """
    parts = _parts(partition_by)
    return df.hint("rebalance", *[F.col(p) for p in parts]) if parts else df


def align_to_table(df: DataFrame, name: str) -> DataFrame:
    """Reorder ``df`` to the table's column order, matching by name.

    Partition columns sit last in a Parquet table's schema, so positional
    inserts with the frame's own order would mis-assign; this makes inserts
    by name. Missing or extra columns raise ``ValueError``.
    """
    target = df.sparkSession.table(name).columns
    have = {c.lower(): c for c in df.columns}
    missing = [c for c in target if c.lower() not in have]
    extra = [c for c in df.columns if c.lower() not in {t.lower() for t in target}]
    if missing or extra:
        raise ValueError(f"columns do not match table {name}: missing={missing} extra={extra}")
    return df.selectExpr(*[f"{sql_ident(have[c.lower()])} AS {sql_ident(c)}" for c in target])


def bucketing(info: dict[str, str]) -> tuple[int, list[str]] | None:
    """Number of buckets and bucket columns of a table, from its ``table_info``."""
    if "Num Buckets" not in info:
        return None
    names = re.findall(r"`((?:[^`]|``)+)`", info["Bucket Columns"])
    return int(info["Num Buckets"]), [n.replace("``", "`") for n in names]


def clustered_by_bucket(df: DataFrame, buckets: tuple[int, Sequence[str]]) -> DataFrame:
    """Rows dealt as the buckets are, so that each task writes one bucket, one file of it to a partition."""
    return df.repartition(buckets[0], *[F.col(sql_ident(c)) for c in buckets[1]])


def create_table(
    df: DataFrame, name: str, partition_by=None, fmt: str = "parquet", bucket_by: tuple[int, Sequence[str]] | None = None
) -> None:
    """Create-only: raises ``TABLE_OR_VIEW_ALREADY_EXISTS`` if ``name`` exists.

    ``bucket_by`` (number, columns) deals each partition's rows to buckets by a hash of the
    columns. Bucketed by its merge keys (those that are not partition columns), a table is probed
    by ``merge_into`` without a shuffle of its rows. Take as many buckets as keep the keys of one,
    over all partitions, within a task: a bucket is read by one task, and no skew join splits it."""
    parts = _parts(partition_by)
    if bucket_by:
        n, cols = bucket_by
        writer = clustered_by_bucket(df, bucket_by).write.format(fmt).bucketBy(n, *cols)
        return (writer.partitionBy(*parts) if parts else writer).saveAsTable(name, mode="error")
    writer = clustered_for_write(df, parts).writeTo(name).using(fmt)
    if parts:
        writer = writer.partitionedBy(*[F.col(p) for p in parts])
    writer.create()


def append_by_name(df: DataFrame, name: str) -> None:
    """Append to an existing table, matching columns by name; rows are grouped by
    partition (or bucket) first, so that files follow partitions and not tasks."""
    aligned, buckets = align_to_table(df, name), bucketing(table_info(df.sparkSession, name))
    parts = partition_columns(df.sparkSession, name)
    (clustered_by_bucket(aligned, buckets) if buckets else clustered_for_write(aligned, parts)).write.insertInto(name, overwrite=False)


def _fresh(tag: str) -> str:
    return f"{tag}_{uuid.uuid4().hex[:12]}"


def _beside(spark: SparkSession, name: str, tag: str) -> str:
    """A new table name in the database of ``name``."""
    db, table = two_part_name(spark, name)
    return quoted(db, f"{table}__{_fresh(tag)}")


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to a table beside ``name`` and read back; the table and its files go at the end."""
    stage = _beside(df.sparkSession, name, "stage")
    try:
        df.write.format("parquet").saveAsTable(stage)
        yield df.sparkSession.table(stage)
    finally:
        drop_table(df.sparkSession, stage)


def _save(df: DataFrame, path: str, parts: Sequence[str], fmt: str) -> None:
    writer = clustered_for_write(df, parts).write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "static")
    (writer.partitionBy(*parts) if parts else writer).save(path)


def _point(spark: SparkSession, name: str, path: str, parts: Sequence[str]) -> None:
    """Let the table read the complete rows at ``path``: one catalog call, and one for each partition."""
    if not parts:
        set_location(spark, name, path)
    else:
        folders = partition_folders(spark, path, len(parts))
        set_location(spark, name, path)  # of the folder for new partitions; those there have places of their own
        point_partitions(spark, name, path, folders)
        drop_partitions(spark, name, sorted(partition_names(spark, name) - set(folders)))
    spark.catalog.refreshTable(name)


def _new_root(location: str) -> str:
    """A folder beside a table's; the mark of an earlier replace gives way to the new one."""
    return f"{location.rstrip('/').split('__new_')[0]}__{_fresh('new')}"


def _swap_location(df: DataFrame, name: str, parts: Sequence[str], info: dict[str, str]) -> None:
    """Replace all rows of a table that keeps its schema, by changing its place."""
    spark, old = df.sparkSession, info["Location"]
    new = _new_root(old)
    try:
        _save(df, new, parts, info["Provider"])
    except BaseException:
        delete_path(spark, new)
        raise
    _point(spark, name, new, parts)
    if info["Type"] == "MANAGED":
        delete_path(spark, old)
        return
    # an external table is also read by its path: the rows move there while the name reads the new folder
    _save(spark.table(name), old, parts, info["Provider"])
    _point(spark, name, old, parts)
    delete_path(spark, new)


def _swap_names(df: DataFrame, name: str, parts: Sequence[str], fmt: str, info: dict[str, str]) -> None:
    """Replace a table by one of another schema, layout or format, by changing names."""
    spark = df.sparkSession
    table = quoted(*two_part_name(spark, name))
    new, old = _beside(spark, name, "new"), _beside(spark, name, "old")
    external = info["Type"] != "MANAGED"
    root = _new_root(info["Location"])
    try:
        writer = clustered_for_write(df, parts).write.mode("overwrite").format(fmt)
        writer = writer.option("path", root) if external else writer
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(new)
    except BaseException:
        drop_table(spark, new)
        if external:
            delete_path(spark, root)
        raise
    had = partition_columns(spark, table)
    places = {f: table_info(spark, table, partition_clause(folder_values(f)))["Location"] for f in partition_names(spark, table)} if had else {}
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except BaseException:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        back = table_info(spark, table)["Location"]
        for f, place in places.items():  # a managed table's folder has moved with its names
            set_location(spark, table, place.replace(info["Location"], back, 1), partition_clause(folder_values(f)))
        drop_table(spark, new)
        if external:
            delete_path(spark, root)
        raise
    drop_table(spark, old)
    if external:
        _save(spark.table(table), info["Location"], parts, fmt)
        _point(spark, table, info["Location"], parts)
        delete_path(spark, root)
    elif parts:  # a catalog may still hold the partitions under the folder's first name
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def _same_layout(df: DataFrame, name: str, parts: Sequence[str], fmt: str, info: dict[str, str]) -> bool:
    spark = df.sparkSession
    have = [(f.name, f.dataType) for f in spark.table(name).schema]
    want = [(f.name, f.dataType) for f in df.schema if f.name not in parts] + [(p, df.schema[p].dataType) for p in parts]
    plain = info.get("Provider", "").lower() == fmt.lower() and "Num Buckets" not in info
    return plain and have == want and partition_columns(spark, name) == list(parts)


def create_or_replace(df: DataFrame, name: str, partition_by=None, fmt: str = "parquet") -> None:
    """Create, or replace schema and all rows (every partition) of ``name``.

    The new rows are written once, to a new folder. Only when they are complete
    does an existing table take them: where schema, partitions and format stay,
    its location changes (with partitions, one catalog call for each), so the
    table is there at every moment, with its old or its new rows. Otherwise two
    renames put a new table in its place; if the second fails, the old table gets
    its name back. A job that fails leaves the old table as it was, and ``df`` may
    read the table that it replaces. An external table stays external, at its
    path: its name reads the new folder while the path is rewritten.
    """
    spark = df.sparkSession
    parts = _parts(partition_by)
    if not spark.catalog.tableExists(name):
        writer = clustered_for_write(df, parts).write.mode("overwrite").format(fmt)
        return (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)
    info = table_info(spark, name)
    if _same_layout(df, name, parts, fmt, info):
        _swap_location(df, name, parts, info)
    else:
        _swap_names(df, name, parts, fmt, info)


def replace_rows(df: DataFrame, name: str) -> None:
    """Replace all rows of an unpartitioned table by ``df``, which may read it. Swapped in as in
    ``create_or_replace``."""
    info = table_info(df.sparkSession, name)
    if buckets := bucketing(info):
        with staged(align_to_table(df, name), name) as rows:
            return clustered_by_bucket(align_to_table(rows, name), buckets).write.insertInto(name, overwrite=True)
    _swap_location(align_to_table(df, name), name, [], info)


#: Folder below a managed table's own for partitions written by an overwrite; readers of paths pass it over.
SWAP = "_swap-"


def _drop_left(spark: SparkSession, table_root: str, new_root: str, folders: Sequence[str], levels: int) -> None:
    """Delete the folders that the partitions of ``folders`` have left, and overwrite folders that are empty then."""
    now = set(folders)
    older = [p for p in partition_paths(spark, f"{table_root}/{SWAP}*", levels) if not p.startswith(f"{new_root}/")]
    left, kept = set(), set()
    for place in [*partition_paths(spark, table_root, levels), *older]:
        (left if "/".join(place.rsplit("/", levels)[1:]) in now else kept).add(place)
    roots_left, roots_kept = ({p.rsplit("/", levels)[0] for p in places} for places in (left, kept))
    emptied = {r for r in roots_left - roots_kept if r.rsplit("/", 1)[-1].startswith(SWAP)}
    at_once(lambda p: delete_path(spark, p), [*(p for p in left if p.rsplit("/", levels)[0] not in emptied), *emptied])


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Dynamic partition overwrite: partitions present in ``df`` are replaced,
    all others are kept; an empty ``df`` changes nothing. Columns by name; '' in a
    string partition column is stored as NULL. An unpartitioned table is one
    partition: all its rows are replaced, by none if ``df`` is empty. ``df`` may read
    the partitions that it replaces.

    A managed table's new partitions are written whole to a folder of their own
    and then swapped in, each by one catalog call. Whenever the driver is lost,
    each partition is the old or the new one, never absent; running the job again
    completes it. External and bucketed tables keep their layout: Spark's own
    dynamic overwrite moves the files, partition by partition (other threads of the
    session should not write tables at that moment)."""
    spark = df.sparkSession
    parts = partition_columns(spark, name)
    if not parts:
        return replace_rows(df, name)
    aligned, info = align_to_table(df, name), table_info(spark, name)
    buckets = bucketing(info)
    if info["Type"] != "MANAGED" or buckets:
        rows = clustered_by_bucket(aligned, buckets) if buckets else clustered_for_write(aligned, parts)
        with session_conf(spark, OVERWRITE_MODE, "dynamic"):
            return rows.write.insertInto(name, overwrite=True)
    root = f"{info['Location'].rstrip('/')}/{SWAP}{uuid.uuid4().hex[:12]}"
    try:
        _save(aligned, root, parts, info["Provider"])
        folders = partition_folders(spark, root, len(parts))
    except BaseException:
        delete_path(spark, root)
        raise
    if not folders:
        return delete_path(spark, root)
    point_partitions(spark, name, root, folders)
    spark.catalog.refreshTable(name)
    _drop_left(spark, info["Location"].rstrip("/"), root, folders, len(parts))


def publish(df: DataFrame, name: str, partition_by: str | Sequence[str] = "date") -> str:
    """Daily publish: overwrite the partitions in ``df`` when the table exists,
    else create it partitioned. An existing unpartitioned table is replaced whole,
    so that is refused with ``ValueError``. Returns ``"overwrite"`` or ``"create"``."""
    if df.sparkSession.catalog.tableExists(name):
        if not partition_columns(df.sparkSession, name):
            raise ValueError(f"{name} has no partitions to publish to")
        overwrite_partitions(df, name)
        return "overwrite"
    create_or_replace(df, name, partition_by=partition_by)
    return "create"


def create_table_as_select_if_absent(
    spark: SparkSession, name: str, from_table: str, partition_by=None, fmt: str = "parquet"
) -> None:
    """``CREATE TABLE IF NOT EXISTS name ... AS SELECT * FROM from_table``;
    an existing table is left untouched."""
    parts = _parts(partition_by)
    cols = ", ".join(sql_ident(p) for p in parts)
    clause = f" PARTITIONED BY ({cols})" if parts else ""
    hint = f"/*+ REBALANCE({cols}) */ " if parts else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt}{clause} AS SELECT {hint}* FROM {from_table}")


def _rows_at(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    try:
        return read_path(spark, path, fmt)
    except AnalysisException:  # no such path, or no files in it
        return None


def overwrite_path(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """Replace everything at ``path`` (static overwrite, pinned as a writer
    option so a session-wide dynamic mode cannot turn it into a partial one). With
    partitions, the schema is kept beside the files, so that partition columns
    come back with their types.

    Where the path holds rows, the new ones are completed in a staging table
    first: a computation that fails leaves the old rows, and ``df`` may read
    them. Only a failure of the final copy can leave the path incomplete."""
    parts = _parts(partition_by)

    def write(rows: DataFrame) -> None:
        _save(rows, path, parts, fmt)
        if parts:
            keep_schema(rows, path, parts)

    if _rows_at(df.sparkSession, path, fmt) is None:
        return write(df)
    with staged(df, "path") as rows:
        write(rows)


def _folder_parts(rows: DataFrame, path: str) -> list[str]:
    """Partition columns of the folders below ``path``, from the place of one file."""
    one = rows.select("_metadata.file_path").first()
    if one is None:
        return []
    last = path.rstrip("/").rsplit("/", 1)[-1]
    below = one[0].rsplit(f"/{last}/", 1)[-1].split("/")[:-1]
    return [x.split("=", 1)[0] for x in below if "=" in x]


def append_path(
    df: DataFrame, path: str, name: str | None = None, fmt: str = "parquet", partition_by=None
) -> None:
    """Append files at ``path``; with ``name``, make sure the location is
    registered under that name and refreshed so readers by name see the new
    files and partitions. A name that is there already gets the partitions that
    this append wrote, and no other is looked at. The layout is that of the
    registered table, or of the files at the path; another ``partition_by`` raises
    ``ValueError``."""
    spark = df.sparkSession
    have = None
    if name and spark.catalog.tableExists(name):
        have = partition_columns(spark, name)
    elif (rows := _rows_at(spark, path, fmt)) is not None:
        have = _folder_parts(rows, path)
    parts = _parts(partition_by) if partition_by is not None else have or []
    if have is not None and parts != have:
        raise ValueError(f"{path} is partitioned by {have}, not by {parts}")
    known = bool(name) and spark.catalog.tableExists(name)
    seen = Observation()
    if known and parts:  # the partitions written, found while they are written
        spec = F.struct(*[F.col(p).cast("string").alias(p) for p in parts])
        df = df.observe(seen, F.collect_set(spec).alias("specs"))
    writer = clustered_for_write(df, parts).write.mode("append").format(fmt)
    (writer.partitionBy(*parts) if parts else writer).save(path)
    if parts and have is None:
        keep_schema(df, path, parts)
    if not known:
        if name:
            register_location(spark, name, path, fmt, if_not_exists=False)
        return
    if parts:
        add_partitions(spark, name, [dict(zip(parts, tuple(v), strict=True)) for v in seen.get["specs"]])
    spark.catalog.refreshTable(name)


def save_external(df: DataFrame, name: str, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """Overwrite the files at ``path`` and (re)register them as table ``name``;
    readable by path and by name. A static overwrite whatever the session's mode.
    Where the name or rows at the path exist, the new rows are completed in a
    staging table first, as in ``overwrite_path``."""
    spark = df.sparkSession
    parts = _parts(partition_by)

    def write(rows: DataFrame) -> None:
        writer = clustered_for_write(rows, parts).write.format(fmt).mode("overwrite").option("path", path)
        with session_conf(spark, OVERWRITE_MODE, "static"):
            (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)

    if not spark.catalog.tableExists(name) and _rows_at(spark, path, fmt) is None:
        return write(df)
    with staged(df, name) as rows:
        write(rows)
