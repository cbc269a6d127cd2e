"""Scans. All are lazy: the schema comes from Parquet footers or the catalog,
and Catalyst pushes later filters and projections into the file scan."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

#: Folder below a path that holds its schema; readers of the path pass it over.
SCHEMA_FOLDER = "_schema"


def keep_schema(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Keep ``df``'s schema with the files at ``path``. Folder names hold partition values as text alone,
    so without it a string of digits or a date comes back as a number or a DATE."""
    text = json.dumps({"schema": df.schema.jsonValue(), "partition_by": list(partition_by)})
    rows = df.sparkSession.range(1).selectExpr(f"'{_quoted(text)}' AS value")
    rows.write.mode("overwrite").text(f"{path.rstrip('/')}/{SCHEMA_FOLDER}")


def kept_schema(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]] | None:
    """The schema and partition columns kept with the files at ``path``, if any."""
    try:
        row = spark.read.text(f"{path.rstrip('/')}/{SCHEMA_FOLDER}").first()
    except AnalysisException:  # files of others
        return None
    if row is None:
        return None
    kept = json.loads(row[0])
    return T.StructType.fromJson(kept["schema"]), kept["partition_by"]


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet file or folder; schema inferred; a missing path raises ``PATH_NOT_FOUND``."""
    return spark.read.parquet(path)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table previously written to ``path``, read without the catalog. Partition columns have the
    types they were written with where this library wrote them, inferred ones elsewhere."""
    kept = kept_schema(spark, path)
    reader = spark.read.format(fmt)
    return (reader.schema(kept[0]) if kept else reader).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table (or view) by name."""
    return spark.table(name)


def read_sql(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """``SELECT * FROM name [LIMIT n]`` through the SQL parser."""
    text = f"SELECT * FROM {name}"
    if limit is not None:
        text += f" LIMIT {int(limit)}"
    return spark.sql(text)


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def limit_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows in no particular order (a cheap look at a table)."""
    return df.limit(n)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """``n`` rows as a DataFrame instead of console output; with ``order_by``
    the rows are deterministic (a per-partition top-n, then a merge)."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)
