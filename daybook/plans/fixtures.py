"""Population and history views derived from the ``orders`` test table.

The published job reads an ``active_clients`` population and an assignment
outcome history from a catalog; the test data has neither, so both are
derived from ``orders`` with Spark expressions (no data is synthesized):

* ``employer`` = ``o_custkey``; ``end_date`` = order day;
  ``start_date`` = order day minus ``o_orderkey % 90`` days
* ``outcome``: status F -> good, O -> neutral, otherwise bad
* ``contractor_recom_score_answer``: NULL when ``o_orderkey % 7 = 0``, else
  ``{"answer":["A","B"]}`` with A = ``o_orderkey % 5 + 17``, B = ``o_custkey % 5 + 17``
* population: (order day as ``date``, ``o_custkey`` as ``client_id``), distinct
  unless duplicates are wanted
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Window and history cut-off used by every fixture query.
POPULATION_START = "1998-01-01"
POPULATION_END = "1998-07-01"
HISTORY_SINCE = "1996-01-01"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").selectExpr("*", "CAST(o_orderdate AS DATE) AS d")


HISTORY_COLUMNS = (
    "CAST(o_custkey AS STRING) AS client_uid",
    "o_custkey AS employer",
    "CAST(NULL AS STRING) AS client_recom_score_answer",
    "CASE WHEN o_orderkey % 7 != 0 THEN concat('{\"answer\":[\"', CAST(o_orderkey % 5 + 17 AS STRING), "
    "'\",\"', CAST(o_custkey % 5 + 17 AS STRING), '\"]}') END AS contractor_recom_score_answer",
    "CASE WHEN o_orderstatus = 'F' THEN 'good' WHEN o_orderstatus = 'O' THEN 'neutral' ELSE 'bad' END AS outcome",
    "date_sub(CAST(o_orderdate AS DATE), CAST(o_orderkey % 90 AS INT)) AS start_date",
    "CAST(o_orderdate AS DATE) AS end_date",
)


def history_from(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*HISTORY_COLUMNS)


def population_from(orders: DataFrame, distinct: bool = True) -> DataFrame:
    p = orders.selectExpr("CAST(o_orderdate AS DATE) AS date", "o_custkey AS client_id")
    return p.distinct() if distinct else p


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_from(read_table(spark, sf_dir, "orders"))


def population(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    return population_from(read_table(spark, sf_dir, "orders"), distinct)
