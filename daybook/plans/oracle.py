"""DuckDB SQL describing the expected result of each registered query.

These strings run on the raw test tables (``orders``, ``customer``,
``nation`` ... registered as views) and are the independent check of the
Spark jobs. They restate the fixture derivation from ``fixtures.py`` in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from daybook.functions.features import CORRECTED_FEATURES, FEATURES, Feature, select_features
from daybook.plans.fixtures import HISTORY_SINCE, POPULATION_END, POPULATION_START

FLAG_SQL = {
    "client_weakness_is_unclear_requirements": "CASE WHEN contains(answers, '\"19\"') THEN 1 ELSE 0 END",
    "client_weakness_is_poor_communication": "CASE WHEN contains(answers, '\"20\"') THEN 1 ELSE 0 END",
    "client_weakness_is_something_else": "CASE WHEN contains(answers, '\"21\"') THEN 1 ELSE 0 END",
    "outcome_is_good": "CASE WHEN outcome = 'good' THEN 1 ELSE 0 END",
    "outcome_is_neutral": "CASE WHEN outcome = 'neutral' THEN 1 ELSE 0 END",
    "outcome_is_bad": "CASE WHEN outcome = 'bad' THEN 1 ELSE 0 END",
}

ORDERS_DATED = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d FROM orders"

HISTORY = f"""
SELECT CAST(o_custkey AS VARCHAR) AS client_uid,
       o_custkey AS employer,
       CAST(NULL AS VARCHAR) AS client_recom_score_answer,
       CASE WHEN o_orderkey % 7 <> 0
            THEN '{{"answer":["' || CAST(o_orderkey % 5 + 17 AS VARCHAR) || '","'
                 || CAST(o_custkey % 5 + 17 AS VARCHAR) || '"]}}' END AS contractor_recom_score_answer,
       CASE o_orderstatus WHEN 'F' THEN 'good' WHEN 'O' THEN 'neutral' ELSE 'bad' END AS outcome,
       d - CAST(o_orderkey % 90 AS INTEGER) AS start_date,
       d AS end_date
FROM ({ORDERS_DATED}) o"""

FLAGGED = f"""
SELECT *, {", ".join(f"{sql} AS {name}" for name, sql in FLAG_SQL.items())}
FROM (SELECT *, CAST(json_extract(contractor_recom_score_answer, '$.answer') AS VARCHAR) AS answers
      FROM ({HISTORY}) h0) h1"""


def population_sql(distinct: bool = True, start: str = POPULATION_START, end: str = POPULATION_END) -> str:
    return (
        f"SELECT {'DISTINCT ' if distinct else ''}d AS date, o_custkey AS client_id FROM ({ORDERS_DATED}) o "
        f"WHERE d >= DATE '{start}' AND d < DATE '{end}'"
    )


def history_sql(since: str = HISTORY_SINCE) -> str:
    return f"SELECT * FROM ({FLAGGED}) f WHERE start_date >= DATE '{since}'"


def _agg_sql(f: Feature) -> str:
    if f.kind == "count":
        return f"COUNT(*) AS {f.name}"
    if f.kind == "sum":
        return f"CAST(SUM({f.flag}) AS BIGINT) AS {f.name}"
    return f"AVG({f.flag}) AS {f.name}"


def pit_sql(
    features: Sequence[Feature] = FEATURES,
    distinct: bool = True,
    since: str = HISTORY_SINCE,
    where: str = "",
    start: str = POPULATION_START,
    end: str = POPULATION_END,
    instants: bool = False,
) -> str:
    """The feature table, written the way the published job reads: inner
    range join, group, left join back, zero fill. ``instants``: history ends at hour
    ``employer % 24`` of its day, and the population's dates are at noon."""
    same_day = " OR h.end_date = p.date AND h.employer % 24 < 12" if instants else ""
    aggs = ",\n       ".join(_agg_sql(f) for f in features)
    outs = ",\n       ".join(f"COALESCE(a.{f.name}, 0) AS {f.name}" for f in features)
    return f"""
WITH p AS ({population_sql(distinct, start, end)}),
     h AS ({history_sql(since)}),
     a AS (SELECT p.client_id, p.date,
       {aggs}
       FROM h JOIN p ON h.employer = p.client_id AND (h.end_date < p.date{same_day})
       GROUP BY p.client_id, p.date)
SELECT * FROM (
SELECT COALESCE(p.client_id, 0) AS client_id, p.date,
       {outs}
FROM p LEFT JOIN a ON p.client_id = a.client_id AND p.date = a.date) r {where}"""


SELECTED_FEATURE_NAMES = (
    "cl_avg_of_outcome_is_bad_v1",
    "not_a_registered_feature",
    "cl_count_of_hire_v1",
    "cl_count_of_client_weakness_is_poor_communication_v1",
)

# (start, end, history cut-off) of the two publish runs used by write queries.
# The second run overlaps the first by one month and sees less history, so
# overlapping rows differ.
WINDOW_A = ("1998-01-01", "1998-04-01", "1996-01-01")
WINDOW_B = ("1998-03-01", "1998-07-01", "1997-01-01")
DAYS = ("1998-06-01", "1998-06-02", "1998-06-03", "1998-06-04", "1998-06-05")
ONE_DAY = ("1998-06-01", "1998-06-02", "1996-01-01")

_MERGE_ROWS = """
WITH c AS (
  SELECT c_custkey AS id, CAST(c_custkey % 7 AS INTEGER) AS part, c_nationkey AS n,
    CASE WHEN c_custkey % 4 >= 2 THEN 'p' || (c_custkey % 4) END AS name
  FROM customer
)
"""


def looks_sql(table: str, **looks: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS look, least({n}, count(*)) AS n_rows, CAST(0 AS BIGINT) AS n_foreign FROM {table}"
        for name, n in looks.items()
    )


def window_sql(window) -> str:
    start, end, since = window
    return pit_sql(since=since, start=start, end=end)


def partition_overwrite_sql(old: str, new: str) -> str:
    return (
        f"SELECT * FROM ({old}) o WHERE date NOT IN (SELECT DISTINCT date FROM ({new}) n0) "
        f"UNION ALL SELECT * FROM ({new}) n1"
    )


def merge_sql(target: str, source: str, features: Sequence[Feature] = FEATURES,
              update: Sequence[str] = ("cl_count_of_hire_v1",)) -> str:
    cols = ["client_id", "date"] + [f.name for f in features]
    out = []
    for c in cols:
        if c in update:
            out.append(f"CASE WHEN t.__t AND s.__s THEN s.{c} WHEN t.__t THEN t.{c} ELSE s.{c} END AS {c}")
        else:
            out.append(f"CASE WHEN t.__t THEN t.{c} ELSE s.{c} END AS {c}")
    return (
        f"SELECT {', '.join(out)} FROM (SELECT *, TRUE AS __t FROM ({target}) t0) t "
        f"FULL OUTER JOIN (SELECT *, TRUE AS __s FROM ({source}) s0) s "
        f"ON t.date = s.date AND t.client_id = s.client_id"
    )


def _join_sql(select: str, group: bool = False) -> str:
    sql = (
        f"SELECT {select} FROM ({history_sql()}) h "
        f"JOIN ({population_sql()}) p ON h.employer = p.client_id AND h.end_date < p.date"
    )
    return sql + (" GROUP BY p.client_id, p.date" if group else "")


GROUPED_SQL = _join_sql(
    "p.client_id, p.date, COUNT(*) AS n_rows, CAST(SUM(outcome_is_good) AS BIGINT) AS n_good, "
    "AVG(outcome_is_good) AS rate_good",
    group=True,
)
LEFT_JOINED_SQL = (
    f"SELECT p.client_id, p.date, g.n_rows, g.n_good, g.rate_good FROM ({population_sql()}) p "
    f"LEFT JOIN ({GROUPED_SQL}) g ON p.client_id = g.client_id AND p.date = g.date"
)


def oracle_queries() -> dict[str, str]:
    full = pit_sql()
    a, b = window_sql(WINDOW_A), window_sql(WINDOW_B)
    customer, customer2 = "SELECT * FROM customer", "SELECT * FROM customer UNION ALL SELECT * FROM customer"
    overwritten = partition_overwrite_sql(a, b)
    code_flags = ", ".join(list(FLAG_SQL)[:3])
    outcome_flags = ", ".join(list(FLAG_SQL)[3:])
    return {
        "pit_features": full,
        "pit_features_one_day": window_sql(ONE_DAY),
        "limit_rows_only": looks_sql("customer", limit=10),
        "inspect_job": looks_sql("customer", api=5, sql=10),
        "merge_key_without_partition": _MERGE_ROWS + """
SELECT id, CASE WHEN id % 2 = 0 THEN n + 100 ELSE n END AS n, part FROM c WHERE id % 3 <> 0
UNION ALL SELECT id, n + 100, 99 FROM c WHERE id % 3 = 0 AND id % 2 = 0""",
        "merge_string_partition": _MERGE_ROWS + """
SELECT id, CASE WHEN id % 4 = 2 THEN n + 100 ELSE n END AS n, name FROM c WHERE id % 3 <> 0
UNION ALL SELECT id, n + 100, name FROM c WHERE id % 4 = 0 OR id % 4 = 2 AND id % 3 = 0""",
        "merge_bucketed": _MERGE_ROWS + """
SELECT id, CASE WHEN id % 4 = 0 THEN n + 100 ELSE n END AS n, part FROM c WHERE id % 3 <> 0
UNION ALL SELECT id, n + 100, CASE WHEN id % 4 = 0 THEN part ELSE 99 END FROM c WHERE id % 4 = 2 OR id % 12 = 0""",
        "append_partitioned": f"SELECT * FROM ({a}) UNION ALL SELECT * FROM ({b})",
        "path_append_partitioned": "SELECT * FROM customer WHERE c_nationkey < 10 UNION ALL SELECT * FROM customer WHERE c_nationkey >= 5",
        "external_partitioned_replace": "SELECT * FROM customer WHERE c_nationkey >= 5 UNION ALL SELECT * FROM customer WHERE c_nationkey >= 5",
        "pit_features_dup_population": pit_sql(distinct=False),
        "pit_features_prefix_sum": full,
        "pit_features_range_join": full,
        "pit_features_direct": full,
        "pit_features_chunked": full,
        "pit_features_instants": pit_sql(instants=True),
        "daily_totals_runs": window_sql((DAYS[0], DAYS[-1], WINDOW_A[2])),
        "replace_three_part_name": "SELECT * FROM customer WHERE c_nationkey >= 5",
        "replace_external": "SELECT * FROM customer WHERE c_nationkey >= 5 UNION ALL SELECT * FROM customer WHERE c_nationkey >= 5",
        "merge_unpartitioned_three_part": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS n FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT c_custkey, c_nationkey + 100 FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 0""",
        "path_text_partition": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS date, 'string' AS kind FROM orders
UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%Y-%m'), 'string' FROM orders""",
        "pit_features_selected": pit_sql(select_features(SELECTED_FEATURE_NAMES)),
        "pit_features_corrected": pit_sql(CORRECTED_FEATURES),
        "features_positive_only": pit_sql(where="WHERE cl_count_of_hire_v1 > 0"),
        "scan_parquet_project": "SELECT c_custkey, c_name, c_nationkey FROM customer",
        "scan_table": customer,
        "scan_sql": "SELECT * FROM nation",
        "scan_path": customer,
        "date_range_half_open": (
            f"SELECT o_orderkey, o_custkey, d AS date FROM ({ORDERS_DATED}) o "
            f"WHERE d >= DATE '{POPULATION_START}' AND d < DATE '{POPULATION_END}'"
        ),
        "filter_unselected_column": (
            "SELECT client_uid, employer, client_recom_score_answer, contractor_recom_score_answer, "
            f"outcome, end_date FROM ({HISTORY}) h WHERE start_date >= DATE '{HISTORY_SINCE}'"
        ),
        "json_answer_extract": (
            "SELECT employer, end_date, contractor_recom_score_answer, "
            "CAST(json_extract(contractor_recom_score_answer, '$.answer') AS VARCHAR) AS contractor_answers "
            f"FROM ({HISTORY}) h"
        ),
        "json_code_flags": f"SELECT employer, end_date, {code_flags} FROM ({FLAGGED}) f",
        "outcome_one_hot": f"SELECT employer, end_date, outcome, {outcome_flags} FROM ({FLAGGED}) f",
        "pit_join_rows": _join_sql("p.client_id, p.date, h.employer, h.end_date, h.outcome"),
        "population_left_join": LEFT_JOINED_SQL,
        "group_count_sum_avg": GROUPED_SQL,
        "fill_zero": (
            "SELECT COALESCE(client_id, 0) AS client_id, date, COALESCE(n_rows, 0) AS n_rows, "
            "COALESCE(n_good, 0) AS n_good, COALESCE(rate_good, 0) AS rate_good "
            f"FROM ({LEFT_JOINED_SQL}) l"
        ),
        "preview_ordered": (
            f"SELECT * FROM ({pit_sql(where='WHERE cl_count_of_hire_v1 > 0')}) q ORDER BY date, client_id LIMIT 10"
        ),
        "create_only": customer,
        "append_by_name": customer2,
        "create_or_replace": customer,
        "create_or_replace_partitioned": b,
        "dynamic_partition_overwrite": overwritten,
        "publish_first_run": a,
        "publish_second_run": overwritten,
        "ctas_if_not_exists": a,
        "merge_update_insert": merge_sql(a, b),
        "merge_first_run_noop": a,
        "path_overwrite": customer,
        "path_append_registered": customer2,
        "external_save_as_table": customer2,
        "register_location": a,
        "database_lifecycle": customer,
        "reload_job": customer,
        "path_table_job": customer,
        "external_table_job": customer2,
        "register_job": a,
        "daily_publish_merge": merge_sql(a, overwritten),
        "compute_replace": b,
    }
