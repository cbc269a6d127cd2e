"""Indicator flags derived from a JSON answer list and an outcome category.

Every flag is a built-in SQL expression (``get_json_object``, ``contains``,
``CASE``), so it stays inside whole-stage codegen and Catalyst folds it into
the scan's projection. The ``*_sql`` helpers return SQL text; the Column
forms wrap that text in one ``F.expr`` call, which is far cheaper on the
driver than assembling the same tree node by node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the published job's.
# Answer codes in the contractor feedback list, and the flag each one sets:
#   "19" -> client_weakness_is_unclear_requirements
#   "20" -> client_weakness_is_poor_communication
#   "21" -> client_weakness_is_something_else
# Outcome categories (case-sensitive) and their flags:
#   "good" -> outcome_is_good, "neutral" -> outcome_is_neutral, "bad" -> outcome_is_bad
ANSWER_PATH = "$.answer"
ANSWER_CODE_FLAGS = {
    "client_weakness_is_unclear_requirements": "19",
    "client_weakness_is_poor_communication": "20",
    "client_weakness_is_something_else": "21",
}
OUTCOME_FLAGS = {
    "outcome_is_good": "good",
    "outcome_is_neutral": "neutral",
    "outcome_is_bad": "bad",
}
FLAG_COLUMNS = tuple(ANSWER_CODE_FLAGS) + tuple(OUTCOME_FLAGS)


def sql_ident(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_str(value: str) -> str:
    """A string literal for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def json_answers_sql(answer_col: str, path: str = ANSWER_PATH) -> str:
    """Text at ``path`` of the JSON in column ``answer_col``; NULL input, absent
    path, JSON null or malformed text give NULL; an array comes back as
    compact JSON text."""
    return f"get_json_object({sql_ident(answer_col)}, {sql_str(path)})"


def code_flag_sql(answers_sql: str, code: str) -> str:
    """1 when the answer text holds the quoted code (``"19"``), else 0; NULL -> 0.

    The needle keeps its quotes, so ``"191"`` and an unquoted ``19`` do not match.
    """
    needle = sql_str('"' + code + '"')
    return f"CASE WHEN contains({answers_sql}, {needle}) THEN 1 ELSE 0 END"


def one_hot_sql(category_sql: str, value: str) -> str:
    """1 when the category equals ``value`` exactly (case-sensitive), else 0; NULL -> 0."""
    return f"CASE WHEN {category_sql} = {sql_str(value)} THEN 1 ELSE 0 END"


def flag_sql(
    answer_col: str = "contractor_recom_score_answer", outcome_col: str = "outcome"
) -> dict[str, str]:
    """SQL text of all six named flags, in a fixed order."""
    answers = json_answers_sql(answer_col)
    flags = {name: code_flag_sql(answers, code) for name, code in ANSWER_CODE_FLAGS.items()}
    flags.update({name: one_hot_sql(sql_ident(outcome_col), v) for name, v in OUTCOME_FLAGS.items()})
    return flags


def json_answers(answer_col: str, path: str = ANSWER_PATH) -> Column:
    return F.expr(json_answers_sql(answer_col, path))


def code_flag(answers: str | Column, code: str) -> Column:
    """Flag over a column name, or over any string Column (e.g. ``json_answers``)."""
    if isinstance(answers, str):
        return F.expr(code_flag_sql(sql_ident(answers), code))
    return F.when(answers.contains('"' + code + '"'), 1).otherwise(0)


def one_hot(category: str | Column, value: str) -> Column:
    if isinstance(category, str):
        return F.expr(one_hot_sql(sql_ident(category), value))
    return F.when(category == F.lit(value), 1).otherwise(0)


def flag_columns(
    answer_col: str = "contractor_recom_score_answer", outcome_col: str = "outcome"
) -> dict[str, Column]:
    """All six named flags as Columns, in a fixed order."""
    return {name: F.expr(sql) for name, sql in flag_sql(answer_col, outcome_col).items()}
