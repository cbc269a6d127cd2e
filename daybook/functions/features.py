"""The registry of named point-in-time features and feature selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Feature:
    """One output column: ``kind`` is ``count`` (rows), ``sum`` or ``avg`` of ``flag``."""

    name: str
    kind: str
    flag: str | None = None

    def sql(self) -> str:
        """The aggregate as SQL text over flag-level rows (direct form)."""
        name = "`" + self.name + "`"
        if self.kind == "count":
            return f"count(1) AS {name}"
        if self.kind == "sum":
            return f"sum(`{self.flag}`) AS {name}"
        if self.kind == "avg":
            return f"avg(`{self.flag}`) AS {name}"
        raise ValueError(f"unknown feature kind {self.kind!r}")

    def column(self) -> Column:
        return F.expr(self.sql())


# Fixed values that must equal the published job's: the 13 feature names in
# registry order, with the aggregate and flag behind each. The two
# "unclear_requirements" features aggregate the something-else flag, exactly
# as published; CORRECTED_FEATURES below points them at their own flag.
FEATURES: tuple[Feature, ...] = (
    Feature("cl_count_of_hire_v1", "count"),
    Feature("cl_count_of_client_weakness_is_unclear_requirements_v1", "sum", "client_weakness_is_something_else"),
    Feature("cl_count_of_client_weakness_is_poor_communication_v1", "sum", "client_weakness_is_poor_communication"),
    Feature("cl_count_of_client_weakness_is_something_else_v1", "sum", "client_weakness_is_something_else"),
    Feature("cl_avg_of_client_weakness_is_unclear_requirements_v1", "avg", "client_weakness_is_something_else"),
    Feature("cl_avg_of_client_weakness_is_poor_communication_v1", "avg", "client_weakness_is_poor_communication"),
    Feature("cl_avg_of_client_weakness_is_something_else_v1", "avg", "client_weakness_is_something_else"),
    Feature("cl_count_of_outcome_is_good_v1", "sum", "outcome_is_good"),
    Feature("cl_count_of_outcome_is_neutral_v1", "sum", "outcome_is_neutral"),
    Feature("cl_count_of_outcome_is_bad_v1", "sum", "outcome_is_bad"),
    Feature("cl_avg_of_outcome_is_good_v1", "avg", "outcome_is_good"),
    Feature("cl_avg_of_outcome_is_neutral_v1", "avg", "outcome_is_neutral"),
    Feature("cl_avg_of_outcome_is_bad_v1", "avg", "outcome_is_bad"),
)

_UNCLEAR = "client_weakness_is_unclear_requirements"
CORRECTED_FEATURES: tuple[Feature, ...] = tuple(
    Feature(f.name, f.kind, _UNCLEAR) if _UNCLEAR in f.name else f for f in FEATURES
)


def select_features(
    names: Iterable[str] | None = None, registry: Sequence[Feature] = FEATURES
) -> list[Feature]:
    """Known names in the order given; unknown names are skipped silently.

    ``None`` selects the whole registry. Selecting nothing is an error, since
    an aggregation needs at least one column.
    """
    if names is None:
        return list(registry)
    by_name = {f.name: f for f in registry}
    chosen = [by_name[n] for n in names if n in by_name]
    if not chosen:
        raise ValueError("no known feature selected; known: " + ", ".join(by_name))
    return chosen
