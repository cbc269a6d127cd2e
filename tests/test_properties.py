"""Properties: the three plan forms agree on arbitrary data, and results do
not depend on the join strategy Spark picks."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.operators.pit import METHODS, point_in_time_features
from daybook.plans import fixtures as fx

from .conftest import SF_SMALL

BASE = dt.date(2024, 1, 1)
days = st.integers(min_value=0, max_value=40).map(lambda d: BASE + dt.timedelta(days=d))
ids = st.one_of(st.none(), st.integers(min_value=1, max_value=6))
answers = st.sampled_from([
    None, '{"answer":["19","20"]}', '{"answer":["21"]}', '{"answer":"19"}', "not json",
    '{"answer":["191","20"]}', '{"answer":[19,21]}', '{}',
])
outcomes = st.sampled_from([None, "good", "neutral", "bad", "Good", "other"])
history_rows = st.lists(
    st.tuples(ids, st.one_of(st.none(), days), st.one_of(st.none(), days), answers, outcomes), max_size=40
)
population_rows = st.lists(st.tuples(st.one_of(st.none(), days), ids), min_size=1, max_size=25)


def _rows(df):
    return sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(history=history_rows, population=population_rows)
def test_plan_forms_agree(spark, history, population):
    hist = spark.createDataFrame(
        history, "employer bigint, start_date date, end_date date, contractor_recom_score_answer string, outcome string"
    )
    pop = spark.createDataFrame(population, "date date, client_id bigint")
    results = [
        _rows(point_in_time_features(pop, hist, "2024-01-05", "2024-02-01", since="2024-01-03", method=m))
        for m in METHODS
    ]
    assert results[0] == results[1] == results[2]


def test_results_do_not_depend_on_join_strategy(spark):
    def run():
        return _rows(point_in_time_features(
            fx.population(spark, SF_SMALL, distinct=False), fx.history(spark, SF_SMALL),
            fx.POPULATION_START, fx.POPULATION_END, since=fx.HISTORY_SINCE,
        ))

    expected = run()
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100MB")
        assert run() == expected
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert run() == expected
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
