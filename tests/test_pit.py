"""Point-in-time features: goldens, duplicate rule, plan-form equivalence, skew."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions.features import CORRECTED_FEATURES, FEATURES, select_features
from daybook.operators.pit import METHODS, point_in_time_features
from daybook.plans import fixtures as fx

from .conftest import SF_SMALL

D = dt.date


def _history(spark, rows):
    return spark.createDataFrame(
        [(e, D(2024, 1, 1), end, '{"answer":["20"]}', out) for e, end, out in rows],
        "employer bigint, start_date date, end_date date, contractor_recom_score_answer string, outcome string",
    )


def _population(spark, rows):
    return spark.createDataFrame(rows, "date date, client_id bigint")


GOLDEN_HISTORY = [
    (1, D(2024, 2, 7), "good"),
    (1, D(2024, 2, 8), "bad"),
    (2, None, "good"),
    (None, D(2024, 1, 1), "good"),
    (9, D(2024, 1, 1), "bad"),
]
GOLDEN_POP = [
    (D(2024, 2, 8), 1),
    (D(2024, 2, 9), 1),
    (D(2024, 2, 9), 1),
    (D(2024, 2, 8), 3),
    (D(2024, 2, 8), None),
]
FEATS = ["cl_count_of_hire_v1", "cl_count_of_outcome_is_good_v1", "cl_avg_of_outcome_is_good_v1"]


@pytest.mark.parametrize("method", METHODS)
def test_point_in_time_goldens(spark, method):
    out = point_in_time_features(
        _population(spark, GOLDEN_POP), _history(spark, GOLDEN_HISTORY), "2024-02-01", "2024-03-01",
        FEATS, method=method,
    )
    assert out.columns == ["client_id", "date", *FEATS]
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted([
        (1, D(2024, 2, 8), 1, 1, 1.0),       # same-day event excluded
        (1, D(2024, 2, 9), 4, 2, 0.5),       # twice present: counts doubled, avg kept
        (1, D(2024, 2, 9), 4, 2, 0.5),
        (3, D(2024, 2, 8), 0, 0, 0.0),       # no history -> zeros
        (0, D(2024, 2, 8), 0, 0, 0.0),       # NULL numeric key filled with 0
    ])


def test_types_follow_registry(spark):
    out = point_in_time_features(
        _population(spark, GOLDEN_POP), _history(spark, GOLDEN_HISTORY), "2024-02-01", "2024-03-01"
    )
    types = dict(out.dtypes)
    assert [c for c in out.columns[2:]] == [f.name for f in FEATURES]
    for f in FEATURES:
        assert types[f.name] == ("double" if f.kind == "avg" else "bigint")
    assert types["client_id"] == "bigint" and types["date"] == "date"


def _fixture_features(spark, method, distinct=True, **kw):
    return point_in_time_features(
        fx.population(spark, SF_SMALL, distinct=distinct), fx.history(spark, SF_SMALL),
        fx.POPULATION_START, fx.POPULATION_END, since=fx.HISTORY_SINCE, method=method, **kw,
    )


def _rows(df):
    return sorted(tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("distinct", [True, False])
def test_plan_forms_agree_on_fixture(spark, distinct):
    direct = _rows(_fixture_features(spark, "direct", distinct))
    assert _rows(_fixture_features(spark, "join", distinct)) == direct
    assert _rows(_fixture_features(spark, "prefix_sum", distinct)) == direct


def test_fixture_totals(spark):
    df = _fixture_features(spark, "join")
    r = df.agg(
        F.count("*").alias("rows"),
        F.sum((F.col("cl_count_of_hire_v1") == 0).cast("int")).alias("zero"),
        F.sum("cl_count_of_hire_v1").alias("hire"),
        F.sum("cl_count_of_client_weakness_is_unclear_requirements_v1").alias("unclear"),
        F.sum("cl_count_of_client_weakness_is_poor_communication_v1").alias("poor"),
        F.sum("cl_count_of_client_weakness_is_something_else_v1").alias("other"),
        F.sum("cl_count_of_outcome_is_good_v1").alias("good"),
        F.sum("cl_count_of_outcome_is_neutral_v1").alias("neutral"),
        F.sum("cl_count_of_outcome_is_bad_v1").alias("bad"),
    ).first()
    assert tuple(r) == (135, 5, 443, 141, 135, 141, 145, 149, 149)


def test_outcome_counts_add_up_to_hire(spark):
    df = _fixture_features(spark, "join", distinct=False)
    bad = df.where(
        F.col("cl_count_of_outcome_is_good_v1") + F.col("cl_count_of_outcome_is_neutral_v1")
        + F.col("cl_count_of_outcome_is_bad_v1") != F.col("cl_count_of_hire_v1")
    )
    assert bad.count() == 0


def test_corrected_registry_uses_unclear_flag(spark):
    published = _fixture_features(spark, "join")
    corrected = _fixture_features(spark, "join", registry=CORRECTED_FEATURES)
    name = "cl_count_of_client_weakness_is_unclear_requirements_v1"
    assert published.agg(F.sum(name)).first()[0] == published.agg(
        F.sum("cl_count_of_client_weakness_is_something_else_v1")).first()[0]
    assert corrected.agg(F.sum(name)).first()[0] != published.agg(F.sum(name)).first()[0]


def test_feature_selection_skips_unknown_keeps_order():
    chosen = select_features(["cl_avg_of_outcome_is_bad_v1", "nope", "cl_count_of_hire_v1"])
    assert [f.name for f in chosen] == ["cl_avg_of_outcome_is_bad_v1", "cl_count_of_hire_v1"]
    with pytest.raises(ValueError):
        select_features(["nope"])


def test_bad_date_bound_raises(spark):
    with pytest.raises(ValueError):
        point_in_time_features(_population(spark, GOLDEN_POP), _history(spark, GOLDEN_HISTORY), "2024/02/01", "2024-03-01")


def test_hot_entity_and_hot_key_match_brute_force(spark):
    """One employer holds most history and one (client, date) most population rows."""
    hist = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(7)).cast("bigint").alias("employer"),
        F.lit("2020-01-01").cast("date").alias("start_date"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("end_date"),
        F.concat(F.lit('{"answer":["'), (F.col("id") % 5 + 17).cast("string"), F.lit('"]}'))
        .alias("contractor_recom_score_answer"),
        F.element_at(F.array(F.lit("good"), F.lit("neutral"), F.lit("bad")), (F.col("id") % 3 + 1).cast("int"))
        .alias("outcome"),
    )
    pop = spark.range(5000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.when(F.col("id") < 3000, 0).otherwise(F.col("id") % 9).cast("int"))
        .alias("date"),
        F.when(F.col("id") < 3000, F.lit(7)).otherwise(F.col("id") % 60).cast("bigint").alias("client_id"),
    )
    args = (pop, hist, "2023-06-01", "2024-01-10")
    direct = _rows(point_in_time_features(*args, method="direct"))
    assert _rows(point_in_time_features(*args, method="join")) == direct
    assert _rows(point_in_time_features(*args, method="prefix_sum")) == direct
    assert len(direct) == 5000


def test_grouped_forms_agree_with_groupby_over_join(spark):
    """pit_grouped equals groupBy over the raw point-in-time join, duplicates included."""
    from daybook.functions.features import Feature
    from daybook.operators.pit import pit_grouped, pit_join

    feats = [Feature("n", "count"), Feature("g", "sum", "outcome_is_good"), Feature("r", "avg", "outcome_is_good")]
    pop = _population(spark, GOLDEN_POP)
    hist = _history(spark, GOLDEN_HISTORY).withColumn("outcome_is_good", (F.col("outcome") == "good").cast("int"))
    brute = _rows(pit_join(hist, pop).groupBy("client_id", "date").agg(
        F.count("*").alias("n"), F.sum("outcome_is_good").alias("g"), F.avg("outcome_is_good").alias("r")))
    for method in METHODS:
        assert _rows(pit_grouped(pop, hist, feats, method=method)) == brute, method


def test_hot_population_key_is_emitted_in_runs(spark):
    from daybook.operators import pit

    pop = spark.range(10_000).selectExpr("DATE'2024-02-09' AS date", "1L AS client_id").unionByName(
        _population(spark, [(D(2024, 2, 9), 2), (None, 1)])
    )
    out = point_in_time_features(pop, _history(spark, GOLDEN_HISTORY), "2024-02-01", "2024-03-01", FEATS)
    rows = out.groupBy(*out.columns).count().collect()
    assert sorted(tuple(r) for r in rows) == [(1, D(2024, 2, 9), 20_000, 10_000, 0.5, 10_000), (2, D(2024, 2, 9), 0, 0, 0.0, 1)]
    runs = pit._copies(spark.range(3).selectExpr("id", f"id * {pit.COPIES} + 1 AS __k"))
    assert sorted((r.id, r["count"]) for r in runs.groupBy("id").count().collect()) == [(i, i * pit.COPIES + 1) for i in range(3)]


def test_instants_of_a_hot_entity_spread_over_chunks(spark, monkeypatch):
    from daybook.operators import pit

    instant = "TIMESTAMP'2024-02-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, {})"
    hist = spark.range(6000).selectExpr(
        "IF(id % 6 = 0, id % 97, 1L) AS employer", "DATE'2024-01-01' AS start_date", f"{instant.format('id')} AS end_date",
        "CAST(NULL AS STRING) AS contractor_recom_score_answer", "IF(id % 2 = 0, 'good', 'bad') AS outcome",
    )
    pop = spark.range(3000).selectExpr(f"{instant.format('2 * id')} AS date", "IF(id % 3 = 0, id % 97, 1L) AS client_id")
    chunks, cut = [], pit.cut_lineage
    monkeypatch.setattr(pit, "cut_lineage", lambda df, name: chunks.append(cut(df, name)) or chunks[-1])
    got = point_in_time_features(pop, hist, "2024-02-01", "2024-03-01", FEATS, method="chunked")
    want = point_in_time_features(pop, hist, "2024-02-01", "2024-03-01", FEATS, method="direct")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    sizes = [r["count"] for r in chunks[0].groupBy("__e", "__c").count().collect()]
    assert max(sizes) < 0.5 * chunks[0].count()  # the hot entity has 7,000 of 9,000 rows
