"""Point-in-time features: every (entity, date) row of a population sees all of
the entity's history dated strictly before that date.

Four plan forms give identical results:

``prefix_sum`` (default)
    History is first reduced to one row per (entity, day) with a partial +
    final hash aggregate, so the map side combines before anything is
    shuffled and a hot entity shrinks to at most one row per day. Those
    daily rows are unioned with the distinct population keys and summed with
    a running window per entity, population rows sorting before same-day
    history. No pairs are formed: the work is linear in (days + dates) and
    each window partition holds at most one row per day per entity. The
    population is read once: each key carries its number of rows through the
    window and is then emitted that many times, so nothing is joined back.
``chunked``
    The same sums in two levels, for entities whose instants (TIMESTAMP
    population and history) are too many for one task: rows are sorted over
    range partitions, which cut a hot entity too; sums run inside a partition,
    and the totals of an entity's earlier partitions, at most one row for each
    partition, are added.
``join``
    Same daily rows, range-joined to the population keys on the entity
    (sort-merge, ``day < date`` as residual) and summed. Its join output is
    (dates x days) per entity; competitive for one-day windows.
``direct``
    The published formulation: raw history inner-joined to raw population
    rows and grouped. Kept as the brute-force reference for tests; its join
    output grows with history x dates and a hot entity stays in one task.

Population duplicates follow the published semantics: a (entity, date) row
present k times is emitted k times and its count/sum features are k times
larger (averages are unchanged). The pre-aggregated forms count k once per key
and multiply. The window forms generate the k rows in runs of ``COPIES``, never
holding them; the other forms join them back on (entity, date).

Expressions are written as SQL text (``selectExpr`` / ``F.expr``): the plan
is the same as with Column objects, but the driver builds it with far fewer
round trips to the JVM.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.features import FEATURES, Feature, select_features
from daybook.functions.flags import flag_sql, sql_ident, sql_str
from daybook.session import cut_lineage

DATE_FORMAT = "%Y-%m-%d"
METHODS = ("join", "prefix_sum", "chunked", "direct")
WINDOW_METHODS = ("prefix_sum", "chunked")
#: Rows of one population key that are generated at a time.
COPIES = 4096


def parse_day(value: str) -> _dt.date:
    """Validate a ``YYYY-MM-DD`` bound on the driver (raises ``ValueError``)."""
    return _dt.datetime.strptime(value, DATE_FORMAT).date()


def _range_sql(date_col: str, start: str, end: str) -> str:
    c = sql_ident(date_col)
    return f"{c} >= {sql_str(start)} AND {c} < {sql_str(end)}"


def _since_sql(start_col: str, since: str) -> str:
    return f"{sql_ident(start_col)} >= {sql_str(since)}"


def restrict_dates(df: DataFrame, start: str, end: str, date_col: str = "date") -> DataFrame:
    """Half-open range ``start <= date < end``; becomes a pushed or partition filter."""
    return df.where(_range_sql(date_col, start, end))


def history_since(history: DataFrame, since: str | None, start_col: str = "start_date") -> DataFrame:
    """Keep history rows starting on or after ``since``; NULL starts drop."""
    return history if since is None else history.where(_since_sql(start_col, since))


def fill_zero(df: DataFrame) -> DataFrame:
    """NULL and NaN in every numeric column become 0 / 0.0 (keys included);
    strings and booleans are left alone."""
    return df.fillna(0)


def population_left_join(
    population: DataFrame, features: DataFrame, keys: Sequence[str] = ("client_id", "date")
) -> DataFrame:
    """Keep every population row; keys are emitted once, first, in ``keys`` order."""
    return population.join(features, list(keys), "left")


def pit_join(
    history: DataFrame,
    population: DataFrame,
    entity: str = "client_id",
    date: str = "date",
    history_entity: str = "employer",
    history_date: str = "end_date",
) -> DataFrame:
    """Inner join of history rows to population rows with ``history_date < date``.

    NULL entities or dates never match. One output row per (history row,
    population row) pair, population duplicates included.
    """
    cond = (history[history_entity] == population[entity]) & (history[history_date] < population[date])
    return history.join(population, cond, "inner")


def _is_date(df: DataFrame, name: str, kind: type = T.DateType) -> bool:
    try:
        return isinstance(df.schema[name].dataType, kind)
    except KeyError:
        return False


def _flags_needed(specs: Iterable[Feature]) -> list[str]:
    seen: list[str] = []
    for f in specs:
        if f.flag and f.flag not in seen:
            seen.append(f.flag)
    return seen


def _sum_name(flag: str) -> str:
    return "__s_" + flag


def daily_history(
    history: DataFrame,
    flags: Sequence[str],
    history_entity: str = "employer",
    history_date: str = "end_date",
    answer_col: str = "contractor_recom_score_answer",
    outcome_col: str = "outcome",
    by_day: bool = False,
) -> DataFrame:
    """One row per (entity, day): row count ``__n`` and one sum per flag.

    Rows whose entity or day is NULL can never match and are dropped before
    the shuffle. The aggregate runs partial-then-final, so each map task
    ships at most one row per (entity, day) it saw. ``by_day`` takes the day of a
    timestamp; otherwise every instant is a day of its own.
    """
    exprs = flag_sql(answer_col, outcome_col)
    e, d = sql_ident(history_entity), sql_ident(history_date)
    return (
        history.where(f"{e} IS NOT NULL AND {d} IS NOT NULL")
        .selectExpr(f"{e} AS __e", f"{f'to_date({d})' if by_day else d} AS __d", *[f"{exprs[f]} AS {f}" for f in flags])
        .groupBy("__e", "__d")
        .agg(F.expr("count(1) AS __n"), *[F.expr(f"sum({f}) AS {_sum_name(f)}") for f in flags])
    )


def _per_key_join(keys: DataFrame, daily: DataFrame, flags: Sequence[str], entity: str, date: str) -> DataFrame:
    matched = keys.join(daily, (keys[entity] == daily["__e"]) & (daily["__d"] < keys[date]), "inner")
    return matched.groupBy(entity, date, "__k").agg(
        F.expr("sum(__n) AS __n"), *[F.expr(f"sum({_sum_name(f)}) AS {_sum_name(f)}") for f in flags]
    )


def _running_rows(keys: DataFrame, daily: DataFrame, flags: Sequence[str], entity: str, date: str) -> DataFrame:
    """Population keys (``__pop`` 1) and daily rows (0) as one sequence."""
    sums = [_sum_name(f) for f in flags]
    pop_rows = keys.selectExpr(
        f"{sql_ident(entity)} AS __e", f"{sql_ident(date)} AS __d", "__k",
        *[f"CAST(0 AS BIGINT) AS {c}" for c in ["__n", *sums]], "1 AS __pop",
    )
    hist_rows = daily.selectExpr("__e", "__d", "CAST(NULL AS BIGINT) AS __k", "__n", *sums, "0 AS __pop")
    return pop_rows.unionByName(hist_rows)


def _per_key_prefix_sum(keys: DataFrame, daily: DataFrame, flags: Sequence[str], entity: str, date: str) -> DataFrame:
    """Sums before each population key, all keys kept: one window over keys and daily rows."""
    sums = ["__n", *[_sum_name(f) for f in flags]]
    # Population rows sort before same-day history, so a running sum up to a
    # population row covers exactly the days strictly before its date.
    window = (
        "OVER (PARTITION BY __e ORDER BY __d ASC NULLS FIRST, __pop DESC "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    running = _running_rows(keys, daily, flags, entity, date).selectExpr(
        "__e", "__d", "__k", "__pop", *[f"sum({c}) {window} AS {c}" for c in sums]
    )
    return running.where("__pop = 1").selectExpr(f"__e AS {sql_ident(entity)}", f"__d AS {sql_ident(date)}", "__k", *sums)


def _per_key_chunked(keys: DataFrame, daily: DataFrame, flags: Sequence[str], entity: str, date: str) -> DataFrame:
    """As ``_per_key_prefix_sum``, in two levels over range partitions."""
    sums = ["__n", *[_sum_name(f) for f in flags]]
    rows = _running_rows(keys, daily, flags, entity, date)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_first("__e"), F.asc_nulls_first("__d"), F.desc("__pop")]
    rows = cut_lineage(rows.repartitionByRange(n, *order).withColumn("__c", F.spark_partition_id()), "pit-chunks")
    totals = rows.groupBy("__e", "__c").agg(*[F.sum(c).alias(c) for c in sums], F.count("*").alias("__rows"))
    earlier = "OVER (PARTITION BY __e ORDER BY __c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    before = totals.selectExpr("__e AS __be", "__c AS __bc", *[f"sum({c}) {earlier} AS __b{c}" for c in sums], f"sum(__rows) {earlier} AS __cut")
    before = before.where("__cut > 0").drop("__cut")  # an entity that continues into a partition: one for each at most
    window = "OVER (PARTITION BY __e, __c ORDER BY __d ASC NULLS FIRST, __pop DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    running = rows.selectExpr("__e", "__d", "__k", "__pop", "__c", *[f"sum({c}) {window} AS {c}" for c in sums]).where("__pop = 1")
    on = running["__e"].eqNullSafe(before["__be"]) & (running["__c"] == before["__bc"])
    return running.join(F.broadcast(before), on, "left").selectExpr(
        f"__e AS {sql_ident(entity)}", f"__d AS {sql_ident(date)}", "__k", *[f"{c} + coalesce(__b{c}, 0) AS {c}" for c in sums]
    )


def _copies(per_key: DataFrame) -> DataFrame:
    """Each key as many times as the population holds it (``__k``), in runs, so that no array grows with k."""
    runs = per_key.selectExpr("*", f"explode(sequence(0L, (__k - 1) div {COPIES})) AS __r")
    return runs.selectExpr("*", f"explode(sequence(1L, least({COPIES}L, __k - __r * {COPIES}))) AS __i").drop("__r", "__i")


def _feature_sql(f: Feature) -> str:
    name = sql_ident(f.name)
    if f.kind == "count":
        return f"__n * __k AS {name}"
    s = _sum_name(f.flag)
    if f.kind == "sum":
        return f"{s} * __k AS {name}"
    if f.kind == "avg":
        return f"CASE WHEN __n > 0 THEN CAST({s} / __n AS DOUBLE) END AS {name}"
    raise ValueError(f"unknown feature kind {f.kind!r}")


def pit_grouped(
    population: DataFrame,
    history: DataFrame,
    features: Sequence[Feature],
    *,
    method: str = "prefix_sum",
    entity: str = "client_id",
    date: str = "date",
    history_entity: str = "employer",
    history_date: str = "end_date",
    answer_col: str = "contractor_recom_score_answer",
    outcome_col: str = "outcome",
) -> DataFrame:
    """``groupBy(entity, date).agg(features)`` over the point-in-time join of
    ``history`` to ``population``: one row per distinct (entity, date) that
    has earlier history, population duplicates counted as the join would.

    The ``prefix_sum`` and ``join`` forms never group raw history by entity,
    so a hot entity costs at most one row per day after the map-side combine.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    flags = _flags_needed(features)
    if method == "direct":
        exprs = flag_sql(answer_col, outcome_col)
        flagged = history.selectExpr(
            f"{sql_ident(history_entity)} AS __e",
            f"{sql_ident(history_date)} AS __d",
            *[f"{exprs[f]} AS {f}" for f in flags],
        )
        rows = pit_join(flagged, population, entity, date, "__e", "__d")
        return rows.groupBy(entity, date).agg(*[F.expr(f.sql()) for f in features])
    by_day = _is_date(population, date) and _is_date(history, history_date, T.TimestampType)
    daily = daily_history(history, flags, history_entity, history_date, answer_col, outcome_col, by_day)
    per_key = _sums_per_key(population, daily, flags, method, entity, date).where("__n > 0")
    return per_key.selectExpr(sql_ident(entity), sql_ident(date), *[_feature_sql(f) for f in features])


def _sums_per_key(population: DataFrame, daily: DataFrame, flags: Sequence[str], method: str, entity: str, date: str) -> DataFrame:
    """(entity, date, ``__k``, ``__n``, sums): a row for each distinct population key; with ``join`` for
    those with earlier history."""
    keys = population.groupBy(entity, date).agg(F.expr("count(1) AS __k"))
    form = {"join": _per_key_join, "chunked": _per_key_chunked, "prefix_sum": _per_key_prefix_sum}[method]
    return form(keys, daily, flags, entity, date)


def point_in_time_features(
    population: DataFrame,
    history: DataFrame,
    start: str,
    end: str,
    features: Iterable[str] | None = None,
    *,
    registry: Sequence[Feature] = FEATURES,
    since: str | None = "2014-01-01",
    method: str = "prefix_sum",
    entity: str = "client_id",
    date: str = "date",
    history_entity: str = "employer",
    history_date: str = "end_date",
    history_start: str = "start_date",
    answer_col: str = "contractor_recom_score_answer",
    outcome_col: str = "outcome",
    carried: DataFrame | None = None,
    reduce_history: bool = False,
) -> DataFrame:
    """Feature table for population rows dated in ``[start, end)``.

    Output: ``entity, date`` then the selected features in the order asked,
    one row per population row, zeros where there is no earlier history
    (a NULL numeric entity becomes 0, as ``fillna(0)`` does). ``carried`` are
    ``running_totals`` before a day up to ``start``; ``history`` then holds the
    rows from that day on. ``reduce_history`` drops entities that the population
    lacks before the window, by a semi-join that reads the population's entities
    once more; it pays where few of the history's entities are asked for.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    specs = select_features(features, registry)
    parse_day(start)
    last_day = parse_day(end) - _dt.timedelta(days=1)

    pop = population.where(_range_sql(date, start, end)).select(date, entity)
    conds = []
    if since is not None:
        conds.append(_since_sql(history_start, since))
    if _is_date(population, date) and (_is_date(history, history_date) or _is_date(history, history_date, T.TimestampType)):
        # date < end and history_date < date imply history_date < end - 1 day;
        # Catalyst does not infer this through inequalities, so state it.
        conds.append(f"{sql_ident(history_date)} < DATE'{last_day.isoformat()}'")
    hist = history.where(" AND ".join(conds)) if conds else history

    names = dict(entity=entity, date=date, history_entity=history_entity, history_date=history_date, answer_col=answer_col, outcome_col=outcome_col)
    if method not in WINDOW_METHODS:
        if carried is not None:
            raise ValueError(f"carried totals need a method of {WINDOW_METHODS}")
        return fill_zero(population_left_join(pop, pit_grouped(pop, hist, specs, method=method, **names), (entity, date)))
    flags = _flags_needed(specs)
    # before a DATE, the instants before its midnight count: those of earlier days
    by_day = _is_date(population, date) and _is_date(history, history_date, T.TimestampType)
    daily = daily_history(hist, flags, history_entity, history_date, answer_col, outcome_col, by_day)
    if carried is not None:
        daily = daily.unionByName(carried.select("__e", "__d", "__n", *[_sum_name(f) for f in flags]))
    if reduce_history:  # after the daily aggregate, so that no raw hot entity is shuffled for the join
        wanted = pop.select(F.col(entity).alias("__w")).distinct()
        daily = daily.join(wanted, F.col("__e") == F.col("__w"), "left_semi")
    rows = _copies(_sums_per_key(pop, daily, flags, method, entity, date))
    return fill_zero(rows.selectExpr(sql_ident(entity), sql_ident(date), *[_feature_sql(f) for f in specs]))


ALL_FLAGS = tuple(flag_sql())


def running_totals(
    history: DataFrame,
    day: str,
    carried: DataFrame | None = None,
    *,
    since: str | None = "2014-01-01",
    history_entity: str = "employer",
    history_date: str = "end_date",
    history_start: str = "start_date",
    answer_col: str = "contractor_recom_score_answer",
    outcome_col: str = "outcome",
) -> DataFrame:
    """Totals of every entity over all history dated strictly before ``day``: ``__e``, ``__n``, a sum for
    each flag, and ``__d``, the day before ``day``, to which they are booked.

    ``carried`` are such totals of an earlier day: then only history from that day
    on is read. A row that arrives with a date before it is not looked at any more.
    A row with a NULL entity, matched by nothing, is always there and tells the day.
    """
    parse_day(day)
    spark = history.sparkSession
    conds = [f"{sql_ident(history_date)} < DATE'{day}'"]
    if since is not None:
        conds.append(_since_sql(history_start, since))
    sums = ["__n", *[_sum_name(f) for f in ALL_FLAGS]]
    if carried is not None:
        conds.append(f"{sql_ident(history_date)} >= DATE'{totals_day(carried)}'")
    daily = daily_history(history.where(" AND ".join(conds)), ALL_FLAGS, history_entity, history_date, answer_col, outcome_col, by_day=True)
    rows = daily.select("__e", *sums)
    kind = rows.schema["__e"].dataType.simpleString()
    rows = rows.unionByName(carried.select("__e", *sums) if carried is not None else spark.range(1).selectExpr(
        f"CAST(NULL AS {kind}) AS __e", *[f"CAST(0 AS BIGINT) AS {c}" for c in sums]
    ))
    totals = rows.groupBy("__e").agg(*[F.sum(c).alias(c) for c in sums])
    return totals.selectExpr("__e", f"DATE'{day}' - INTERVAL 1 DAY AS __d", *sums)


def totals_day(totals: DataFrame) -> str:
    """The day before which ``running_totals`` counted."""
    return totals.agg(F.expr("CAST(date_add(max(__d), 1) AS STRING)")).first()[0]
