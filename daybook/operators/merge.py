"""Key-based merge (upsert) of a DataFrame into a Parquet table.

Semantics of ``MERGE INTO t USING s ON t.k = s.k WHEN MATCHED THEN UPDATE
SET <update_cols> WHEN NOT MATCHED THEN INSERT *``:

* keys compare with plain ``=``: a NULL key never matches and such a source
  row is inserted (again on every run);
* a target row matched by more than one source row is an error; duplicate
  source keys that match nothing are all inserted;
* matched rows take ``update_cols`` from the source and keep every other
  column; unmatched target rows are kept as they are.

Plan:

1. Source keys are collapsed to one row per key with its update values and its
   number of source rows (partial aggregate: a hot key collapses map side).
2. One join of the target's keys, partition and update columns with them tells,
   per partition, whether a value would change and whether a target row has
   several matches; source rows without a match tell where rows are inserted.
   The touched partitions, a few values each, are kept in a staging table.
3. Only touched partitions are read whole, merged and written back with a dynamic
   partition overwrite: a merge that changes nothing writes nothing.

Partition values never pass through Python. The target scan is pruned by the
least and greatest touched value of each partition column, rendered and parsed
by Spark, and made exact by a null-safe semi-join. When the keys don't include
every partition column, matches may lie in any partition and step 2 reads the
target's keys in full. ``''`` in a string partition column is NULL there, as
in Spark's own writes. An unpartitioned target is written anew and swapped in.

A target that is bucketed by keys (``create_table(..., bucket_by=)``) is joined
where its buckets lie: the source is dealt as the buckets are, and the target's
rows are not shuffled in steps 2 and 3, until the touched partitions are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.flags import sql_ident
from daybook.operators.catalog import partition_columns, table_info
from daybook.operators.tables import align_to_table, bucketing, overwrite_partitions, replace_rows, session_conf, staged

#: Touched partitions up to which their list is broadcast to a bucketed target; beyond, a shuffle join finds them.
BROADCAST_PARTITIONS = 10_000
#: A join on more keys than the bucket columns may keep the buckets.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


class MergeCardinalityError(ValueError):
    """A target row matched more than one source row."""


def _all(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


def _nullable_parts(df: DataFrame, part_cols: Sequence[str]) -> DataFrame:
    """'' in a string partition column becomes NULL, which is how it is stored."""
    strings = [p for p in part_cols if isinstance(df.schema[p].dataType, T.StringType)]
    return df.withColumns({p: F.expr(f"nullif({sql_ident(p)}, '')") for p in strings}) if strings else df


def _within(
    target: DataFrame, parts: DataFrame, part_cols: Sequence[str], nulls: bool = True, exact: bool = True, small: bool = False
) -> DataFrame:
    """Rows of ``target`` whose partition is among the rows of ``parts``.

    The range of each column prunes partitions statically; the semi-join is
    exact, and left out if ``exact`` is False. ``small``: ``parts`` may be broadcast. Bounds travel as text (timestamps as microseconds since the epoch),
    made and read by Spark, so neither time zones nor types change them.
    """
    conds, wanted = [], []
    for p in part_cols:
        kind, c = target.schema[p].dataType, sql_ident(p)
        if isinstance(kind, T.TimestampType):
            make, parse = "unix_micros({})", "timestamp_micros({})"
        elif isinstance(kind, (T.DateType, T.TimestampNTZType, T.IntegralType, T.DecimalType, T.StringType)):
            make, parse = "{}", f"CAST('{{}}' AS {kind.simpleString()})"
        else:
            continue
        wanted += [f"CAST({make.format(f'{f}({c})')} AS STRING)" for f in ("min", "max")]
        conds.append((c, parse))
    bounds = parts.selectExpr(*[f"{e} AS b{i}" for i, e in enumerate(wanted)]).first() if wanted else ()
    for k, (c, parse) in enumerate(conds):
        low, high = bounds[2 * k], bounds[2 * k + 1]
        empty = f"{c} IS NULL" if nulls else "FALSE"
        if low is None:
            target = target.where(empty)
        else:
            low, high = (parse.format(v.replace("\\", "\\\\").replace("'", "\\'")) for v in (low, high))
            target = target.where(f"{empty} OR {c} BETWEEN {low} AND {high}")
    if not exact:
        return target
    keys = parts.select(*[F.col(p).alias("__p_" + p) for p in part_cols]).distinct()
    keys = F.broadcast(keys) if small else keys
    on = [target[p].eqNullSafe(keys["__p_" + p]) if nulls else target[p] == keys["__p_" + p] for p in part_cols]
    return target.join(keys, _all(on), "left_semi")


def source_by_key(source: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """One row for each key without NULLs: update values and ``__c``, its number of source rows."""
    return (
        source.where(_all([F.col(k).isNotNull() for k in keys]))
        .groupBy(*[F.col(k).alias("__s_" + k) for k in keys])
        .agg(F.count(F.lit(1)).alias("__c"), *[F.first(c).alias("__u_" + c) for c in update_cols])
    )


def merged_rows(target: DataFrame, by_key: DataFrame, new: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """The rows of ``target`` after the merge, and the rows to insert (lazy).

    Every target row is streamed once against the collapsed source, so a hot key
    is never held whole in one task and AQE may split skewed partitions. The
    presence of ``__c``, not a value, tells a match: NULL update values are
    applied as values. NULL keys never match.
    """
    cols = target.columns
    on = _all([target[k] == by_key["__s_" + k] for k in keys])
    kept = target.join(by_key, on, "left").selectExpr(*[
        f"CASE WHEN __c IS NOT NULL THEN {sql_ident('__u_' + c)} ELSE {sql_ident(c)} END AS {sql_ident(c)}"
        if c in update_cols else sql_ident(c)
        for c in cols
    ])
    return kept.unionByName(new.select(*cols))


def merge_into(
    source: DataFrame,
    target: str,
    keys: Sequence[str] = ("date", "client_id"),
    update_cols: Sequence[str] = ("cl_count_of_hire_v1",),
    persist_source: bool = False,
) -> None:
    """Merge ``source`` into table ``target``. The source is read for the touched
    partitions and again for the merge; pass ``persist_source=True`` when it is
    an expensive computation rather than a table scan. ``update_cols`` may not
    hold partition columns."""
    spark = source.sparkSession
    if persist_source:
        source = source.persist()
    try:
        _merge(spark, source, target, keys, update_cols)
    finally:
        if persist_source:
            source.unpersist()


def _merge(spark, source: DataFrame, target: str, keys: Sequence[str], update_cols: Sequence[str]) -> None:
    table = spark.table(target)
    names = {c.lower(): c for c in table.columns}
    missing = [c for c in [*keys, *update_cols] if c.lower() not in names]
    if missing:
        raise ValueError(f"columns not in {target}: {missing}")
    keys, update_cols = [names[k.lower()] for k in keys], [names[c.lower()] for c in update_cols]
    part_cols = partition_columns(spark, target)
    if set(part_cols) & set(update_cols):
        raise ValueError(f"partition columns can't be updated: {sorted(set(part_cols) & set(update_cols))}")
    src = align_to_table(source.select(*[c for c in source.columns if c.lower() in names]), target)
    src = _nullable_parts(src, part_cols)
    by_key = source_by_key(src, keys, update_cols)
    buckets = bucketing(table_info(spark, target))
    if not buckets or not set(buckets[1]) <= set(keys):
        buckets = None

    keyed = [p for p in part_cols if p in keys]  # matches lie in the source's values of these
    # the join on the keys is exact; a shuffle by partition would only take a bucketed target's rows apart
    candidates = _within(table, src, keyed, nulls=False, exact=not buckets) if keyed else table
    target_keys = candidates.select(*[F.col(k).alias("__t_" + k) for k in keys]).distinct()
    if buckets:
        by_key = by_key.repartition(buckets[0], *["__s_" + b for b in buckets[1]])
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        probed, unmatched = src.where(~null).repartition(buckets[0], *buckets[1]), src.where(null)  # NULL keys never match
    else:
        probed, unmatched = src, None
    on = _all([candidates[k] == by_key["__s_" + k] for k in keys])
    differs = " OR ".join(f"NOT ({sql_ident(c)} <=> {sql_ident('__u_' + c)})" for c in update_cols) or "FALSE"
    changed = candidates.join(by_key, on).groupBy(*part_cols).agg(
        F.expr(f"bool_or({differs})").alias("__change"), F.max("__c").alias("__c")
    )
    new = probed.join(target_keys, _all([probed[k] == target_keys["__t_" + k] for k in keys]), "left_anti")
    new = new.unionAll(unmatched) if unmatched is not None else new
    inserted = new.groupBy(*part_cols).agg(F.lit(True).alias("__change"), F.lit(0).cast("bigint").alias("__c"))
    with session_conf(spark, ALL_KEYS, "false") if buckets else nullcontext(), staged(changed.unionAll(inserted), target) as touched:
        state = touched.agg(F.max("__c"), F.count(F.when(F.col("__change"), 1))).first()
        if (state[0] or 0) > 1:
            raise MergeCardinalityError(f"MERGE: a target row matched more than one source row on {list(keys)}")
        if not state[1]:
            return
        if part_cols:
            small = bool(buckets) and state[1] <= BROADCAST_PARTITIONS
            rows = _within(table, touched.where("__change"), part_cols, small=small)
            overwrite_partitions(merged_rows(rows, by_key, new, keys, update_cols), target)
        else:
            replace_rows(merged_rows(table, by_key, new, keys, update_cols), target)
