"""Prefix trie of conversations, built as a distributed burst trie.

A node is a distinct sequence of first turns. Turns get ids; a conversation is the
sequence of its turns' ids. Equal sequences are collapsed first, so copies cost one.
The rest starts as one container of suffixes under the root. A container of more
than ``capacity`` turns bursts: the turns that all its suffixes share next become
trie nodes, and the suffixes move to containers by the id of the turn after
them. This repeats, one Spark round for all oversized containers together, until
every container fits. Containers are then dealt to tasks, their suffixes sorted,
and swept into nodes in one pass with a stack. What containers hold (leaves, saved
tokens) is added to the burst nodes above them by one aggregate over their paths.

Hot keys: a first turn, or any prefix, that a third of all conversations share is
counted by partial aggregates and burst, never gathered. A conversation of a third
of all turns is numbered across tasks (range partitions and offsets); alone in its
container it is never gathered either, its nodes are made row by row. A task holds
at most ``capacity`` turns. A round looks at ``LOOK`` turns first and twice as many
each further round, so long shared runs take few rounds; the number of rounds
otherwise follows the branchings above oversized containers.

Turn ids are 120 bits of a SHA-256 digest of role and text; equal sequences are told
by the length and two 64-bit hashes over all (place, turn id).

Turns come in order of ``turn`` (null first), equal ones in order of their id. Null
roles and texts are empty. Rows without conv_id take no part. Repeated rows are
turns of their own. An empty table has no nodes, not even a root. Columns other
than the four read are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import written

#: Turns that one container may hold.
CAPACITY = 20_000
#: Turns that the first round looks ahead, and the most that any round does.
LOOK, MOST_LOOK = 32, 4096
#: Ids that one text of a member list holds.
LISTED = 8192

EMPTY = hashlib.sha256(b"").hexdigest()
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_NAMES = [c.split()[0] for c in NODES.split(", ")]


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part`` and the row's number within its conversation in this partition, whose rows are sorted."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.diff(conv)) + 1
        first = np.r_[0, starts]
        number = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
        if last is not None and conv[0] == last:
            number[: starts[0] if len(starts) else n] += count
        last, count = conv[-1], int(number[-1]) + 1
        yield pa.record_batch(
            [batch.column("conv_id"), pa.array(np.full(n, part, np.int32)), pa.array(number), *[batch.column(c) for c in ("t1", "t2", "chars")]],
            ["conv_id", "part", "number", "t1", "t2", "chars"],
        )


def turn_rows(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, t1, t2, chars): every turn's place, id and code points; and (conv_id, len).

    Turns are sorted over range partitions, which cut a hot conversation too; the
    offset of a conversation that began in an earlier partition is the sum of its
    rows there, at most one for each partition.
    """
    n = _parts(conversations)
    digest = "sha2(concat(length(role), ':', role, text), 256)"
    turns = (
        conversations.where("conv_id IS NOT NULL")
        .selectExpr("CAST(conv_id AS BIGINT) AS conv_id", "CAST(turn AS BIGINT) AS turn",
                    "coalesce(CAST(role AS STRING), '') AS role", "coalesce(CAST(text AS STRING), '') AS text")
        .selectExpr("conv_id", "turn", f"{digest} AS h", "char_length(text) AS chars", "spark_partition_id() AS salt")
        .selectExpr("conv_id", "turn", "CAST(conv(substr(h, 1, 15), 16, 10) AS BIGINT) AS t1",
                    "CAST(conv(substr(h, 16, 15), 16, 10) AS BIGINT) AS t2", "chars", "salt")
    )
    key = ["conv_id", F.asc_nulls_first("turn"), "t1", "t2", "salt"]  # salt: many equal rows still spread
    rows = written(
        turns.repartitionByRange(n, *key).sortWithinPartitions(*key).mapInArrow(
            _numbered, "conv_id long, part int, number long, t1 long, t2 long, chars int"
        ),
        "trie-turns",
    )
    counts = rows.groupBy("conv_id", "part").agg((F.max("number") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("before", before).where("before > 0").select("conv_id", "part", "before")  # one a partition at most
    placed = rows.join(F.broadcast(offsets), ["conv_id", "part"], "left").selectExpr(
        "conv_id", "number + coalesce(before, 0) AS pos", "t1", "t2", "chars"
    )
    return placed, counts.groupBy("conv_id").agg(F.sum("n").alias("len"))


def rebuilt(turns: DataFrame, convs: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Every conversation with its head taken from its block: the first h turns of conversation
    ``c - c % block`` (all if fewer), then its own after its first h; h is the unsigned crc32 of the
    decimal id modulo ``most``. One row a turn, and one of ``pos`` -1 for every conversation."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    info = convs.withColumns({"h": h, "block": F.col("conv_id") - F.col("conv_id") % block})
    firsts = convs.where(F.col("conv_id") % block == 0).selectExpr("conv_id AS block", "len AS held")
    info = info.join(firsts, "block", "left").selectExpr("conv_id", "block", "h", "least(h, coalesce(held, 0)) AS taken")
    heads = turns.where((F.col("conv_id") % block == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "block")
    cols = ["conv_id", "pos", "t1", "t2", "chars"]
    lent = info.join(heads, "block").where("pos < taken").select(*cols)  # a head serves its block alone
    own = turns.join(info, "conv_id").where("pos >= h").selectExpr("conv_id", "pos - h + taken AS pos", "t1", "t2", "chars")
    every = info.selectExpr("conv_id", "CAST(-1 AS BIGINT) AS pos", "CAST(0 AS BIGINT) AS t1", "CAST(0 AS BIGINT) AS t2", "0 AS chars")
    return lent.unionByName(own).unionByName(every)


# -- equal sequences ---------------------------------------------------------------


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of members of one group as texts; the partition is sorted by group and member."""
    for batch in batches:
        rep, conv = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "conv_id"))
        at = np.unique(np.r_[0, np.flatnonzero(np.diff(rep)) + 1, np.arange(0, len(rep), LISTED), len(rep)]).tolist()
        cuts = list(zip(at[:-1], at[1:], strict=True))
        yield pa.record_batch([
            pa.array([rep[a] for a, _ in cuts], pa.int64()), pa.array([conv[a] for a, _ in cuts], pa.int64()),
            pa.array([",".join(map(str, conv[a:b].tolist())) for a, b in cuts], pa.string()),
        ], ["rep", "first", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each group's texts in order, one text in memory at a time."""
    last, state = None, None

    def done():
        return pa.record_batch([pa.array([last], pa.int64()), pa.array([state.hexdigest()])], ["rep", "ends"])

    for batch in batches:
        for rep, ids in zip(batch.column("rep").to_pylist(), batch.column("ids"), strict=True):
            if rep != last:
                if state is not None:
                    yield done()
                last, state = rep, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_py().encode())
    if state is not None:
        yield done()


def distinct_sequences(rows: DataFrame) -> DataFrame:
    """(rep, len, k, ends) of every distinct sequence: its smallest conversation, its turns, its
    conversations, and the digest of their ids in ascending order, comma-joined."""
    n = _parts(rows)
    seqs = written(
        rows.groupBy("conv_id").agg(
            F.expr("count_if(pos >= 0) AS len"), F.expr("bit_xor(xxhash64(pos, t1, t2)) AS x1"), F.expr("bit_xor(xxhash64(t2, pos, 'b', t1)) AS x2")
        ),
        "trie-sequences",
    )
    same = ["len", "x1", "x2"]
    groups = written(seqs.groupBy(*same).agg(F.min("conv_id").alias("rep"), F.count("*").alias("k")), "trie-groups")
    members = seqs.join(groups.where("k > 1"), same).select("rep", "conv_id")
    ends = (
        members.repartitionByRange(n, "rep", "conv_id").sortWithinPartitions("rep", "conv_id")
        .mapInArrow(_listed, "rep long, first long, ids string")
        .repartition(n, "rep").sortWithinPartitions("rep", "first").mapInArrow(_digested, "rep long, ends string")
    )
    return groups.join(ends, "rep", "left").selectExpr(
        "rep", "len", "k", "coalesce(ends, sha2(CAST(rep AS STRING), 256)) AS ends"
    )


# -- containers ----------------------------------------------------------------------


def sweep(items: list[tuple], conv: int, depth: int, parent: int | None, head_chars: int) -> list[list]:
    """The nodes of one container, its head included: rows in the order of ``NODES``.

    ``items`` are (turn ids after the head, code points of these, smallest conversation,
    number of conversations, digest of their ids). Sorted suffixes are read once; the
    stack holds the nodes of the present path, and a node closes when the next
    suffix leaves it.
    """
    items.sort(key=lambda x: x[0])
    # a node: depth, code points, conv_id, n_convs, n_children, n_leaves, saved, ends, parent node
    stack = [[depth, head_chars, None, 0, 0, 0, 0, None, None]]
    closed = []

    def close():
        node = stack.pop()
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * node[1]
        closed.append(node)
        if stack:
            up = node[8] = stack[-1]
            up[2] = node[2] if up[2] is None else min(up[2], node[2])
            up[3] += node[3]
            up[4] += 1
            up[5] += node[5]
            up[6] += node[6]

    last: tuple = ()
    for ids, chars, rep, k, ends in items:
        common = 0
        for x, y in zip(last, ids):  # noqa: B905
            if x != y:
                break
            common += 1
        while len(stack) > common + 1:
            close()
        for i in range(common, len(ids)):
            stack.append([depth + i + 1, chars[i], None, 0, 0, 0, 0, None, None])
        top = stack[-1]
        top[2] = rep if top[2] is None else min(top[2], rep)
        top[3] += k
        top[7] = ends
        last = ids
    while stack:
        close()
    return [[x[2], x[0], x[8][2] if x[8] else parent, x[3], x[4], x[5], x[6], x[7] or EMPTY] for x in closed]


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers of a partition, sorted by container, conversation and place."""
    types = [pa.int64()] * 7 + [pa.string()]
    out: list[list] = []
    container, items, head_chars = None, [], 0

    def batch_of(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], _NAMES)

    rep = None
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("m", "d", "pm", "rep", "k", "ends", "pos", "t1", "t2", "chars")]
        for m, d, pm, r, k, ends, pos, t1, t2, chars in zip(*cols, strict=True):
            if container != (m, d, pm):
                if container:
                    out += sweep([(tuple(i), *x) for i, *x in items], *container, head_chars)
                    if len(out) > 50_000:
                        yield batch_of(out)
                        out = []
                container, items, head_chars, rep = (m, d, pm), [], 0, None
            if r != rep:
                rep = r
                items.append(([], [], r, k, ends))
            if pos is None:
                continue
            if pos < d:
                head_chars = chars
            else:
                items[-1][0].append((t1, t2))
                items[-1][1].append(chars)
    if container:
        out += sweep([(tuple(i), *x) for i, *x in items], *container, head_chars)
    if out:
        yield batch_of(out)


def burst_trie(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Nodes of all conversations of ``rows`` (conv_id, pos, t1, t2, chars; pos -1 for every conversation)."""
    spark = rows.sparkSession
    rows = written(rows, "trie-rows")
    reps = written(distinct_sequences(rows), "trie-distinct")
    turns = rows.where("pos >= 0").withColumnRenamed("conv_id", "c")
    first, n_reps, size = reps.agg(F.min("rep"), F.count("*"), F.sum("len")).first()
    if not n_reps:
        return spark.createDataFrame([], NODES)
    # a rep's container: m and d, the smallest conversation and depth of its head; pm, the head's parent
    place = reps.selectExpr(
        "rep", "k", "len", f"CAST({first} AS BIGINT) AS m", "CAST(0 AS BIGINT) AS d", "CAST(NULL AS BIGINT) AS pm",
        "CAST(array() AS array<struct<m:bigint,d:bigint>>) AS path", f"{n_reps > 1} AS several", f"{size > capacity} AS big",
    )
    if size > capacity:
        place = written(place, "trie-place")
    settled, heads, look = [], [], LOOK
    while True:
        settled.append(place.where("NOT (big AND several)"))
        active = place.where("big AND several")
        if active.isEmpty():
            break
        # the turns that all suffixes of a container share: up to the first place where one ends or differs
        info = active.groupBy("m", "d").agg(
            F.first("pm").alias("pm"), F.first("path").alias("path"), F.count("*").alias("reps"), F.sum("k").alias("n")
        )
        near = active.select("rep", "m", "d").join(turns, F.expr(f"rep = c AND pos >= d AND pos < d + {look}"))
        split = (
            near.groupBy("m", "d", "pos")
            .agg(F.expr("min(t1) <> max(t1) OR min(t2) <> max(t2) AS differ"), F.count("*").alias("held"))
            .join(info.select("m", "d", "reps"), ["m", "d"]).where("differ OR held < reps")
            .groupBy("m", "d").agg(F.min("pos").alias("b"))
        )
        head = written(info.join(split, ["m", "d"], "left").withColumn("b", F.expr(f"coalesce(b, d + {look})")), "trie-heads")
        heads.append(head)
        going = active.join(head.select("m", "d", "b"), ["m", "d"])
        ended = going.where("len = b").select("m", "d", "rep")
        next_turn = going.where("len > b").join(turns.select("c", "pos", "t1", "t2"), F.expr("rep = c AND pos = b"))
        child = next_turn.groupBy("m", "d", "t1", "t2").agg(
            F.min("rep").alias("cm"), F.expr("count(1) > 1 AS cs"), F.expr(f"sum(len - b - 1) > {capacity} AS cb")
        )
        moved = next_turn.drop("several", "big").join(child, ["m", "d", "t1", "t2"]).selectExpr(
            "rep", "k", "len", "cm AS m", "b + 1 AS d", "m AS pm", "concat(path, array(named_struct('m', m, 'd', d))) AS path",
            "cs AS several", "cb AS big",
        )
        heads[-1] = (head, written(ended, "trie-ended"))
        place = written(moved, "trie-place")
        look = min(2 * look, MOST_LOOK)

    placed = reduce(DataFrame.unionAll, settled)
    ends = reps.select("rep", "ends")
    # containers that fit: their turns, from the head's last one on
    small = placed.where("NOT big").drop("len", "several", "big", "path").join(ends, "rep")
    held = small.join(turns, F.expr("rep = c AND pos >= d - 1"), "left").drop("c")
    held = held.withColumn("ends", F.expr("CASE WHEN pos IS NULL OR pos = greatest(d - 1, 0) THEN ends END"))
    nodes = held.repartition("m", "d").sortWithinPartitions("m", "d", "rep", "pos").mapInArrow(_swept, NODES)
    parts = [nodes]
    if size > capacity:
        nodes = parts[0] = written(nodes, "trie-swept")
        parts.append(_alone(placed, turns, ends))
        if heads:
            parts.append(_burst(heads, placed, parts[0].unionAll(parts[1]), turns, ends))
    return reduce(DataFrame.unionAll, parts)


def _below(df: DataFrame) -> DataFrame:
    """``below``: the sum of ``own`` over the rows of a container from each row's place on, in two
    levels: totals of chunks, then sums within a chunk, so that a long chain spreads over tasks."""
    chunked = df.withColumn("chunk", F.expr("pos div 4096"))
    totals = chunked.groupBy("m", "d", "chunk").agg(F.sum("own").alias("total"))
    after = F.sum("total").over(Window.partitionBy("m", "d").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1))
    within = F.sum("own").over(Window.partitionBy("m", "d", "chunk").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0))
    later = totals.withColumn("after", F.coalesce(after, F.lit(0))).drop("total")
    return chunked.withColumn("within", within).join(later, ["m", "d", "chunk"]).withColumn("below", F.col("within") + F.col("after"))


def _chain(heads: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each node of a run without branching: those of depth d to b on the path of conversation m."""
    at = heads.join(turns.select("c", "pos", "chars"), F.expr("m = c AND pos >= d - 1 AND pos < b")).drop("c")
    root = heads.where("d = 0").withColumns({"pos": F.lit(-1).cast("long"), "chars": F.lit(0)})
    return at.unionByName(root).withColumn("own", F.expr("(n - 1) * chars"))


def _alone(placed: DataFrame, turns: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes of oversized containers that hold one sequence."""
    heads = placed.where("big AND NOT several").selectExpr("m", "d", "pm", "rep", "k AS n", "len AS b")
    return _below(_chain(heads, turns)).join(ends, "rep").selectExpr(
        "m AS conv_id", "pos + 1 AS depth", "CASE WHEN pos + 1 = d THEN pm ELSE m END AS parent_conv_id", "n AS n_convs",
        "CAST(IF(pos + 1 < b, 1, 0) AS BIGINT) AS n_children", "CAST(1 AS BIGINT) AS n_leaves", "CAST(below AS BIGINT) AS saved_tokens",
        f"CASE WHEN pos + 1 = b THEN ends ELSE '{EMPTY}' END AS ends_sha256",
    )


def _burst(rounds: list[tuple[DataFrame, DataFrame]], placed: DataFrame, nodes: DataFrame, turns: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes of burst containers: the shared run down to the branching, with what lies below added up."""
    heads = reduce(DataFrame.unionAll, [h for h, _ in rounds])
    ended = reduce(DataFrame.unionAll, [e for _, e in rounds]).join(ends, "rep").drop("rep")
    chain = written(_below(_chain(heads, turns)), "trie-chains")
    # leaves and saved tokens of every container's head, and the saved tokens of every burst run itself
    containers = placed.groupBy("m", "d").agg(F.first("path").alias("path"))
    tops = nodes.selectExpr("conv_id AS m", "depth AS d", "n_leaves AS leaves", "saved_tokens AS saved")
    totals = containers.join(tops, ["m", "d"]).select("path", "leaves", "saved")
    runs = chain.groupBy("m", "d").agg(F.first("path").alias("path"), F.sum("own").alias("saved"))
    totals = totals.unionAll(runs.selectExpr("path", "CAST(0 AS BIGINT) AS leaves", "saved"))
    under = (
        totals.selectExpr("leaves", "saved", "explode(path) AS h", "element_at(path, -1) AS up")
        .groupBy("h.m", "h.d").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.expr("count_if(h = up) AS children"))
    )
    return chain.join(under, ["m", "d"]).join(ended, ["m", "d"], "left").selectExpr(
        "m AS conv_id", "pos + 1 AS depth", "CASE WHEN pos + 1 = d THEN pm ELSE m END AS parent_conv_id", "n AS n_convs",
        "IF(pos + 1 < b, CAST(1 AS BIGINT), children) AS n_children", "leaves AS n_leaves", "CAST(below + saved AS BIGINT) AS saved_tokens",
        f"CASE WHEN pos + 1 = b THEN coalesce(ends, '{EMPTY}') ELSE '{EMPTY}' END AS ends_sha256",
    )


def conversation_trie(conversations: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The trie of all conversations, rebuilt with the heads of their blocks (``rebuilt``)."""
    turns, convs = turn_rows(conversations)
    return burst_trie(rebuilt(turns, convs), capacity)
