"""N-gram Jaccard self-join by grouped prefixes.

A document's set holds its distinct 4-word shingles (ASCII letters lower-cased,
words ``[^\\x20\\x09-\\x0D]+``; with fewer words the whole sequence is the one
shingle; without words the set is empty and joins nothing). Two documents link
when ``100 * |A & B| >= percent * |A | B|``.

1. One pass finds shingles that are frequent within some run of text. They come last in
   the global order (frequency class, hash); any fixed order gives the same
   result, this one keeps common passages out of the prefixes.
2. One pass computes every set, its prefix (enough first shingles that linked
   sets must share one), a parity bitmap and a set key, written once.
3. Equal sets collapse into a class, classes with the same prefix and size into
   a group; only one prefix per group is joined.
4. First round: groups next to each other in a shingle's size-ordered list,
   groups with the best connected group of a shingle, and members with their
   group's leader are verified and linked. This only settles easy links cheaply.
5. Second round: every pair of groups that shares a prefix shingle within
   the size and position bounds and isn't already inside one component is expanded
   to members of different components and verified. No candidate is capped.

Sets are compared by 64-bit hashes of their shingles. ``doc_id`` may be null or
repeated; rows are told apart by a hash of (doc_id, text), so equal rows share a
result. Null texts count as empty. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daybook.llm.common import LOWER, blocks, components, flat, mix, release, word_hashes, word_spans, written

#: At most so many frequent shingles are put last; only the order depends on it.
FREQUENT = 100_000
#: A shingle that so many documents hold, among every RUN shingles that a task reads, is a frequent one.
IN_RUN, RUN = 3, 6_000_000

_ROWS = T.StructType([
    T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("gk", T.LongType()),
    T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType()),
])


def shingles(raw: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of a block and its row (not yet distinct)."""
    starts, ends, first = word_spans(raw, off)
    words = word_hashes(LOWER[raw], starts, ends)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    h = np.zeros(len(words), np.uint64)
    for k in range(width):  # words behind the end of a row or block count as 0
        part = np.zeros(len(words), np.uint64)
        part[: len(words) - k] = words[k:]
        if k:
            part[: len(words) - k][row[k:] != row[: len(words) - k]] = 0
        h += mix(part + np.uint64(k))
    place = np.arange(len(words)) - first[:-1][row]
    keep = place <= np.maximum(count[row] - width, 0)
    return mix(h)[keep], row[keep]


def distinct(h: np.ndarray, row: np.ndarray, order: np.ndarray | None = None):
    """Distinct (row, hash), sorted by row, order class and hash."""
    by = np.lexsort((h, row) if order is None else (h, order, row))
    h, row = h[by], row[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def _frequent(width: int):
    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        h = np.sort(np.concatenate(parts))
        edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        count = np.diff(np.r_[edge, len(h)])
        often = count >= IN_RUN
        return pa.record_batch([pa.array(h[edge[often]].astype(np.int64)), pa.array(count[often])], ["h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in blocks(batches):
            parts.append(distinct(*shingles(*flat(batch.column("text")), width))[0])
            size += len(parts[-1])
            if size >= RUN:
                yield counted(parts)
                parts, size = [], 0
        if parts:
            yield counted(parts)

    return run


def _sets(width: int, percent: int, last: np.ndarray, rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            raw, off = flat(batch.column("text"))
            h, row = shingles(raw, off, width)
            order = np.zeros(len(h), np.int32)
            if len(last):
                at = np.minimum(np.searchsorted(last, h), len(last) - 1)
                order = np.where(last[at] == h, rank[at], 0)
            h, row = distinct(h, row, order)
            rows = batch.num_rows
            n = np.bincount(row, minlength=rows)
            first = np.r_[0, np.cumsum(n)]
            # |A & B| >= percent/100 * |A|, so linked sets share one of the first n - need + 1
            length = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
            place = np.arange(len(h)) - first[:-1][row]
            head = place < length[row]
            prefix = h[head].astype(np.int64)
            k1, k2, gk = (np.zeros(rows, np.uint64) for _ in range(3))
            np.add.at(k1, row, h)
            np.add.at(k2, row, mix(h ^ np.uint64(0x5BD1E995)))
            np.add.at(gk, row[head], mix(h[head] + np.uint64(7)))
            gk = mix(gk ^ mix(n.astype(np.uint64)))
            # parity bitmap of at least as many bits as the set has members
            width_bits = 1 << np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64)
            at = np.r_[0, np.cumsum(width_bits)]
            bits = (np.bincount(at[:-1][row] + (h >> np.uint64(8)).astype(np.int64) % width_bits[row], minlength=at[-1]) & 1).astype(np.uint8)
            packed = np.packbits(bits)
            ends = np.r_[0, np.cumsum(length)].astype(np.int32)
            yield pa.record_batch([
                batch.column("uid"), batch.column("doc_id"), pa.array(n),
                pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(gk.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(prefix)),
                pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((at // 8).astype(np.int32)), pa.py_buffer(packed)]),
            ], [f.name for f in _ROWS])

    return run


def _near(percent: int):
    """Keeps the pairs whose parity bitmaps don't prove them too different."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            most = (na + nb) * (100 - percent) // (100 + percent)  # largest symmetric difference of a link
            for k, (a, b) in enumerate(zip(batch.column("bits_a"), batch.column("bits_b"), strict=True)):
                x, y = np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)
                if len(x) < len(y):
                    x, y = y, x
                if len(x) > len(y):  # bits were taken modulo a power of two, so halves fold onto each other
                    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
                keep[k] = int(np.bitwise_count(x ^ y).sum()) <= most[k]
            yield pa.record_batch([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], ["a", "b"])

    return run


def _verify(width: int, percent: int):
    """Keeps the pairs of texts whose sets meet the threshold, with the exact sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(blocks(batches, "ta"), "tb"):
            ha, ra = distinct(*shingles(*flat(batch.column("ta")), width))
            hb, rb = distinct(*shingles(*flat(batch.column("tb")), width))
            h, row = np.concatenate([ha, hb]), np.concatenate([ra, rb])
            by = np.lexsort((h, row))
            h, row = h[by], row[by]
            both = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
            common = np.bincount(row[1:][both], minlength=batch.num_rows)
            union = np.bincount(row, minlength=batch.num_rows) - common
            keep = pa.array((100 * common >= percent * union) & (union > 0))
            yield pa.record_batch([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return run


def jaccard_links(docs: DataFrame, width: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(rows, links): one row per document and enough verified links to connect what is linked.

    rows: uid, doc_id, n (set size), rep (uid that stands for its class of equal
    sets, null for an empty set). links: a, b, pairs of rep. Every pair of
    different sets that meets the threshold is joined by a path of links.
    """
    docs = docs.select(F.xxhash64("doc_id", "text").alias("uid"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    often = (
        docs.select("text").mapInArrow(_frequent(width), "h long, n long")
        .groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    )
    last, rank = often["h"].to_numpy().view(np.uint64), np.argsort(np.argsort(often["n"].to_numpy(), kind="stable"))
    by = np.argsort(last)
    sets = written(docs.mapInArrow(_sets(width, percent, last[by], rank[by].astype(np.int32) + 1), _ROWS), "sets")

    classes = written(sets.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("uid").alias("rep"), F.first("gk").alias("gk")), "classes")
    leaders = sets.where("n > 0").groupBy("gk").agg(F.min(F.struct("uid", "n", "prefix")).alias("s"))
    by_size = Window.partitionBy("t").orderBy("n", "g")
    tokens = (
        leaders.select(F.col("s.uid").alias("g"), F.col("s.n").alias("n"), F.posexplode("s.prefix").alias("i", "t"))
        .withColumns({
            "g0": F.lag("g").over(by_size), "n0": F.lag("n").over(by_size), "i0": F.lag("i").over(by_size),
            "g1": F.lead("g").over(by_size),
        })
        .where("g0 is not null or g1 is not null").drop("g1")
    )
    tokens = written(tokens, "shared")  # only shingles that two groups share

    def placed(n0, i0, n1, i1):
        # for sets of these sizes a link needs an overlap of percent / (100 + percent) of both together, so that
        # the prefixes that leave one less must share a shingle: this one has to lie within both
        return f"{100 + percent} * least({n0} - {i0}, {n1} - {i1}) >= {percent} * ({n0} + {n1})"

    bits = sets.select("uid", "n", "bits")
    texts = docs.select("uid", "text").where("text is not null")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        pairs = written(pairs, name)  # the plans so far end here, and what they hold on the driver goes
        release(docs.sparkSession)
        one = bits.select(F.col("uid").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a")).dropDuplicates(["a"])
        two = bits.select(F.col("uid").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b")).dropDuplicates(["b"])
        near = written(pairs.join(one, "a").join(two, "b").mapInArrow(_near(percent), "a long, b long"), name)
        if near.isEmpty():
            return near
        t = texts.dropDuplicates(["uid"])
        both = near.join(t.select(F.col("uid").alias("a"), F.col("text").alias("ta")), "a")
        both = both.join(t.select(F.col("uid").alias("b"), F.col("text").alias("tb")), "b")
        return written(both.mapInArrow(_verify(width, percent), "a long, b long"), name)

    # first round: for each group the two neighbours, and the two hubs, that share most prefix shingles.
    # A shingle's hub is the group in its list that shares most with all others, such as the
    # original of many near copies.
    members_of = tokens.groupBy("t").agg(F.count("*").alias("m"))
    fame = tokens.join(members_of, "t").groupBy("g").agg(F.sum("m").alias("fame"))
    hubs = tokens.join(fame, "g").groupBy("t").agg(F.max(F.struct("fame", "g", "n", "i")).alias("hub"))
    to_hub = tokens.join(hubs, "t").where("g <> hub.g").select(
        F.col("hub.g").alias("a"), F.col("hub.n").alias("n0"), F.col("hub.i").alias("i0"),
        F.col("g").alias("b"), "n", "i", F.lit(1).alias("kind"),
    )
    near = tokens.where("g0 is not null").select(F.col("g0").alias("a"), "n0", "i0", F.col("g").alias("b"), "n", "i", F.lit(0).alias("kind"))
    best = Window.partitionBy("b", "kind").orderBy(F.desc("shared"), "a")
    neighbours = (
        near.unionAll(to_hub).where(f"100 * least(n0, n) >= {percent} * greatest(n0, n)").where(placed("n0", "i0", "n", "i"))
        .groupBy("a", "b", "kind").agg(F.count("*").alias("shared"))
        .withColumn("r", F.row_number().over(best)).where("r <= 2").select("a", "b").distinct()
    )
    group = classes.groupBy("gk").agg(F.min("rep").alias("g"))
    members = classes.join(group, "gk").select("rep", "g", "n")
    first = linked(neighbours.unionAll(members.where("rep <> g").select(F.col("g").alias("a"), F.col("rep").alias("b"))), "links1")

    # second round: whatever may still connect two components
    comp = components(first)
    members = written(
        members.join(comp.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .select("rep", "g", F.coalesce("root", "rep").alias("root")), "members",
    )
    spread = members.groupBy("g").agg(F.min("root").alias("c0"), F.max("root").alias("c1"))
    open_tokens = tokens.select("t", "i", "g", "n").join(spread, "g")
    mixed = open_tokens.groupBy("t").agg(F.min("c0").alias("x"), F.max("c1").alias("y")).where("x <> y").select("t")
    open_tokens = written(open_tokens.join(mixed, "t"), "open")
    x, y = open_tokens.alias("x"), open_tokens.alias("y")
    groups = (
        x.join(y, F.expr(
            "x.t = y.t and (x.n < y.n or x.n = y.n and x.g < y.g)"
            f" and 100 * x.n >= {percent} * y.n"
            + " and " + placed("x.n", "x.i", "y.n", "y.i")
            + " and not (x.c0 = x.c1 and y.c0 = y.c1 and x.c0 = y.c0)"
        )).select(F.col("x.g").alias("gx"), F.col("y.g").alias("gy")).distinct()
    )
    groups = groups.unionAll(spread.where("c0 <> c1").select(F.col("g").alias("gx"), F.col("g").alias("gy")))
    mx = members.select(F.col("g").alias("gx"), F.col("rep").alias("a"), F.col("root").alias("ca"))
    my = members.select(F.col("g").alias("gy"), F.col("rep").alias("b"), F.col("root").alias("cb"))
    rest = groups.join(mx, "gx").join(my, "gy").where("ca <> cb and (gx <> gy or a < b)").select("a", "b")
    second = linked(rest, "links2")

    rows = sets.join(classes.select("k1", "k2", "n", "rep"), ["k1", "k2", "n"], "left").select("uid", "doc_id", "n", "rep")
    return rows, first.unionAll(second)


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id that links reach, its own included.

    A document with an empty set keeps its own id. A null id is passed over in
    the minimum; a component of null ids only has a null component_id.
    """
    rows, links = jaccard_links(docs, width, percent)
    comp = components(links)
    rows = rows.join(comp.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "doc_id", "n", F.coalesce("root", "rep").alias("c")
    )
    rows = written(rows, "labelled")
    least = rows.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """The documents, with all their columns, without those that links connect to one with a smaller id.

    A null id counts as the largest; equal ids go by the hash of (doc_id, text).
    Of rows that are equal in both, one stays. Documents with an empty set stay.
    """
    rows, links = jaccard_links(docs, width, percent)
    comp = components(links)
    rows = rows.where("rep is not null").join(comp.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "uid", F.coalesce("root", "rep").alias("c"), F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid").alias("by")
    )
    # rows that aren't the first of their component; there are no more than copies
    first = rows.groupBy("c").agg(F.min("by").alias("keep"))
    gone = rows.join(first, "c").where("uid <> keep.uid").select(F.col("uid").alias("gone_uid")).distinct()
    uid = F.xxhash64("doc_id", "text")
    names = docs.columns
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), uid.alias("uid"), (F.length("text") > 0).alias("some"))
    kept = kept.join(gone, F.expr("uid = gone_uid"), "left_anti")
    # equal rows share their uid: one of them stays, unless the set is empty
    again = rows.groupBy("uid").agg(F.count("*").alias("n")).where("n > 1").select(F.col("uid").alias("many_uid"))
    nth = Window.partitionBy("uid").orderBy(F.lit(0))
    many = kept.join(again, F.expr("uid = many_uid"), "left_semi").withColumn("nth", F.row_number().over(nth)).where("nth = 1")
    return kept.join(again, F.expr("uid = many_uid"), "left_anti").select("row.*").unionAll(many.select("row.*"))
