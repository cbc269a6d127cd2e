"""Removal of repeated byte strings by suffix sorting.

Every byte goes that is covered by a string of ``length`` bytes that also starts
anywhere else, in the same document or another; overlaps count and strings are
judged on the input. Matches never cross documents. Null texts are empty.

A suffix array over all bytes would sort and ship every byte's suffix many times,
though most start no repeated string. So the sort is dealt to buckets, without
losing a match:

1. Every window of ``length`` bytes has an anchor, the least hash of its
   ``GRAM``-byte runs, the rightmost among equals. Equal windows have equal
   anchors at the same place. The windows of one anchor are neighbours; the
   bytes that they cover are its context.
2. Anchors whose hash is unique start no repeated window. Contexts that are
   equal as a whole repeat as a whole and are counted, not compared: copies
   of documents and of long passages end here, one row each.
3. What is left, the different contexts of one anchor hash, forms a bucket.
   A bucket's contexts are sorted by the difference-cover algorithm: the triples
   at two of three places are sorted and named, their order found by recursion on
   the names, the remaining suffixes sorted by their first letter and the next
   one's rank, and both merged. Of the windows in that order, neighbours are
   compared over ``length`` bytes. Recursion ends where names cover ``length``.
4. Buckets with more than ``CONTEXTS`` contexts are not sorted in one task:
   their windows are counted by hash, which spreads over all tasks.

Rows are told apart by a hash of (doc_id, text); rows equal in both are two
documents that repeat each other. Null and repeated ids are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Rolling, blocks, flat, window_minima, written

LENGTH, GRAM = 400, 32
#: Contexts of one anchor hash that one task sorts.
CONTEXTS = 2000
#: Bytes of whole buckets that are sorted together.
BUCKET_BYTES = 1 << 20


def anchors(raw: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Anchors of a block: (row, place, first window, last window, hash, hash of the context); places are by row."""
    window = length - gram + 1
    roll = Rolling(raw)
    hashes = roll.grams(gram)
    size = np.diff(off)
    count = np.where(size >= length, size - gram + 1, 0)
    first = np.r_[0, np.cumsum(count)]
    at = np.arange(first[-1]) + np.repeat(off[:-1] - first[:-1], count)
    keys = hashes[at]
    place = window_minima(keys, first, window)
    row = np.searchsorted(first, place, "right") - 1
    key = keys[place]
    rank = key >> np.uint64(32)  # what decided
    lo, hi = np.maximum(first[row], place - window + 1), np.minimum(place, first[row + 1] - window)
    same = row[1:] == row[:-1]
    # a smaller neighbour takes the windows that hold both; of equals the later one does
    before = np.flatnonzero(same & (rank[:-1] < rank[1:])) + 1
    lo[before] = np.maximum(lo[before], place[before - 1] + 1)
    after = np.flatnonzero(same & (rank[1:] <= rank[:-1]))
    hi[after] = np.minimum(hi[after], place[after + 1] - window)
    shift = off[:-1][row] - first[:-1][row]
    context = roll.of(lo + shift, hi + shift + length)
    start = first[:-1][row]
    return row, place - start, lo - start, hi - start, key, context


_ANCHOR = "uid long, lo int, hi int, h long, c long"


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            row, _, lo, hi, h, c = anchors(*flat(batch.column("text")), length, gram)
            yield pa.record_batch([
                pa.array(batch.column("uid").to_numpy()[row]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                pa.array(h.view(np.int64)), pa.array(c.view(np.int64)),
            ], ["uid", "lo", "hi", "h", "c"])

    return run


def suffix_order(s: np.ndarray, reach: int, covered: int = 1) -> np.ndarray:
    """Starts of the suffixes of ``s`` (letters from 1 to below 2**20) in the order of their first ``reach`` letters.

    Difference cover modulo 3. Each letter stands for ``covered`` letters of the
    text; suffixes that are equal over ``reach`` of these may come in any order.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    padded = np.concatenate([s, np.zeros(3, np.int64)]).astype(np.uint64)
    b = np.uint64(21)
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # a dummy suffix at n, if need be
    sample = np.concatenate([ones, twos])
    triple = (padded[sample] << b | padded[sample + 1]) << b | padded[sample + 2]
    by = np.argsort(triple)
    new = np.r_[True, triple[by][1:] != triple[by][:-1]]
    name = np.empty(len(sample), np.int64)
    name[by] = np.cumsum(new)
    if not new.all() and covered * 3 < reach:
        by = suffix_order(name, reach, covered * 3)
        name[by] = np.arange(1, len(by) + 1)
    rank = np.zeros(n + 3, np.uint64)
    rank[sample] = name
    order = sample[by]
    order = order[order < n]
    zeros = np.arange(0, n, 3)
    key = padded[zeros] << b | rank[zeros + 1]
    zeros = zeros[np.argsort(key)]
    # merge: a suffix at 0 modulo 3 against those at 1 by one letter and rank, against those at 2 by two letters and rank
    one, two = order[order % 3 == 1], order[order % 3 == 2]
    smaller = np.searchsorted(np.sort(padded[one] << b | rank[one + 1]), padded[zeros] << b | rank[zeros + 1])
    smaller += np.searchsorted(
        np.sort((padded[two] << b | padded[two + 1]) << b | rank[two + 2]), (padded[zeros] << b | padded[zeros + 1]) << b | rank[zeros + 2]
    )
    # equal names leave suffixes that agree over the reach in any order; the places must rise all the same
    smaller = np.maximum.accumulate(smaller)
    out = np.empty(n, np.int64)
    place = np.arange(len(zeros)) + smaller
    out[place] = zeros
    rest = np.ones(n, bool)
    rest[place] = False
    out[rest] = order
    return out


def repeated_windows(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, which of its windows of ``length`` bytes also start elsewhere in the contexts."""
    size = np.array([len(c) for c in contexts], np.int64)
    raw = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    start = np.cumsum(size + 1) - size - 1
    letters = raw.astype(np.int64) + 2
    letters[start + size] = 1  # ends of contexts
    valid = np.zeros(len(raw), bool)
    for a, n in zip(start.tolist(), size.tolist(), strict=True):
        valid[a : a + n - length + 1] = True
    order = suffix_order(letters, length)
    order = order[valid[order]]
    # eight bytes at a time, over the neighbours that have agreed so far
    wide = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.zeros(len(raw), np.uint64)
    for k in range(8):
        words |= wide[k : k + len(raw)].astype(np.uint64) << np.uint64(8 * k)
    a, b, left = order[:-1], order[1:], np.arange(max(len(order) - 1, 0))
    for k in [*range(0, length - 7, 8), length - 8]:
        same = words[a[left] + k] == words[b[left] + k]
        left = left[same]
    again = np.zeros(len(raw), bool)
    again[a[left]] = again[b[left]] = True
    return [again[s : s + n - length + 1] for s, n in zip(start.tolist(), size.tolist(), strict=True)]


_SPANS = "h long, c long, spans array<struct<first: int, last: int>>"


def _span_batch(rows: list) -> pa.RecordBatch:
    h, c, spans = zip(*rows, strict=True) if rows else ((), (), ())
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    return pa.record_batch([pa.array(h, pa.int64()), pa.array(c, pa.int64()), pa.array(spans, kind)], ["h", "c", "spans"])


def _sorted_buckets(length: int):
    """Repeated windows of the contexts that occur once; a bucket's rows come one after another."""

    def solve(rows: list) -> pa.RecordBatch:
        out = []
        for (h, c, n, _), again in zip(rows, repeated_windows([r[3] for r in rows], length), strict=True):
            if n == 1 and again.any():
                edge = np.flatnonzero(np.diff(np.r_[False, again, False])).reshape(-1, 2)
                out.append((h, c, [{"first": int(a), "last": int(b) - 1} for a, b in edge]))
        return _span_batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        size = 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("h", "c", "n", "context")), strict=True):
                if size > BUCKET_BYTES and r[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[3])
        if rows:
            yield solve(rows)

    return run


def _window_hashes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "context", 1 << 18):
            raw, off = flat(batch.column("context"))
            count = np.diff(off) - length + 1
            row = np.repeat(np.arange(len(count)), count)
            j = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = off[:-1][row] + j
            w = Rolling(raw, 0xC2B2AE3D27D4EB4F).of(at, at + length)
            yield pa.record_batch(
                [batch.column("h").take(pa.array(row)), batch.column("c").take(pa.array(row)), batch.column("n").take(pa.array(row)), pa.array(j.astype(np.int32)), pa.array(w.view(np.int64))],
                ["h", "c", "n", "j", "w"],
            )

    return run


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                kept, gone, runs, at = [], 0, 0, -1
                for s in sorted((s["first"], s["end"]) for s in spans or ()):
                    if s[0] > at:
                        kept.append(raw[max(at, 0) : s[0]])
                        runs, gone, at = runs + 1, gone + s[1] - s[0], s[1]
                    elif s[1] > at:
                        gone, at = gone + s[1] - at, s[1]
                kept.append(raw[max(at, 0) :])
                out.append((len(raw), gone, runs, b"".join(kept)))
            n, gone, runs, kept = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.record_batch([
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary()),
            ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(uid, spans array<struct<first, end>>): covered bytes of each text that has some, spans may touch or overlap.

    ``docs`` holds (uid, text). ``gram`` is at least 8 less than ``length``.
    """
    places = written(docs.mapInArrow(_anchors(length, gram), _ANCHOR), "anchors")
    contexts = written(places.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("uid", "lo", "hi")).alias("at")), "contexts")
    buckets = (
        contexts.groupBy("h").agg(F.count("*").alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1").select("h", "m")
    )
    open_contexts = contexts.join(buckets, "h").select("h", "c", "n", "m", "at.*")
    cut = (
        open_contexts.join(docs.select("uid", F.col("text").cast("binary").alias("t")).withColumnRenamed("uid", "u"), F.expr("uid = u"))
        .select("h", "c", "n", "m", F.expr(f"substring(t, lo + 1, hi - lo + {length})").alias("context"))
    )
    cut = written(cut.dropDuplicates(["h", "c"]), "open")  # equal rows share a uid and bring a context twice
    small = cut.where(F.col("m") <= CONTEXTS).select("h", "c", "n", "context").repartition("h").sortWithinPartitions("h", "c")
    found = small.mapInArrow(_sorted_buckets(length), _SPANS)
    windows = cut.where(F.col("m") > CONTEXTS).select("h", "c", "n", "context").mapInArrow(_window_hashes(length), "h long, c long, n long, j int, w long")
    often = windows.groupBy("h", "w").agg(F.sum("n").alias("t")).where("t > 1").select("h", "w")
    big = windows.where("n = 1").join(often, ["h", "w"], "left_semi").groupBy("h", "c").agg(
        F.collect_list(F.struct(F.col("j").alias("first"), F.col("j").alias("last"))).alias("spans")  # one for each window of a context at most
    )
    partial = found.unionAll(big)
    hits = places.join(partial, ["h", "c"]).select("uid", "lo", F.explode("spans").alias("s")).select(
        "uid", (F.col("lo") + F.col("s.first")).alias("first"), (F.col("lo") + F.col("s.last") + length).alias("end")
    )
    whole = places.join(contexts.where("n > 1").select("h", "c"), ["h", "c"], "left_semi").select(
        "uid", F.col("lo").alias("first"), (F.col("hi") + length).alias("end")
    )
    # a set, for equal rows share a uid and bring each span again
    return hits.unionAll(whole).groupBy("uid").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


def without_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept binary) of every document."""
    docs = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("uid", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(docs.select("uid", "text"), length, gram)
    return docs.join(spans, "uid", "left").select("doc_id", "text", "spans").mapInArrow(
        _removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
