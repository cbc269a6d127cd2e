"""Document fingerprints by winnowing.

Hashes of every run of ``k`` code points are reduced to the least of every
``window`` consecutive ones, the rightmost among equals. Any two texts that
share a run of ``window + k - 1`` code points share a fingerprint, and the
positions tell where. A text shorter than ``k`` has one fingerprint, its whole;
an empty or null text has none. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Rolling, blocks, window_minima

K, WINDOW = 16, 64


def winnow(texts: list[str], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(32-bit hashes, positions, row offsets) of the fingerprints of ``texts``, in text order."""
    size = np.array([len(t) for t in texts], np.int64)
    off = np.r_[0, np.cumsum(size)]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    roll = Rolling(codes)
    grams = roll.grams(k)
    count = np.maximum(size - k + 1, 0)
    first = np.r_[0, np.cumsum(count)]
    at = np.arange(first[-1]) + np.repeat(off[:-1] - first[:-1], count)  # place of each gram that stays in its row
    chosen = at[window_minima(grams[at], first, window)]
    hashes = (grams[chosen] >> np.uint64(32)).astype(np.uint32)
    short = np.flatnonzero((size > 0) & (size < k))
    if len(short):
        chosen = np.concatenate([chosen, off[short]])
        hashes = np.concatenate([hashes, (roll.of(off[short], off[short + 1]) >> np.uint64(32)).astype(np.uint32)])
        by = np.argsort(chosen, kind="stable")
        chosen, hashes = chosen[by], hashes[by]
    rows = np.searchsorted(chosen, off)
    return hashes, chosen - np.repeat(off[:-1], np.diff(rows)), rows


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc_id, hashes array<long>, positions array<int>) of every text; null ids are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            h, p, rows = winnow([t or "" for t in batch.column("text").to_pylist()], k, window)
            ends = pa.array(rows.astype(np.int32))
            yield pa.record_batch([
                batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(h.astype(np.int64))),
                pa.ListArray.from_arrays(ends, pa.array(p.astype(np.int32))),
            ], ["doc_id", "hashes", "positions"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, hashes array<long>, positions array<int>"
    )


def _sets(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sorted distinct (row, hash) keys."""
    row = np.repeat(np.arange(len(rows) - 1, dtype=np.uint64), np.diff(rows))
    return np.unique(row << np.uint64(32) | hashes)


def _likeness(a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """Jaccard likeness of the hash sets with equal row numbers; 1 where both are empty."""
    size = lambda x: np.bincount((x >> np.uint64(32)).astype(np.int64), minlength=rows)[:rows]
    common = size(np.intersect1d(a, b, assume_unique=True))
    union = size(a) + size(b) - common
    return np.where(union > 0, common / np.maximum(union, 1), 1.0)


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(k: int, window: int):
    def digest(hashes: np.ndarray, rows: np.ndarray) -> list[str]:
        text = hashes.astype(">u4").tobytes().hex()
        return [text[8 * a : 8 * b] for a, b in zip(rows[:-1], rows[1:], strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row whose follower is in the next block
        for batch in blocks(batches):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")), strict=True))
            rows = [last, *rows] if last else rows
            last = rows[-1]
            here = [k for k in range(len(rows) - 1) if not rows[k][1]]
            if not here:
                continue
            texts = [t for *_, t in rows]
            edited = []
            for i in here:
                t, m = texts[i], len(texts[i]) // 2
                edited.append(t[: len(t) - m] + texts[i + 1][:m])
            h, _, r = winnow(texts, k, window)
            he, _, re_ = winnow(edited, k, window)
            own = _sets(h, r)
            # row numbers: each text under its own place, the follower's set moved one place back
            after = own[own >> np.uint64(32) > 0] - np.uint64(1 << 32)
            place = np.array(here, np.uint64)
            changed = np.unique(place[np.repeat(np.arange(len(here)), np.diff(re_))] << np.uint64(32) | he)
            prints = digest(h, r)
            yield pa.record_batch([
                pa.array([rows[i][2] for i in here], pa.int64()), pa.array([len(texts[i]) for i in here], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
                pa.array([prints[i] for i in here]), pa.array(digest(he, re_)),
                pa.array(_likeness(own, changed, len(rows))[here]), pa.array(_likeness(own, after, len(rows))[here]),
            ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return run


def edited_fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Every text's fingerprint beside that of its edited text, and how alike they are.

    The edited text has its last ``floor(n / 2)`` code points replaced by the
    first as many of the next document in descending doc_id (nulls last, equal
    ids by a hash of the text); after the last comes the first. Documents are
    dealt to ranges of doc_id with one shuffle of the texts; the first document
    of each range also visits the range before it, so that each has its
    follower beside it. Ranges come from quantiles over all ids, and their
    number follows the session's shuffle partitions; an id that fills several
    ranges, and the rows without id, are cut into ranges of the text's hash.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 2 * parts
    quantiles = F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10000, 20 * n))
    rows, known, found = docs.select(F.count("*"), F.count("doc_id"), quantiles).first()
    if not rows:
        return spark.createDataFrame([], _EDITED)
    ids, times = np.unique(np.array(found or [], np.int64), return_counts=True)
    often = times > 1
    cuts = np.union1d(ids, ids[often] - 1)  # range 1 holds the ids up to the first cut, range 0 the rows without id
    split = np.ones(len(cuts) + 2, np.int64)
    split[np.searchsorted(cuts, ids[often]) + 1] = times[often] + 1
    split[0] = max(1, -(-n * (rows - known) // rows))
    base = np.cumsum(split) - split
    digest = F.xxhash64("text") if (split > 1).any() else F.lit(0).cast("long")
    key = [F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), digest]

    def ranges(id_: pd.Series, null: pd.Series, h: pd.Series) -> np.ndarray:
        at = np.where(null.to_numpy(bool), 0, np.searchsorted(cuts, id_.to_numpy(np.int64), "left") + 1)
        share = (h.to_numpy(np.float64) + 2.0**63) / 2.0**64  # smaller hashes come first, so in the higher range
        return base[at] + split[at] - 1 - np.minimum((share * split[at]).astype(np.int64), split[at] - 1)

    @F.pandas_udf("int")
    def range_of(id_: pd.Series, null: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(ranges(id_, null, h).astype(np.int32))

    first = (
        docs.select(range_of(*key).alias("bucket"), key[0].alias("id"), digest.alias("h"))
        .groupBy("bucket").agg(F.max(F.struct("id", F.bitwise_not("h").alias("h"))).alias("top")).orderBy("bucket").collect()
    )  # a row for each range
    tops, hashes, hosts = (np.zeros(split.sum(), np.int64) for _ in range(3))
    for i, r in enumerate(first):
        # the follower of a range's last document is the first of the range below; below the lowest is the highest
        tops[r.bucket], hashes[r.bucket], hosts[r.bucket] = r.top.id, ~r.top.h, first[(i + 1) % len(first)].bucket

    @F.pandas_udf("bucket int, host int")
    def place_of(id_: pd.Series, null: pd.Series, h: pd.Series) -> pd.DataFrame:
        bucket = ranges(id_, null, h)
        top = (id_.to_numpy(np.int64) == tops[bucket]) & (h.to_numpy(np.int64) == hashes[bucket])
        return pd.DataFrame({"bucket": bucket.astype(np.int32), "host": np.where(top, hosts[bucket], -1).astype(np.int32)})

    own = F.struct(F.col("at.bucket").alias("bucket"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("at.host").alias("bucket"), F.lit(True).alias("guest"))
    placed = docs.withColumn("at", place_of(*key)).withColumn(
        "places", F.when(F.col("at.host") >= 0, F.array(own, visit)).otherwise(F.array(own))
    )
    return (
        placed.select("doc_id", "text", F.explode("places").alias("p")).select("p.bucket", "p.guest", "doc_id", "text")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
        .mapInArrow(_compare(k, window), _EDITED)
    )
