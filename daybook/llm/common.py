"""Shared pieces of the text operators: table access, scratch tables, connected
components, and numpy helpers over the UTF-8 bytes of an Arrow column.

Every numpy helper works on a *block*: consecutive rows whose texts hold about
``BLOCK_BYTES`` together. A text is never cut; one longer than a block is a
block of its own, so task memory is bounded by the longest text.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.catalog import delete_path
from daybook.session import shared_dir

BLOCK_BYTES = 1 << 21
# The white space of the word pattern [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
LOWER = np.arange(256, dtype=np.uint8)  # ASCII letters in lower case
LOWER[65:91] += 32


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, name: str, codec: str | None = None) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and the folder, for ``discard``.

    ``codec`` is for tables that take much room; the session's own otherwise."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    release_if_grown(spark)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    return scratch(df, name, codec)[0]


def discard(spark: SparkSession, *folders: str) -> None:
    """Deletes folders of ``scratch`` that no frame is read from any more: all that came of them is written itself,
    so that a lost executor's work starts from there. A Connect session leaves them."""
    if getattr(spark, "_jvm", None) is not None:
        for folder in folders:
            delete_path(spark, folder)


def release(spark: SparkSession) -> None:
    """Let the driver drop the plans, broadcasts and shuffle files of finished work now.

    They go when their last reference is collected, in Python and then in the JVM; a
    driver with room left collects late, and holds them through many stages."""
    gc.collect()
    jvm = getattr(spark, "_jvm", None)  # a Connect session has none
    if jvm is not None:
        jvm.java.lang.System.gc()


def release_if_grown(spark: SparkSession) -> None:
    """``release`` once the driver's heap takes half of what it may: it gives back what it doesn't need then.

    Left alone, a heap grows to its limit over many small jobs, however little of it is in use."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        heap = jvm.java.lang.Runtime.getRuntime()
        if 2 * heap.totalMemory() > heap.maxMemory():
            release(spark)


def id_remainder(mod: int):
    """crc32 of the id's text modulo ``mod``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges`` by alternating large-star and small-star.

    Returns (node, root) for every node on an edge; root is the component's
    smallest node. Each round is written to the shared folder; the number of
    rounds grows with the logarithm of the longest path.
    """
    def stars(links):
        e = written(links.where("u <> v").distinct(), "cc")
        return e, e.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e, was = stars(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        # large star: larger neighbours move to the smallest of u's neighbourhood
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours, and u itself, move to u's smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("m", F.explode(F.array("u", "v")).alias("u")).select("u", F.col("m").alias("v"))
        e, now = stars(small)
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


# -- blocks of an Arrow column ---------------------------------------------------


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``size`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values one after another, and the offsets (rows + 1); null is empty."""
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word (rows + 1)."""
    inside = ~SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True  # words never run over a row's edge
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[:1] = False
    before &= ~edge[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1:] = False
    after &= ~edge[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


# -- hashes ------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(n: int, base: int) -> np.ndarray:
    up = np.full(n, base, np.uint64)
    up[0] = 1
    return np.multiply.accumulate(up)


class Rolling:
    """Polynomial hashes modulo 2**64 of any substring of a sequence of letters."""

    def __init__(self, letters: np.ndarray, base: int = _BASE):
        if letters.dtype == np.uint8:
            values = _LETTER[letters]
        else:
            values = mix((letters.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))
        up = _powers(len(letters) + 1, base)
        self.down = _powers(len(letters) + 1, pow(base, -1, 1 << 64))
        self.sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(values * up[: len(letters)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hash of every run of ``k`` letters."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n] + np.uint64(k))


#: Letters from which on a word's hash is a digest.
LONG_WORD = 256


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of words. Polynomials modulo 2**64 are equal for some different words, such as those of two
    letters in turns of 1, 2, 4, ... up to 1,024 letters and more, whatever the base; so long words get a
    cryptographic digest."""
    out = Rolling(raw).of(start, end)
    for i in np.flatnonzero(end - start >= LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def window_minima(keys: np.ndarray, off: np.ndarray, window: int) -> np.ndarray:
    """Winnowing: positions of the least key of every ``window`` consecutive keys of a row,
    the rightmost among equals. ``off`` are the rows' offsets in ``keys``. A row with
    fewer keys than a window, but at least one, has one window."""
    n = len(keys)
    if not n:
        return np.zeros(0, np.int64)
    # key and reversed position in one integer, so that one minimum decides both
    low = (keys & ~np.uint64(0xFFFFFFFF)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    best, have = low, 1
    while have < window and have < n:
        step = min(have, window - have)
        nxt = best.copy()
        np.minimum(best[: n - step], best[step:], out=nxt[: n - step])
        best, have = nxt, have + step
    size = np.diff(off)
    full = size >= window
    mark = np.zeros(n + 1, np.int32)  # window starts: first key of the row to the last full window
    np.add.at(mark, off[:-1][full], 1)
    np.add.at(mark, off[1:][full] - window + 1, -1)
    chosen = best[:-1][np.cumsum(mark[:-1])[:-1] > 0] if n > 1 else best[:0]
    last = np.cumsum(mark[:-1])[-1] > 0
    if last:
        chosen = np.append(chosen, best[-1])
    pos = np.uint64(0xFFFFFFFF) - (chosen & np.uint64(0xFFFFFFFF))
    out = np.unique(pos.astype(np.int64))
    short = np.flatnonzero(~full & (size > 0))
    if len(short):
        bounds = np.stack([off[short], off[short + 1]], 1).ravel()
        if bounds[-1] == n:
            least = np.minimum.reduceat(low, bounds[:-1])[::2]
        else:
            least = np.minimum.reduceat(low, bounds)[::2]
        out = np.unique(np.concatenate([out, (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)]))
    return out
