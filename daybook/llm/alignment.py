"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut the same bytes (a space and the text), so their tokens are
intervals over one line. Interval coalescing: the tokens of both sides are sorted
by start, a running maximum of the ends is kept, and a new group begins where a
start reaches it. Within a group the sides overlap: each of its A tokens is
linked with each of its B tokens. A pair of ids counts the documents that hold it
linked, over the whole corpus.

Plan: one pass encodes the documents and writes, for each, its figures and its
distinct linked pairs with their number of links. Runs of documents form blocks;
a block asks for the corpus count of each of its distinct pairs once. The
questions are summed over all blocks with one shuffle by pair, and the answers
travel back to their block, where the documents' sums are taken. No table of all
pairs is broadcast or collected; the only broadcast is the highest count of each
A id, bounded by the vocabulary.

Texts that are null, empty, or that either side doesn't give back byte for byte
have no tokens. Rows are documents: equal rows, and rows without id, count each
for themselves. An empty table gives an empty result; columns other than
``doc_id`` and ``text`` are not read, whatever their names. Memory is bounded by a
block of about 2 MB of text, or by the longest text: a group's links are counted
by distinct ids, never listed one by one, once they are many.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import blocks, written

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed value: how the byte-level vocabulary cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of white space from which on the first library's word pattern overflows.
LONG_SPACE = re.compile(r"\s{1000}")
#: Runs of about 2 MB of text that form a block.
BLOCK_RUNS = 16
#: Links of one group up to which they are listed before they are counted.
LISTED = 4096
#: Pairs that a run of documents handles at once; more are handled by ranges of A ids.
PAIRS = 1 << 23


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1
    letters stand for themselves, the other bytes in order for the letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE vocabulary (JSON). Encodes with merges in the order of the ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.text = f.read()
        self._ready = None

    def __getstate__(self):
        return {"text": self.text, "_ready": None}

    def _load(self):
        import tiktoken

        spec = json.loads(self.text)
        special = {t["content"] for t in spec["added_tokens"] if t["special"]}
        letter = byte_letters()
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if merged != sorted(merged) or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a byte-level vocabulary whose ids follow its merges")
        ranks = {bytes(letter[c] for c in t): i for t, i in vocab.items()}
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes[i] = t
        encoding = tiktoken.Encoding("vocabulary", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self._ready = (encoding.encode_ordinary, None)

    def table(self) -> list[bytes]:
        if self._ready is None:
            self._load()
        return self.bytes

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._ready is None:
            self._load()
        fast, slow = self._ready
        out = []
        for t in texts:
            if len(t) >= 1000 and LONG_SPACE.search(t):
                if slow is None:
                    from tokenizers import Tokenizer

                    slow = Tokenizer.from_str(self.text)
                    slow.encode_special_tokens = True
                    self._ready = (fast, slow)
                out.append(slow.encode(t, add_special_tokens=False).ids)
            else:
                out.append(fast(t))
        return out


class PieceModel:
    """A SentencePiece model. It puts a space before the text itself."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.proto = f.read()
        self._ready = None

    def __getstate__(self):
        return {"proto": self.proto, "_ready": None}

    def _load(self):
        import sentencepiece

        m = self._ready = sentencepiece.SentencePieceProcessor(model_proto=self.proto)
        self.bytes = [
            bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
            for i in range(m.get_piece_size())
        ]

    def table(self) -> list[bytes]:
        if self._ready is None:
            self._load()
        return self.bytes

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._ready is None:
            self._load()
        return self._ready.encode(texts, num_threads=1)


# -- groups and links of a run of documents ---------------------------------------


def coalesce(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and of each B interval: groups break where a start reaches the
    running maximum of the ends before it. Groups are numbered from 0, by start."""
    start, end = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    order = np.lexsort((end, start))
    far = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), bool)
    opens[1:] = start[order][1:] >= far[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    return group[: len(starts_a)], group[len(starts_a) :]


def _within(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each run of ``size``."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def linked_pairs(
    a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, row: np.ndarray, n_b: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, pair, links) of every distinct linked id pair of a row; pair is ``a * n_b + b``.

    ``row`` is the row of each group. Groups of few links are listed; in others the
    distinct ids of both sides are counted and multiplied. When the pairs are many,
    ranges of A ids are handled one after another; each pair is in one of them.
    """
    groups = len(row)
    size_a, size_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    links = size_a * size_b
    large = np.flatnonzero(links > LISTED)
    counted = [
        (g, *np.unique(a[first_a[g] : first_a[g] + size_a[g]], return_counts=True), *np.unique(b[first_b[g] : first_b[g] + size_b[g]], return_counts=True))
        for g in large
    ]
    small_a = np.flatnonzero(links[group_a] <= LISTED)
    total = int(links[links <= LISTED].sum()) + sum(len(ua) * len(ub) for _, ua, _, ub, _ in counted)
    parts = -(-total // PAIRS) or 1
    cuts = np.quantile(a, np.arange(1, parts) / parts, method="lower") if parts > 1 else []
    cuts = [-1, *np.unique(cuts).tolist(), np.iinfo(np.int64).max]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):  # A ids above low, up to high
        at = small_a if parts == 1 else small_a[(a[small_a] > low) & (a[small_a] <= high)]
        g = group_a[at]
        keys = [np.repeat(a[at], size_b[g]) * n_b + b[_within(first_b[g], size_b[g])]]
        rows = [np.repeat(row[g], size_b[g])]
        times = [np.ones(len(keys[0]), np.int64)]
        for g, ua, ca, ub, cb in counted:
            mine = (ua > low) & (ua <= high)
            keys.append((ua[mine][:, None] * n_b + ub[None, :]).ravel())
            times.append((ca[mine][:, None] * cb[None, :]).ravel())
            rows.append(np.full(len(keys[-1]), row[g]))
        key, times, rows = np.concatenate(keys), np.concatenate(times), np.concatenate(rows)
        if not len(key):
            continue
        order = np.lexsort((key, rows))
        key, rows = key[order], rows[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (rows[1:] != rows[:-1])
        new = np.flatnonzero(new)
        yield rows[new], key[new], np.add.reduceat(times[order], new)


def _digests(a: list[bytes], b: list[bytes], group_a: np.ndarray, group_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> list[str]:
    """Digest of ``a1,a2|b1;a3|b2,b3`` for each row; '' for a row without tokens."""
    last_a = np.ones(len(group_a), bool)
    last_a[:-1] = group_a[1:] != group_a[:-1]
    last_b = np.ones(len(group_b), bool)
    last_b[:-1] = group_b[1:] != group_b[:-1]
    # a token's place: tokens of its side before it, and those of the other side that come before its group's turn
    place_a = np.arange(len(group_a)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(group_b)) + np.searchsorted(group_a, group_b, "right")
    parts = np.empty(len(group_a) + len(group_b), object)
    parts[place_a] = np.where(last_a, a[1], a[0])
    parts[place_b] = np.where(last_b, b[1], b[0])
    bounds = first_a + first_b
    out = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        out.append(hashlib.sha256(b"".join(parts[low:high].tolist())[:-1]).hexdigest() if high > low else "")
    return out


_NAMES = ["doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "block", "pairs", "times"]
_TOKENS = (
    "doc long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, pairs binary, times binary"
)


def _ragged(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(r) for r in rows], np.int64)
    flat = np.fromiter((i for r in rows for i in r), np.int64, int(size.sum()))
    return flat, np.r_[0, np.cumsum(size)]


def _cut(side, texts: list[str], wanted: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, row offsets, and which rows the ids give back byte for byte."""
    ids, off = _ragged(side.encode(texts))
    same = np.zeros(len(texts), bool)
    parts = table[ids].tolist()
    for i, w in enumerate(wanted):
        same[i] = b"".join(parts[off[i] : off[i + 1]]) == w
    return ids, off, same


def _kept(ids: np.ndarray, off: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(off)
    return ids[np.repeat(good, size)], np.r_[0, np.cumsum(np.where(good, size, 0))]


def _key_type(pairs: int) -> str:
    return "<u4" if pairs <= 1 << 32 else "<i8"


def _bytes(values: np.ndarray, kind: str, at: np.ndarray) -> pa.Array:
    """The values of each row in binary."""
    raw, step = values.astype(kind).tobytes(), np.dtype(kind).itemsize
    return pa.array([raw[step * x : step * y] for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())


def aligned(docs: DataFrame, a_side: ByteLevel, b_side: PieceModel) -> DataFrame:
    """Each document's alignment: token, group and link numbers, the groups' digest, and its distinct
    linked pairs, little-endian: ``pairs`` (``a * size of B + b``, ascending) and ``times``, the
    links of each. ``doc`` numbers the rows of ``docs``. A document with very many pairs has
    several rows; all but the first hold further pairs alone and null figures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_a, table_b = (np.array(s.table(), object) for s in (a_side, b_side))
        size_a, size_b = (np.array([len(t) for t in table], np.int64) for table in (table_a, table_b))
        # each id in decimal with what follows it: inside its side of the group, or at the side's end
        names_a, names_b = (
            [np.array([b"%d%s" % (i, sep) for i in range(len(t))], object) for sep in seps]
            for t, seps in ((table_a, (b",", b"|")), (table_b, (b",", b";")))
        )
        kind = _key_type(len(table_a) * len(table_b))
        task = TaskContext.get().partitionId() << 32
        block, seen, runs, held = task, 0, 0, 0
        for batch in blocks(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = len(texts)
            wanted = [b" " + t.encode() if t else b"" for t in texts]
            a, off_a, same_a = _cut(a_side, [" " + t if t else "" for t in texts], wanted, table_a)
            b, off_b, same_b = _cut(b_side, texts, wanted, table_b)
            good = same_a & same_b & np.array([bool(t) for t in texts], bool)
            (a, off_a), (b, off_b) = _kept(a, off_a, good), _kept(b, off_b, good)
            ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
            # the texts follow each other on one line, and no group runs over a text's edge
            group_a, group_b = coalesce(ends_a - size_a[a], ends_a, ends_b - size_b[b], ends_b)
            groups = int(group_a[-1]) + 1 if len(group_a) else 0
            row = np.zeros(groups, np.int64)
            row[group_a] = np.repeat(np.arange(n), np.diff(off_a))
            n_links = np.zeros(n, np.int64)
            np.add.at(n_links, row, np.bincount(group_a, minlength=groups) * np.bincount(group_b, minlength=groups))
            digests = _digests([t[a] for t in names_a], [t[b] for t in names_b], group_a, group_b, off_a, off_b)
            numbers = pa.array(task + seen + np.arange(n))
            figures = [
                batch.column("doc_id"), pa.array(np.diff(off_a)), pa.array(np.diff(off_b)),
                pa.array(np.bincount(row, minlength=n)), pa.array(n_links), pa.array(digests, pa.string()),
            ]
            seen, runs, first = seen + n, runs + 1, True
            none = np.zeros(0, np.int64)
            for rows, key, times in linked_pairs(a, b, group_a, group_b, row, len(table_b)) if groups else [(none, none, none)]:
                if runs > BLOCK_RUNS or held + len(key) > PAIRS:
                    block, runs, held = block + 1, 1, 0
                held += len(key)
                at = np.searchsorted(rows, np.arange(n + 1))
                most = times.max(initial=0)
                out = pa.record_batch([
                    numbers, *(figures if first else [pa.nulls(n, c.type) for c in figures]), pa.array(np.full(n, block)),
                    _bytes(key, kind, at), _bytes(times, "<u1" if most < 256 else "<u2" if most < 65536 else "<i8", at),
                ], _NAMES)
                yield out if first else out.take(pa.array(np.flatnonzero(np.diff(at))))
                first = False

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _TOKENS)


def _values(pairs: pa.Array, times: pa.Array | None, kind: str) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """The pairs and their links of all rows, and the rows' offsets."""
    keys = pairs.to_pylist()
    step = np.dtype(kind).itemsize
    off = np.r_[0, np.cumsum([len(k) // step for k in keys], dtype=np.int64)]
    links = None
    if times is not None:  # the links of a row are as wide as its largest needs
        parts = [
            np.frombuffer(t, {1: "<u1", 2: "<u2", 8: "<i8"}[len(t) * step // len(k)]).astype(np.int64)
            for k, t in zip(keys, times.to_pylist(), strict=True) if k
        ]
        links = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return np.frombuffer(b"".join(keys), kind).astype(np.int64), links, off


def _questions(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, pair, rows that hold it), summed over runs of rows of one block."""
        held: list[np.ndarray] = []
        at, room = None, 0

        def asked():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(np.full(len(key), at)), pa.array(key), pa.array(n.astype(np.int64))], ["block", "pair", "n"])

        for batch in batches:
            block = batch.column("block").to_numpy(zero_copy_only=False)
            keys, _, off = _values(batch.column("pairs"), None, kind)
            edges = np.flatnonzero(np.diff(block)) + 1
            for low, high in zip([0, *edges], [*edges, len(block)], strict=True):
                if low == high:
                    continue
                if held and (block[low] != at or room > PAIRS):
                    yield asked()
                    held, room = [], 0
                at = int(block[low])
                held.append(keys[off[low] : off[high]])
                room += int(off[high] - off[low])
        if held:
            yield asked()

    return run


def pair_counts(tokens: DataFrame, size_a: int, size_b: int) -> DataFrame:
    """(block, pair, n, best) for every distinct pair of a block of ``aligned`` rows: the documents of
    all blocks that hold the pair, and whether no pair of the same A id is held by more. A block's pair
    may come more than once. A document's rows hold different pairs, so each counts a pair once."""
    asked = tokens.where(F.length("pairs") > 0).select("block", "pairs").mapInArrow(_questions(_key_type(size_a * size_b)), "block long, pair long, n long")
    every = asked.withColumn("n", F.sum("n").over(Window.partitionBy("pair"))).withColumn("a", F.expr(f"pair div {size_b}"))
    every = written(every, "pair-counts")
    highest = every.groupBy("a").agg(F.max("n").alias("highest"))  # at most the ids of A
    return every.join(F.broadcast(highest), "a").select("block", "pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _sums(kind: str):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """The sums of a block's rows: links whose count is their A id's highest, and counts over links."""
        pair, first = np.unique(answers.column("pair").to_numpy(), return_index=True)
        count, best = (answers.column(c).to_numpy()[first] for c in ("n", "best"))
        n_best, count_sum = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in docs.to_batches():
            keys, links, off = _values(batch.column("pairs"), batch.column("times"), kind)
            at = np.searchsorted(pair, keys)
            for value, out in ((np.where(best[at], links, 0), n_best), (count[at] * links, count_sum)):
                sums = np.r_[0, np.cumsum(value)]
                out.append(sums[off[1:]] - sums[off[:-1]])
        figures = {c: docs.column(c) for c in _NAMES[:7]}
        return pa.table({**figures, "n_best": np.concatenate(n_best), "count_sum": np.concatenate(count_sum)})

    return run


_FIGURES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def alignment_scores(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Of every document: doc_id, its tokens on both sides (n_a, n_b), n_groups, n_links, n_best (links
    whose pair's count is their A id's highest), count_sum (counts over links) and groups_sha256."""
    a_side, b_side = ByteLevel(a_path), PieceModel(b_path)
    size_a, size_b = len(a_side.table()), len(b_side.table())
    tokens = written(aligned(docs, a_side, b_side), "aligned")
    counts = pair_counts(tokens, size_a, size_b)
    some, none = tokens.where(F.length("pairs") > 0), tokens.where(F.length("pairs") == 0)
    sums = some.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(
        _sums(_key_type(size_a * size_b)),
        "doc long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long",
    )
    # the rows of a document with very many pairs meet again
    whole = sums.groupBy("doc").agg(
        *[(F.sum if c in ("n_best", "count_sum") else F.max)(c).alias(c) for c in _FIGURES]
    ).select(*_FIGURES)
    zero = F.lit(0).cast("long")
    return whole.unionAll(none.withColumns({"n_best": zero, "count_sum": zero}).select(*_FIGURES))
