"""SentencePiece encoding and decoding with the pieces and scores of a .model file.

Encoding finds the pieces with the largest sum of scores (Viterbi). A text is
cut into words wherever two neighbouring letters occur together in no piece (so
always before a space mark): the best path of a text is that of its words, one
after another. The distinct words of a block are grouped by length; equal-length
words advance together: hashes of all their substrings probe the sorted piece
keys, one step for each end position takes the maxima over the starts and
stores backpointers. Equal sums go to the longer last piece. Letters without a
piece become byte pieces.

``merge=True`` gives the ids of the merge order instead, for models that were
trained by byte-pair merges: the same words and probes, and in each step every
word merges its best scored pair, the leftmost among equals.

No letter is normalised. Null texts encode as empty.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import blocks, mix, word_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space, one is put before the text
#: Distinct words whose ids a task keeps for its next blocks.
KEPT_WORDS = 500_000
_BASE = np.uint64(0xD1342543DE82EF95)
#: Letters of equal-length words that advance together.
LETTERS = 1 << 18
#: Letters of a word from which on its merges are kept in a heap.
LONG = 256


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a serialised message: (number, integer or bytes)."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


def _letter(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) + _BASE)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a.astype(np.uint64) * _BASE + b) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)


def _taken(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + count]`` one after another."""
    upto = np.cumsum(count)
    return values[np.repeat(start - (upto - count), count) + np.arange(upto[-1] if len(upto) else 0)]


class Kept:
    """Ids of the words that a task has met, at most ``KEPT_WORDS`` beyond one block's own."""

    def __init__(self):
        self.keys, self.place, self.lists = np.zeros(0, np.uint64), np.zeros(0, np.int64), {}

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, by when it was added, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.place[at], self.keys[at] == keys

    def add(self, keys: np.ndarray, found: dict[bool, tuple[np.ndarray, np.ndarray]]) -> None:
        at = np.searchsorted(self.keys, keys)
        self.place = np.insert(self.place, at, len(self.keys) + np.arange(len(keys)))
        self.keys = np.insert(self.keys, at, keys)
        for merge, (ids, count) in found.items():
            have, n = self.lists.get(merge, (np.zeros(0, np.int32), np.zeros(0, np.int64)))
            self.lists[merge] = np.concatenate([have, ids]), np.concatenate([n, count])


class Pieces:
    """Pieces of a model: text, score and kind (1 normal, 2 unknown, 3 control, 6 byte) by id.

    Travels to the tasks within the functions that use it: some MB for 32,000 pieces.
    """

    def __init__(self, texts: list[str], scores: list[float], kinds: list[int]):
        self.texts, self.scores, self.kinds = texts, np.array(scores, np.float64), np.array(kinds)
        normal = np.flatnonzero((self.kinds == 1) | (self.kinds == 4))
        size = np.array([len(texts[i]) for i in normal])
        codes = np.frombuffer("".join(texts[i] for i in normal).encode("utf-32-le"), np.uint32)
        end = np.cumsum(size)
        first = np.zeros(len(codes), bool)
        first[end - size] = True
        self.together = np.zeros(1 << 20, bool)  # pairs of letters that some piece holds (or their hash does)
        self.together[_pair(codes[:-1], codes[1:])[~first[1:]]] = True
        keys = np.zeros(len(normal), np.uint64)
        for k in range(int(size.max())):
            more = size > k
            keys[more] = keys[more] * _BASE + _letter(codes[(end - size)[more] + k])
        by = np.argsort(keys)
        self.keys, self.ids, self.longest = keys[by], normal[by], int(size.max())
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces are equal")
        # where in the sorted keys those with each value of their first 20 bits begin
        self.begin = np.searchsorted(self.keys >> np.uint64(44), np.arange((1 << 20) + 1, dtype=np.uint64)).astype(np.int32)
        self.deepest = int(np.diff(self.begin).max())
        self.keys = np.append(self.keys, np.zeros(self.deepest, np.uint64))
        self.ids = np.append(self.ids, np.full(self.deepest, -1)).astype(np.int32)
        self.unknown = float(self.scores[normal].min()) - 10.0
        self.bytes = np.full(256, np.flatnonzero(self.kinds == 2)[0])
        for i in np.flatnonzero(self.kinds == 6):
            self.bytes[int(texts[i][1:-1], 16)] = i
        self.raw = [
            bytes([int(t[1:-1], 16)]) if kind == 6 else b"" if kind == 3 else t.replace(MARK, " ").encode()
            for t, kind in zip(texts, self.kinds, strict=True)
        ]

    @classmethod
    def load(cls, path: str) -> Pieces:
        rows = []
        with open(path, "rb") as f:
            for number, value in _fields(f.read()):
                if number == 1:
                    piece = dict(_fields(value))
                    rows.append((piece[1].decode(), float(np.frombuffer(piece.get(2, b"\0" * 4), "<f4")[0]), piece.get(3, 1)))
        return cls(*map(list, zip(*rows, strict=True)))

    def probe(self, h: np.ndarray) -> np.ndarray:
        """Id of the piece with each hash, or -1."""
        place = (h >> np.uint64(44)).astype(np.int32)
        at = self.begin[place]
        some = np.flatnonzero(self.begin[place + 1] > at)  # most substrings end here
        out = np.full(len(h), -1, np.int32)
        at, want = at[some], h[some]
        found = np.full(len(some), -1, np.int32)
        for k in range(self.deepest):
            hit = self.keys[at + k] == want
            found[hit] = self.ids[at[hit] + k]
        out[some] = found
        return out

    def _table(self, codes: np.ndarray) -> np.ndarray:
        """[word, end, length - 1]: id of the substring that ends with letter ``end``, or -1."""
        n, size = codes.shape
        letters = _letter(codes)
        wide = min(self.longest, size)
        out = np.full((n, size, wide), -1, np.int32)
        h = letters
        for length in range(1, wide + 1):
            if length > 1:
                h = h[:, :-1] * _BASE + letters[:, length - 1 :]
            out[:, length - 1 :, length - 1] = self.probe(h.ravel()).reshape(h.shape)
        return out

    def _best(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over equal-length words: (ids by end position, lengths by end position)."""
        n, size, wide = ids.shape
        gain = np.where(ids >= 0, self.scores[ids], -np.inf)
        gain[:, :, 0] = np.where(ids[:, :, 0] >= 0, gain[:, :, 0], self.unknown)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, size), np.int64)
        rows = np.arange(n)
        for end in range(size):
            reach = min(wide, end + 1)
            # longest first, so that argmax leaves equal sums to the longer last piece
            sums = best[:, end + 1 - reach : end + 1] + gain[:, end, :reach][:, ::-1]
            at = np.argmax(sums, axis=1)
            best[:, end + 1] = sums[rows, at]
            back[:, end] = reach - at
        return np.take_along_axis(ids, back[:, :, None] - 1, 2)[:, :, 0], back

    def _merged(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges the best pair of every word until none is left; result as of ``_best``."""
        n, size, wide = ids.shape
        length = np.ones((n, size), np.int64)  # of the piece that ends here; 0 where none does
        if size > LONG:
            for i in range(n):
                length[i] = self._merged_long(ids[i])
        elif size > 1:
            rows = np.arange(n)
            while len(rows):
                some = length[rows]
                ends = some > 0
                # the piece before the one that ends here ends right before its start
                before = np.arange(size)[None] - some
                left = np.where(ends & (before >= 0), np.take_along_axis(some, np.maximum(before, 0), 1), 0)
                both = some + left
                ok = (left > 0) & (both <= wide)
                pair = np.where(ok, np.take_along_axis(ids[rows], np.clip(both - 1, 0, wide - 1)[:, :, None], 2)[:, :, 0], -1)
                gain = np.where(pair >= 0, self.scores[pair], -np.inf)
                at = np.argmax(gain, axis=1)
                k = np.arange(len(rows))
                live = gain[k, at] > -np.inf
                rows, at, k = rows[live], at[live], k[live]
                length[rows, before[k, at]] = 0
                length[rows, at] = both[k, at]
        return np.take_along_axis(ids, np.maximum(length - 1, 0)[:, :, None], 2)[:, :, 0], length

    def _merged_long(self, ids: np.ndarray) -> np.ndarray:
        """``_merged`` of one long word, its candidate pairs in a heap: near-linear in its letters."""
        size, wide = ids.shape
        table, scores = ids.tolist(), self.scores.tolist()
        length, after = [1] * size, list(range(1, size + 1))  # the end of the piece behind the one that ends here
        pairs: list[tuple[float, int, int, int]] = []

        def pair(end: int) -> tuple[float, int, int, int] | None:
            own = length[end]
            if own > end:
                return None
            left = length[end - own]
            if own + left > wide:
                return None
            piece = table[end][own + left - 1]
            return (-scores[piece], end, own, left) if piece >= 0 else None

        pairs = [p for p in map(pair, range(1, size)) if p]
        heapq.heapify(pairs)
        while pairs:
            _, end, own, left = heapq.heappop(pairs)
            if length[end] != own or length[end - own] != left:
                continue  # one of the two has been merged since
            length[end - own], length[end] = 0, own + left
            if end >= own + left:
                after[end - own - left] = end
            for e in (end, after[end]):
                if e < size and (new := pair(e)):
                    heapq.heappush(pairs, new)
        return np.array(length, np.int64)

    def _spelled(self, codes: np.ndarray, table: np.ndarray, merge: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of equal-length words one after another, and how many each has."""
        ids, back = (self._merged if merge else self._best)(table)
        if merge:
            used = back > 0
        else:  # walk the backpointers of all words at once
            used = np.zeros(codes.shape, bool)
            end = np.full(len(codes), codes.shape[1])
            while (live := np.flatnonzero(end > 0)).size:
                used[live, end[live] - 1] = True
                end[live] -= back[live, end[live] - 1]
        found = ids[used]
        bare = np.flatnonzero(found < 0)  # letters without a piece
        if not len(bare):
            return found, used.sum(1)
        row = np.nonzero(used)[0]
        letters = [list(chr(c).encode("utf-8", "surrogatepass")) for c in codes[used][bare].tolist()]
        size = np.ones(len(found), np.int64)
        size[bare] = [len(x) for x in letters]
        out = np.repeat(found, size)
        out[out < 0] = self.bytes[[b for x in letters for b in x]]
        return out, np.bincount(row, size, len(codes)).astype(np.int64)

    def encode_words(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray, merges: tuple) -> dict[bool, tuple]:
        """Ids of the words ``codes[start : start + size]`` one after another, and how many each has."""
        by = np.argsort(size, kind="stable")
        parts = {merge: ([np.zeros(0, np.int32)], [np.zeros(0, np.int64)]) for merge in merges}
        edges = np.flatnonzero(np.diff(size[by], prepend=0, append=0))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            one = int(size[by[a]])
            step = max(1, LETTERS // (one * min(one, self.longest)))
            for at in range(a, b, step):
                words = codes[start[by[at : min(at + step, b)]][:, None] + np.arange(one)]
                table = self._table(words)
                for merge, (ids, count) in parts.items():
                    found, n = self._spelled(words, table, merge)
                    ids.append(found)
                    count.append(n)
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        out = {}
        for merge, (ids, count) in parts.items():
            ids, n = np.concatenate(ids), np.concatenate(count)
            out[merge] = _taken(ids, (np.cumsum(n) - n)[place], n[place]), n[place]
        return out

    def encode(self, texts: list[str], merges: tuple = (False,), kept: Kept | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids of all texts one after another, offsets), for Viterbi (False) or the merge order (True) as asked."""
        kept = Kept() if kept is None else kept
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        off = np.r_[0, np.cumsum([len(t) for t in marked])].astype(np.int64)
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            return [(np.zeros(0, np.int32), off)] * len(merges)
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.together[_pair(codes[:-1], codes[1:])]
        cut[off[off < len(codes)]] = True
        start = np.flatnonzero(cut)
        size = np.diff(start, append=len(codes))
        keys, first, word = np.unique(word_hashes(codes, start, start + size), return_index=True, return_inverse=True)
        if len(kept.keys) > KEPT_WORDS:
            kept.__init__()
        new = np.flatnonzero(~kept.find(keys)[1])
        if len(new):
            kept.add(keys[new], self.encode_words(codes, start[first[new]], size[first[new]], merges))
        row = kept.find(keys)[0][word]
        text_words = np.searchsorted(start, off)
        out = []
        for merge in merges:
            ids, count = kept.lists[merge]
            n = count[row]
            out.append((_taken(ids, (np.cumsum(count) - count)[row], n), np.r_[0, np.cumsum(n)][text_words]))
        return out

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """Texts of the id lists; the space put before the text goes, broken byte runs are replaced."""
        raw = [self.raw[i] for i in ids.tolist()]
        out = []
        for a, b in zip(off[:-1], off[1:], strict=True):
            text = b"".join(raw[a:b]).decode("utf-8", "replace")
            out.append(text[1:] if text.startswith(" ") else text)
        return out


def encoded(docs: DataFrame, pieces: Pieces, merge: bool = False) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Kept()
        for batch in blocks(batches):
            [(ids, off)] = pieces.encode([t or "" for t in batch.column("text").to_pylist()], (merge,), kept)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids)), pa.array(pieces.decode(ids, off), pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decoded(lists: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null lists decode as empty, ids outside the vocabulary are an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(x or [], np.int32) for x in batch.column("ids").to_pylist()]
            off = np.r_[0, np.cumsum([len(x) for x in rows])].astype(np.int64)
            ids = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            yield pa.record_batch([batch.column("doc_id"), pa.array(pieces.decode(ids, off), pa.string())], ["doc_id", "text"])

    return lists.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def encoded_rows(docs: DataFrame, pieces: Pieces, merge: bool = True) -> DataFrame:
    """(doc_id, source, n_pieces, ids, exact): every row encoded; ``exact`` says that its ids decode to its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Kept()
        for batch in blocks(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            [(ids, off)] = pieces.encode(texts, (merge,), kept)
            back = pieces.decode(ids, off)
            yield pa.record_batch([
                batch.column("doc_id"), batch.column("source"), pa.array(np.diff(off)),
                pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids)),
                pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_()),
            ], ["doc_id", "source", "n_pieces", "ids", "exact"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, source string, n_pieces long, ids array<int>, exact boolean"
    )


def round_trip(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """Digest of both ways: (doc_id, n_chars, n_pieces, n_bytes, ids_sha256, exact, merge_pieces, merge_sha256).

    ``ids_sha256`` is of the ids as little-endian 32-bit integers, ``n_bytes``
    counts byte pieces, ``exact`` says that decoding gave the text back;
    ``merge_*`` are of the ids in merge order.
    """
    def digests(ids: np.ndarray, off: np.ndarray) -> pa.Array:
        data = ids.astype("<i4").tobytes()
        return pa.array([hashlib.sha256(data[4 * a : 4 * b]).hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Kept()
        for batch in blocks(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            (ids, off), (other, other_off) = pieces.encode(texts, (False, True), kept)
            back = pieces.decode(ids, off)
            fallback = np.r_[0, np.cumsum(pieces.kinds[ids] == 6)]
            yield pa.record_batch([
                batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(np.diff(off)),
                pa.array(fallback[off[1:]] - fallback[off[:-1]], pa.int64()), digests(ids, off),
                pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_()),
                pa.array(np.diff(other_off)), digests(other, other_off),
            ], ["doc_id", "n_chars", "n_pieces", "n_bytes", "ids_sha256", "exact", "merge_pieces", "merge_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_chars long, n_pieces long, n_bytes long, ids_sha256 string, exact boolean, merge_pieces long, merge_sha256 string"
    )
