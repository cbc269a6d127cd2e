"""Fuzzy passages that repeat across documents, by collinear chaining.

1. Seeds: hashes of every run of ``K`` words (ASCII lower case), winnowed to the
   least of each ``WINDOW`` consecutive ones, so any equal passage of
   ``K + WINDOW - 1`` words shares a seed. Seeds of periodic text are numbered.
2. Anchors: every seed occurrence is joined to the seed's first occurrence in
   document order. Within a block of text this happens before the shuffle, so a
   seed that a third of all documents hold sends one row a block. Links form a
   star, never all pairs.
3. Chains: the anchors of a pair of documents, merged into runs on one diagonal,
   are chained in order of both documents. A Fenwick tree over the partner's
   places holds the best chain so far with its gap costs, so the best predecessor
   takes logarithmic time.
4. Alignment: each chain's two passages are fetched, extended word by word along
   the outer runs while they agree, and aligned; a chain of at least
   ``MIN_WORDS`` words that agree in ``SIMILARITY`` or more of them is a passage.
   A chain may be one seed; a short one is looked at with ``MIN_WORDS`` more on each side.
   A chain that agrees in fewer is taken apart: its longest parts that do are passages.
5. Second round: a seed's first document may hold too little of a passage that two
   later ones share. Where linked seeds are left outside the passages, every window
   of ``MIN_WORDS`` words in all documents that hold those seeds one after another is
   joined to the first document with the same window; steps 3 and 4 follow. So a run
   of ``MIN_WORDS`` equal words is found whatever documents come before.

The document order is doc_id (nulls last), then a hash of the text; the first
document of a passage keeps it. Rows equal in doc_id and text count as one
document. Null texts are empty. Runs within one document are not looked for.
A passage whose seeds have different first documents, and that has no ``MIN_WORDS``
equal words on end, is found where two seeds of one of them lie within ``GAP``; the ends of a periodic text (one word or line again
and again) may lack up to a window and a period of words. Periodic text with a period
of more than ``CYCLE`` words is matched with the first document of its seeds only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daybook.llm.common import LOWER, Rolling, blocks, discard, flat, mix, release, scratch, window_minima, word_hashes, word_spans, written

K, WINDOW = 5, 16
MIN_WORDS, SIMILARITY = 50, 0.8
#: Words in which the numbers of a periodic text's seeds go round.
CYCLE = 16
#: Words between two runs of a chain, at most, in either document.
GAP = 48
#: Cost of a word between two runs, in words gained.
GAP_COST = 0.15
#: Bytes fetched beyond a chain's ends, to extend it.
MARGIN = 400
#: Bytes fetched behind a chain's last seed where fewer than ``K`` words end within two margins.
LONG_MARGIN = 64 * MARGIN

_SEED = "seed long, o long, id long, pos int, byte int, o0 long, id0 long, pos0 int, byte0 int, more boolean"
_WINDOW = "seed long, o long, id long, pos int, byte int, last int, o0 long, id0 long, pos0 int, byte0 int, last0 int, open boolean"


def _numbered(seed: np.ndarray, o: np.ndarray, doc: np.ndarray, at: np.ndarray, words: np.ndarray, k: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Seeds, sorted by seed, document and place, that follow themselves at one distance stand in periodic text.

    They are told apart by a number that goes round in ``CYCLE`` words, so that two
    periodic texts match place by place and a long one matches a shorter one's
    cycle again and again. Those in periodic text of ``MIN_WORDS`` or more are told
    apart from the others, so that a short one that comes first doesn't stand for
    all. ``at`` is the place among all ``words``, ``first`` and ``end`` are the bounds of its row.
    """
    n = len(seed)
    if not n:
        return seed
    gap = np.zeros(n, np.int64)
    gap[1:] = np.where((seed[1:] == seed[:-1]) & (doc[1:] == doc[:-1]) & (o[1:] == o[:-1]), np.diff(at), 0)
    gap[(gap < 0) | (gap > CYCLE)] = 0
    start = gap == 0
    start[1:] |= (gap[:-1] > 0) & (gap[1:] != gap[:-1])
    head = np.flatnonzero(start)
    tail = np.append(head[1:], n) - 1
    head, tail = head[tail > head], tail[tail > head]
    period, low, high = gap[head + 1], at[head], at[tail] + k
    for _ in range(2 * CYCLE):  # the period goes on beyond the outer seeds, by less than a window and a period
        more = (low > first[head]) & (words[low - 1] == words[low - 1 + period])
        low = low - more
        more = high < end[head]
        more[more] = words[high[more]] == words[high[more] - period[more]]
        high = high + more
    size = tail - head + 1
    run = np.repeat(np.arange(len(head)), size)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
    where = head[run] + nth
    number = nth % np.maximum(CYCLE // period, 2)[run] + np.where(high - low >= MIN_WORDS, 1 << 16, 0)[run]
    out = seed.copy()
    out[where] = np.where(number > 0, mix(seed[where] + number.astype(np.uint64)), seed[where])
    return out


def _seeds(k: int, window: int):
    """Seeds of a block. Those of later documents carry the block's first occurrence (o0, id0, pos0, byte0).

    ``more`` tells whether the block's first document with the seed isn't the only one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            raw, off = flat(batch.column("text"))
            start, end, first = word_spans(raw, off)
            count = np.diff(first)
            words = word_hashes(LOWER[raw], start, end)
            grams = np.zeros(max(len(words) - k + 1, 0), np.uint64)
            for i in range(k):
                grams += mix(words[i : len(words) - k + 1 + i] + np.uint64(i)) * np.uint64(2 * i + 3)
            grams = mix(grams)
            n = np.maximum(count - k + 1, 0)
            place = np.cumsum(n) - n
            at = np.arange(n.sum()) + np.repeat(first[:-1] - place, n)
            chosen = at[window_minima(grams[at], np.r_[place, n.sum()], window)]
            row = np.searchsorted(first, chosen, "right") - 1
            pos = chosen - first[row]
            byte = start[chosen] - off[row]
            seed = grams[chosen]
            o = batch.column("o").to_numpy()[row]
            doc = batch.column("id").to_numpy()[row]
            by = np.lexsort((pos, o, doc, seed))
            seed, o, doc, pos, byte, chosen, row = seed[by], o[by], doc[by], pos[by], byte[by], chosen[by], row[by]
            one = np.ones(len(seed), bool)  # rows equal in id and text bring the same occurrences
            one[1:] = (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1]) | (o[1:] != o[:-1]) | (pos[1:] != pos[:-1])
            seed, o, doc, pos, byte = seed[one], o[one], doc[one], pos[one], byte[one]
            seed = _numbered(seed, o, doc, chosen[one], words, k, first[row[one]], first[row[one] + 1])
            by = np.lexsort((pos, o, doc, seed))
            seed, o, doc, pos, byte = seed[by], o[by], doc[by], pos[by], byte[by]
            new = np.ones(len(seed), bool)
            new[1:] = seed[1:] != seed[:-1]
            lead = np.maximum.accumulate(np.where(new, np.arange(len(seed)), 0))
            own = (o[lead] == o) & (doc[lead] == doc)  # all that the block's first document holds: it may repeat an earlier one's
            cols = [
                pa.array(seed.view(np.int64)), pa.array(o), pa.array(doc),
                pa.array(pos.astype(np.int32)), pa.array(byte.astype(np.int32)),
            ]
            for x, kind in ((o, pa.int64()), (doc, pa.int64()), (pos, pa.int32()), (byte, pa.int32())):
                cols.append(pa.array(x[lead].astype(kind.to_pandas_dtype()), kind, mask=own))
            cols.append(pa.array(~own[np.flatnonzero(np.r_[new[1:], True])][np.cumsum(new) - 1] if len(own) else own))
            out = pa.record_batch(cols, ["seed", "o", "id", "pos", "byte", "o0", "id0", "pos0", "byte0", "more"])
            yield out.take(pa.array(np.lexsort((pos, doc, o))))  # rising places of a document take less room when written

    return run


def chain(x: np.ndarray, y: np.ndarray, k: int = K, gap: int = GAP, cost: float = GAP_COST) -> list[list[tuple[int, int, int]]]:
    """Chains of runs (x, y, words) from anchors at word ``x`` and ``y`` of two documents, best first.

    Anchors of one diagonal that follow each other closely are one run. A run's
    best predecessor ends before it in both documents, no more than ``gap`` words
    away; its score is its words, plus the predecessor's score less the gaps'
    cost. The Fenwick tree holds, by end in ``y``, the best score corrected for
    the gap cost, so that one prefix maximum finds it. No run is in two chains.
    """
    by = np.lexsort((x, y - x))
    x, y = x[by], y[by]
    new = np.r_[True, (np.diff(y - x) != 0) | (np.diff(x) > gap)]
    head = np.flatnonzero(new)
    tail = np.r_[head[1:], len(x)] - 1
    rx, ry, size = x[head], y[head], x[tail] - x[head] + k
    order = np.argsort(rx, kind="stable")
    rx, ry, size = rx[order].tolist(), ry[order].tolist(), size[order].tolist()
    n = len(rx)
    ends = sorted({b + s for b, s in zip(ry, size, strict=True)})
    rank = {e: i + 1 for i, e in enumerate(ends)}
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (len(ends) + 1)
    score, back = [0.0] * n, [-1] * n
    closing = sorted(range(n), key=lambda i: rx[i] + size[i])  # runs enter the tree once the sweep has passed their end
    waiting = 0
    starts = np.searchsorted(ends, ry, "right")
    for i in range(n):
        while waiting < n and rx[closing[waiting]] + size[closing[waiting]] <= rx[i]:
            j = closing[waiting]
            value = (score[j] + cost * (rx[j] + ry[j] + 2 * size[j]), j)
            at = rank[ry[j] + size[j]]
            while at <= len(ends):
                if value > tree[at]:
                    tree[at] = value
                at += at & -at
            waiting += 1
        best, at = (-np.inf, -1), int(starts[i])
        while at:
            if tree[at] > best:
                best = tree[at]
            at &= at - 1
        score[i] = float(size[i])
        j = best[1]
        if j >= 0 and rx[i] - rx[j] - size[j] <= gap and ry[i] - ry[j] - size[j] <= gap:
            joined = best[0] - cost * (rx[i] + ry[i]) + size[i]
            if joined > score[i]:
                score[i], back[i] = joined, j
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append((rx[i], ry[i], size[i]))
            i = back[i]
        if path:
            out.append(path[::-1])
    return out


_CHAIN = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "o", "id0", "o0")] + [
    T.StructField(c, T.IntegerType()) for c in ("x", "y", "xb", "yb", "xe", "ye")
] + [T.StructField("runs", T.ArrayType(T.IntegerType()))])


def _chains(k: int):
    """Chains of each document pair; a pair's anchors come one after another, repeated ones next to each other."""

    def finish(pair, rows):
        x, y, xb, yb = (np.concatenate([r[c] for r in rows]) for c in ("pos", "pos0", "byte", "byte0"))
        at_x, at_y = dict(zip(x.tolist(), xb.tolist(), strict=True)), dict(zip(y.tolist(), yb.tolist(), strict=True))
        for runs in chain(x.astype(np.int64), y.astype(np.int64), k):
            (x0, y0, _), (x1, y1, size) = runs[0], runs[-1]
            yield (
                *pair, x0, y0, at_x[x0], at_y[y0], at_x[x1 + size - k], at_y[y1 + size - k],
                [v for a, b, n in runs for v in (a - x0, b - y0, n)],
            )

    names = ("id", "o", "id0", "o0")

    def table(rows):
        cols = list(zip(*rows, strict=True)) if rows else [[] for _ in _CHAIN]
        kinds = [pa.int64()] * 4 + [pa.int32()] * 6 + [pa.list_(pa.int32())]
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [f.name for f in _CHAIN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, rows, last = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (*names, "pos", "pos0")], 1)
            one = np.r_[last is None or bool((place[0] != last).any()), (place[1:] != place[:-1]).any(1)]
            last = place[-1]
            col = {c: batch.column(c).to_numpy()[one] for c in batch.schema.names}
            key = place[one, : len(names)]
            edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1), True]) if len(key) else np.zeros(1, int)
            out = []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                here = tuple(key[a].tolist())
                if here != pair:
                    if rows:
                        out += finish(pair, rows)
                    pair, rows = here, []
                rows.append({c: col[c][a:b] for c in ("pos", "pos0", "byte", "byte0")})
            yield table(out)
        if rows:
            yield table(list(finish(pair, rows)))

    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words that a best alignment of two short runs matches."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b) and (a == b).mean() > 0.5:
        return int((a == b).sum())
    best = np.zeros(len(b) + 1, np.int64)
    for w in a:
        step = np.maximum(best[1:], best[:-1] + (b == w))
        best[1:] = np.maximum.accumulate(step)
    return int(best[-1])


def _extend(a: np.ndarray, b: np.ndarray, drop: int = 12) -> tuple[int, int]:
    """How far two runs go on alike: (words, matches); ends before agreement falls ``drop`` behind its best."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    gain = np.cumsum(np.where(same, 1, -2))
    fallen = np.flatnonzero(np.maximum.accumulate(np.maximum(gain, 0)) - gain > drop)
    if len(fallen):
        gain = gain[: fallen[0]]
    if not len(gain) or gain.max() <= 0:
        return 0, 0
    far = int(gain.argmax()) + 1
    return far, int(same[:far].sum())


def _parts(a: np.ndarray, b: np.ndarray, runs: list, min_words: int, similarity: float) -> list[tuple[int, int, int, int, int]]:
    """Passages (x, end of x, y, end of y, matches) in a chain that is none as a whole.

    The chain is cut into stretches of equal words; between two runs, each goes on
    as far as the words agree. Parts from one stretch to another that are long and
    alike enough, and not within a longer such part, are passages; one whose
    stretches two others hold is left out.
    """
    blocks, bridge = [], []  # (x, y, words); matches between a block and the one before

    def add(x: int, y: int, same: np.ndarray) -> None:
        edge = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
        for first, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            blocks.append((x + first, y + first, end - first))
            bridge.append(0)

    at = None
    for x, y, n in runs:
        between = 0
        if at:
            far, _ = _extend(a[at[0] : x], b[at[1] : y])
            add(*at, a[at[0] : at[0] + far] == b[at[1] : at[1] + far])
            u, v = at[0] + far, at[1] + far
            back, _ = _extend(a[u:x][::-1], b[v:y][::-1])
            between = _common(a[u : x - back], b[v : y - back])
            x, y, n = x - back, y - back, n + back
        before = len(blocks)
        add(x, y, a[x : x + n] == b[y : y + n])
        if len(blocks) > before:
            bridge[before] = between
        at = x + n, y + n
    if not blocks:
        return []
    x, y, n = np.array(blocks).T
    hits = np.cumsum(n + bridge)  # up to a block's end
    base = hits - n
    good = []
    for i in range(len(n)):
        low = good[-1][1] + 1 if good else i
        low = max(low, i)
        words, partner = x[low:] + n[low:] - x[i], y[low:] + n[low:] - y[i]
        fits = np.flatnonzero((words >= min_words) & (hits[low:] - base[i] >= similarity * np.maximum(words, partner)))
        if len(fits):
            part = i, low + int(fits[-1])
            if len(good) > 1 and i <= good[-2][1] + 1:
                good.pop()
            good.append(part)
    out = []
    for i, j in good:
        i, j = _trimmed(x, n, i, j, min_words)
        out.append((int(x[i]), int(x[j] + n[j]), int(y[i]), int(y[j] + n[j]), int(hits[j] - base[i])))
    return out


def _trimmed(x: np.ndarray, n: np.ndarray, i: int, j: int, min_words: int) -> tuple[int, int]:
    """A part's blocks without those at its ends that a ``_extend`` wouldn't reach, if it stays long enough."""
    for _ in range(2):
        gain, best, cut = 0, 0, j
        for k in range(j, i, -1):
            gain += int(n[k]) - 2 * int(x[k] - x[k - 1] - n[k - 1])
            if gain < best and x[k - 1] + n[k - 1] - x[i] >= min_words:
                best, cut = gain, k - 1
        j = cut
        gain, best, cut = 0, 0, i
        for k in range(i, j):
            gain += int(n[k]) - 2 * int(x[k + 1] - x[k] - n[k])
            if gain < best and x[j] + n[j] - x[k + 1] >= min_words:
                best, cut = gain, k + 1
        i = cut
    return i, j


_FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "o", "id0", "o0")] + [
    T.StructField(c, T.IntegerType()) for c in ("first_word", "n_words", "first_byte", "end_byte", "partner_word", "partner_words")
] + [T.StructField("similarity", T.DoubleType())])


def _too_few(
    a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray], n: np.ndarray,
    min_words: int, similarity: float, drop: int = 12,
) -> np.ndarray:
    """Which chains of one run of ``n`` words can be no passage, all looked at together.

    A side is (word hashes, index of the run's first word, bounds of the row: first
    and end, as one array of two rows). A chain can be none if its extension ends
    on both sides within ``min_words`` words, and the diagonal through it has too few
    equal words in that many on each side: no part of it is long and alike enough.
    """
    (words_a, x, ends_a), (words_b, y, ends_b) = a, b
    few, ended = n.copy(), np.ones(len(n), bool)
    far = np.arange(min_words)
    for i, j, step in ((x - 1, y - 1, -1), (x + n, y + n, 1)):
        i, j = i[:, None] + step * far, j[:, None] + step * far
        there = (i >= ends_a[0][:, None]) & (i < ends_a[1][:, None]) & (j >= ends_b[0][:, None]) & (j < ends_b[1][:, None])
        same = there & (words_a[np.where(there, i, 0)] == words_b[np.where(there, j, 0)])
        gain = np.cumsum(np.where(same, 1, np.where(there, -2, -4 * min_words)), axis=1)
        ended &= (np.maximum.accumulate(np.maximum(gain, 0), axis=1) - gain > drop).any(axis=1)
        few = few + same.sum(axis=1)
    return ended & (few < similarity * min_words)


def _align(min_words: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(blocks(batches, "a"), "b"):
            sides = []
            for c in ("a", "b"):
                raw, off = flat(batch.column(c))
                start, end, first = word_spans(raw, off)
                sides.append((word_hashes(LOWER[raw], start, end), start, end, first, off))
            (ha, sa, ea, fa, oa), (hb, sb, _, fb, ob) = sides
            place = {c: batch.column(c).to_numpy().astype(np.int64) for c in ("xb", "yb", "from_a", "from_b")}
            at_a = np.searchsorted(sa, oa[:-1] + place["xb"] - place["from_a"])  # the run's first word in the block
            at_b = np.searchsorted(sb, ob[:-1] + place["yb"] - place["from_b"])
            values, size = batch.column("runs").flatten().to_numpy().astype(np.int64), pc.list_value_length(batch.column("runs")).to_numpy()
            first_value = np.cumsum(size) - size
            single = np.flatnonzero(size == 3)
            none = np.zeros(batch.num_rows, bool)
            if len(single) and len(ha) and len(hb):
                none[single] = _too_few(
                    (ha, at_a[single], np.stack([fa[single], fa[single + 1]])), (hb, at_b[single], np.stack([fb[single], fb[single + 1]])),
                    values[first_value[single] + 2], min_words, similarity,
                )
            cols = {c: batch.column(c).to_pylist() for c in ("x", "y", "from_a")}
            out, keep = [], []
            for i in np.flatnonzero(~none).tolist():
                a, b = ha[fa[i] : fa[i + 1]], hb[fb[i] : fb[i + 1]]
                x0, y0 = int(at_a[i] - fa[i]), int(at_b[i] - fb[i])
                runs = values[first_value[i] : first_value[i] + size[i]].reshape(-1, 3) + [x0, y0, 0]
                # what was fetched may end within the last seed where its words are very long
                runs[:, 2] = np.minimum(runs[:, 2], np.minimum(len(a) - runs[:, 0], len(b) - runs[:, 1]))
                runs = runs[runs[:, 2] > 0]
                if not len(runs):
                    continue
                hits, at = 0, None
                for x, y, n in runs.tolist():
                    if at:
                        hits += _common(a[at[0] : x], b[at[1] : y])
                    hits += int((a[x : x + n] == b[y : y + n]).sum())
                    at = x + n, y + n
                left, more = _extend(a[:x0][::-1], b[:y0][::-1])
                right, most = _extend(a[at[0] :], b[at[1] :])
                hits += more + most
                words, partner = at[0] - x0 + left + right, at[1] - y0 + left + right
                alike = hits / max(words, partner)
                if words < min_words:  # the extension ends with its best; a passage may need more words of either side
                    left, right = min(x0, y0, min_words), min(len(a) - at[0], len(b) - at[1], min_words)
                    if at[0] - x0 + left + right < min_words:
                        continue
                    ends = [(x0 - left, y0 - left, left), *runs.tolist(), (*at, right)]
                    parts = _parts(a, b, ends, min_words, similarity)
                elif alike >= similarity:
                    parts = [(x0 - left, at[0] + right, y0 - left, at[1] + right, hits)]
                elif hits >= similarity * min_words:
                    ends = [(x0 - left, y0 - left, left)] if left else []
                    ends += [*runs.tolist(), (*at, right)] if right else runs.tolist()
                    parts = _parts(a, b, ends, min_words, similarity)
                else:
                    parts = []
                shift = cols["from_a"][i] - int(oa[i])
                for x, xe, y, ye, same in parts:
                    keep.append(i)
                    out.append((
                        cols["x"][i] + x - x0, xe - x, int(sa[fa[i] + x]) + shift, int(ea[fa[i] + xe - 1]) + shift,
                        cols["y"][i] + y - y0, ye - y, same / max(xe - x, ye - y),
                    ))
            keep = pa.array(keep, pa.int64())
            new = list(zip(*out, strict=True)) if out else [[] for _ in range(7)]
            yield pa.record_batch(
                [batch.column(c).take(keep) for c in ("id", "o", "id0", "o0")]
                + [pa.array(v, pa.float64() if k == 6 else pa.int32()) for k, v in enumerate(new)],
                [f.name for f in _FOUND],
            )

    return run


_LAST = (1 << 63) - 1  # stands for a null id


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("o"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more,
    )


def _covered(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the words from ``first`` to ``end`` lie within the spans, taken together where they touch."""
    if not len(starts):
        return np.zeros(len(first), bool)
    by = np.argsort(starts, kind="stable")
    starts, reach = starts[by], np.maximum.accumulate(ends[by])
    opens = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    reach = reach[np.r_[opens[1:], len(starts)] - 1]
    at = np.searchsorted(starts[opens], first, "right") - 1
    return (at >= 0) & (end <= reach[np.maximum(at, 0)])


def _rows_of(pos: np.ndarray, k: int, window: int, min_words: int) -> np.ndarray:
    """Which of the ascending places stand in a row of seeds that ``min_words`` equal words may have."""
    if not len(pos):
        return np.zeros(0, bool)
    new = np.r_[True, np.diff(pos) > window]
    head = np.flatnonzero(new)
    tail = np.r_[head[1:], len(pos)] - 1
    return (pos[tail] - pos[head] + k + 2 * (window - 1) >= min_words)[np.cumsum(new) - 1]


def _lists(col: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The row of each struct of a list column, and the structs' fields; a null list is empty."""
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    fields = col.flatten()
    names = [f.name for f in fields.type]
    return np.repeat(np.arange(len(col)), size), {c: fields.field(i).to_numpy(zero_copy_only=False) for i, c in enumerate(names)}


def _wanted(k: int, window: int, min_words: int):
    """Seeds within ``min_words`` of a linked one that, with the words that it stands for, isn't covered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, seeds = _lists(batch.column("seeds"))
            span_row, spans = _lists(batch.column("spans"))
            if not len(row):
                continue
            # all documents on one line, further apart than anything reaches
            pos = seeds["pos"].astype(np.int64)
            step = int(max(pos.max(), spans["end"].max(initial=0))) + 2 * min_words + 2 * window + k
            by = np.lexsort((pos, row))
            base, pos, seed, linked = row[by] * step, pos[by], seeds["seed"][by], seeds["linked"][by].astype(bool)
            at = base + pos
            need = linked & _rows_of(at, k, window, min_words)
            shift = span_row * step
            need &= ~_covered(spans["first"] + shift, spans["end"] + shift, base + np.maximum(pos - window + 1, 0), at + k + window - 1)
            left = at[need]
            near = np.searchsorted(left, at - min_words) < np.searchsorted(left, at + min_words, "right")
            yield pa.record_batch([pa.array(np.unique(seed[near].astype(np.int64)))], ["seed"])

    return run


def _windows(k: int, window: int, min_words: int):
    """Windows of ``min_words`` words around rows of seeds, one of each in a block and those that aren't covered.

    Those of later documents carry the block's first one, as seeds do. ``last`` is the byte of the last ``k`` words.
    """
    ahead = min_words - k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t"):
            raw, off = flat(batch.column("t"))
            start, end, first = word_spans(raw, off)
            grams = Rolling(word_hashes(LOWER[raw], start, end)).grams(min_words)
            chosen, free = [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for i, (pos, spans) in enumerate(zip(batch.column("places").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
                pos = np.unique(np.array(pos, np.int64))
                pos = pos[_rows_of(pos, k, window, min_words)]
                size = int(first[i + 1] - first[i]) - min_words + 1
                if size <= 0 or not len(pos):
                    continue
                edge = np.zeros(size + 1, np.int64)
                np.add.at(edge, np.clip(pos - min_words + k, 0, size), 1)  # the windows that hold a seed
                np.add.at(edge, np.clip(pos + 1, 0, size), -1)
                at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                chosen.append(at + first[i])
                held = np.array([(x["first"], x["end"]) for x in spans or ()], np.int64).reshape(-1, 2)
                free.append(~_covered(held[:, 0], held[:, 1], at, at + min_words))
            at, free = np.concatenate(chosen), np.concatenate(free)
            row = np.searchsorted(first, at, "right") - 1
            o, doc = batch.column("o").to_numpy()[row], batch.column("id").to_numpy()[row]
            pos, key = at - first[row], grams[at]
            by = np.lexsort((pos, o, doc, key))
            key, o, doc, pos, at, row, free = (v[by] for v in (key, o, doc, pos, at, row, free))
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            own = (o[lead] == o) & (doc[lead] == doc)
            again = np.zeros(len(key), bool)  # a window of periodic text follows itself closely: some cover all
            again[1:] = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1]) & (o[1:] == o[:-1]) & (np.diff(pos) < min_words)
            turn = np.r_[again[1:], False] & again & (pos // min_words == np.r_[0, pos[:-1]] // min_words)
            keep = np.flatnonzero(new | (free & ~turn))
            byte, last = start[at] - off[row], start[at + ahead] - off[row]
            cols = [
                pa.array(key[keep].view(np.int64)), pa.array(o[keep]), pa.array(doc[keep]),
                *(pa.array(v[keep].astype(np.int32)) for v in (pos, byte, last)),
            ]
            for v, kind in ((o, pa.int64()), (doc, pa.int64()), (pos, pa.int32()), (byte, pa.int32()), (last, pa.int32())):
                cols.append(pa.array(v[lead[keep]].astype(kind.to_pandas_dtype()), kind, mask=own[keep]))
            names = ["seed", "o", "id", "pos", "byte", "last", "o0", "id0", "pos0", "byte0", "last0", "open"]
            out = pa.record_batch([*cols, pa.array(free[keep])], names)
            yield out.take(pa.array(np.lexsort((pos[keep], doc[keep], o[keep]))))

    return run


def _aligned(anchors: DataFrame, texts: DataFrame, min_words: int, similarity: float) -> tuple[DataFrame, str]:
    """The passages of anchors, steps 3 and 4, and the folder of the chains that they are read from."""
    pair = ["id", "o", "id0", "o0"]
    chains = anchors.repartition(*pair).sortWithinPartitions(*pair, "pos", "pos0").mapInArrow(_chains(K), _CHAIN)
    chains, folder = scratch(chains, "chains", "zstd")
    chains = chains.withColumn("from_a", F.greatest(F.col("xb") - MARGIN, F.lit(0))).withColumn(
        "from_b", F.greatest(F.col("yb") - MARGIN, F.lit(0))
    )
    # the passages are cut out as the join's rows are made, so a partner of many chains never travels whole
    # and go on behind the last seed; further where its words, told by the spaces, are long
    behind = f"CAST(substring(t, {{0}} + 1, {2 * MARGIN}) AS STRING)"
    more = f"IF(length({behind}) - length(replace({behind}, ' ')) < {K}, {LONG_MARGIN}, {2 * MARGIN})"
    both = (
        chains.join(texts, ["id", "o"])
        .withColumn("a", F.expr(f"substring(t, from_a + 1, xe - from_a + {more.format('xe')})")).drop("t")
        .join(texts.select(F.col("id").alias("id0"), F.col("o").alias("o0"), "t"), ["id0", "o0"])
        .withColumn("b", F.expr(f"substring(t, from_b + 1, ye - from_b + {more.format('ye')})")).drop("t")
    )
    return both.select("id", "o", "id0", "o0", "x", "y", "xb", "yb", "from_a", "from_b", "runs", "a", "b").mapInArrow(
        _align(min_words, similarity), _FOUND
    ).distinct(), folder


def _passages(docs: DataFrame, min_words: int, similarity: float) -> DataFrame:
    keyed = _keyed(docs)
    texts = keyed.select("id", "o", F.col("text").cast("binary").alias("t"))
    spark = docs.sparkSession
    seeds, seeds_at = scratch(keyed.mapInArrow(_seeds(K, WINDOW), _SEED), "seeds", "zstd")
    every = Window.partitionBy("seed").orderBy("id", "o", "pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    anchor = ["seed", "id", "o", "pos", "byte", "id0", "o0", "pos0", "byte0"]
    later = F.expr("id <> f.id or o <> f.o")
    leads = (
        seeds.where("o0 is null")
        .withColumn("f", F.first(F.struct("id", "o", "pos", "byte")).over(every))
        .withColumn("z", F.last(F.struct("id", "o")).over(every))
        .withColumn("more", F.max("more").over(every))
        .where("more or z.id <> f.id or z.o <> f.o")
        .select(*anchor[:5], *[F.when(later, F.col(f"f.{c}")).alias(c + "0") for c in ("id", "o", "pos", "byte")])
    )
    # every seed that two documents hold
    links, links_at = scratch(leads.unionAll(seeds.where("o0 is not null").select(*anchor)), "links", "zstd")
    discard(spark, seeds_at)  # each step's tables and shuffle files go before the next one's come
    release(spark)
    found, chains_at = _aligned(links.where("o0 is not null").drop("seed"), texts, min_words, similarity)
    found = written(found, "passages")
    discard(spark, chains_at)
    release(spark)

    spans = found.groupBy("id", "o").agg(F.collect_list(F.expr("struct(first_word as first, first_word + n_words as end)")).alias("spans"))
    held = links.groupBy("id", "o").agg(F.collect_list(F.expr("struct(pos, seed, o0 is not null as linked)")).alias("seeds"))
    wanted = held.join(spans, ["id", "o"], "left").select("seeds", "spans").mapInArrow(_wanted(K, WINDOW, min_words), "seed long").distinct()
    places = written(links.join(wanted, "seed", "left_semi").groupBy("id", "o").agg(F.collect_list("pos").alias("places")), "places", "zstd")
    discard(spark, links_at)
    release(spark)
    windows = places.join(spans, ["id", "o"], "left").join(texts, ["id", "o"]).select("id", "o", "places", "spans", "t")
    windows = written(windows.mapInArrow(_windows(K, WINDOW, min_words), _WINDOW), "windows", "zstd")
    release(spark)
    order = Window.partitionBy("seed").orderBy("id", "o", "pos")
    more = ["id", "o", "pos", "byte", "last", "id0", "o0", "pos0", "byte0", "last0"]
    runs = (
        windows.where("o0 is null").withColumn("f", F.first(F.struct(*more[:5])).over(order))
        .where("open").where(later).select(*more[:5], *[F.col(f"f.{c}").alias(c + "0") for c in more[:5]])
        .unionAll(windows.where("o0 is not null").select(*more))
    )
    ahead = min_words - K  # a window is a run from its first seed to its last
    ends = runs.select("id", "o", "id0", "o0", F.expr(
        f"inline(array(struct(pos, byte, pos0, byte0), struct(pos + {ahead} as pos, last as byte, pos0 + {ahead} as pos0, last0 as byte0)))"
    ))
    both = found.unionAll(_aligned(ends, texts, min_words, similarity)[0])
    # a passage of the first round may be the part of one of the second that its seeds reached
    line = Window.partitionBy("id", "o", "id0", "o0", F.expr("first_word - partner_word")).orderBy("first_word", F.desc("n_words"), "partner_words", "similarity")
    reach = F.max(F.expr("first_word + n_words")).over(line.rowsBetween(Window.unboundedPreceding, -1))
    return both.withColumn("reach", reach).where("reach is null or first_word + n_words > reach").drop("reach")


def fuzzy_passages(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each passage of a document that an earlier document holds too.

    (doc_id, first_word, n_words, first_byte, end_byte, partner_id, partner_word,
    partner_words, similarity): words count from 0, bytes are of the UTF-8 text,
    similarity is the share of aligned words that agree.
    """
    real = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return _passages(docs, min_words, similarity).select(
        real("id").alias("doc_id"), "first_word", "n_words", "first_byte", "end_byte",
        real("id0").alias("partner_id"), "partner_word", "partner_words", "similarity",
    )


def _cut(text: bytes, spans: list) -> str:
    """The text without the byte spans and the white space behind each."""
    kept, at = [], 0
    for first, end in sorted((s["first_byte"], s["end_byte"]) for s in spans):
        if first > at:
            kept.append(text[at:first])
        while end < len(text) and text[end] in b" \t\n\v\f\r":
            end += 1
        at = max(at, end)
    return b"".join([*kept, text[at:]]).decode("utf-8", "replace")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, with all their columns, each passage cut from all but the first that holds it.

    ``n_chars``, if there, is brought up to date. No document goes; one may become empty.
    """
    spans = _passages(docs, min_words, similarity).groupBy("id", "o").agg(F.collect_list(F.struct("first_byte", "end_byte")).alias("spans"))
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("o")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            text = [_cut(t.encode(), s) if s else t for t, s in zip(text, spans, strict=True)]
            yield pa.record_batch([pa.array(text, pa.string()), batch.column("row")], ["text", "row"])

    found = rows.join(spans, ["id", "o"], "left").select(F.col("row.text").alias("text"), "row", "spans")
    slim = [c for c in names if c != "text"]
    out = found.select("text", F.struct(*[F.col("row").getField(c).alias(c) for c in slim]).alias("row"), "spans")
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("row", out.schema["row"].dataType)])
    cut = out.mapInArrow(run, schema)
    value = {c: F.col("row").getField(c) for c in slim} | {"text": F.col("text")}
    if "n_chars" in slim:
        value["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[value[c].alias(c) for c in names])
