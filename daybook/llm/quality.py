"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded
by a learned layer over its features (letter and word statistics, repetition and
hashed letter pairs); gated attention, learned from document labels alone,
weighs the passages; the weighted sum of their encodings is scored by a logistic
output. All weights are learned together by gradient steps on the likelihood of
the labels.

All passages of a text are read. An empty or null text is one passage without
words and gets a score too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import LOWER, Rolling, blocks, flat, word_spans

PASSAGE = 64
#: Bounds of the training sample: labelled documents, bytes of one text, and bytes of all.
SAMPLE_DOCS, SAMPLE_TEXT, SAMPLE_BYTES = 4000, 1 << 24, 1 << 27
THRESHOLD = 0.3
_PAIRS = 64  # buckets of letter pairs
_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\n"
# class of every byte: lower, upper, digit, space, other ASCII, lead and following bytes of longer letters, each sign
_CLASS = np.full(256, 4)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32] = 0, 1, 2, 3
_CLASS[192:], _CLASS[128:192] = 5, 6
_CLASS[list(_SIGNS)] = 7 + np.arange(len(_SIGNS))
_CLASSES = 7 + len(_SIGNS)
WIDTH = _CLASSES + _PAIRS + 7


def passages(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features [passage, feature], passages of each row) of a block of texts."""
    start, end, first = word_spans(raw, off)
    words = np.diff(first)
    count = np.maximum(-(-words // PASSAGE), 1)
    base = np.cumsum(count) - count
    row = np.repeat(np.arange(len(words)), words)
    nth = np.arange(len(start)) - first[:-1][row]
    of = base[row] + nth // PASSAGE  # passage of each word
    total = int(count.sum())
    out = np.zeros((total, WIDTH))
    # a byte belongs to the passage of the word at or before it, or to its row's first passage
    letter_row = np.repeat(np.arange(len(words)), np.diff(off))
    word = np.cumsum(np.bincount(start, minlength=len(raw))) - 1 if len(raw) else np.zeros(0, np.int64)
    of_letter = base[letter_row].copy()
    mine = word >= first[:-1][letter_row]
    of_letter[mine] = of[word[mine]]
    letters = np.maximum(np.bincount(of_letter, minlength=total), 1)
    out[:, :_CLASSES] = np.bincount(of_letter * _CLASSES + _CLASS[raw], minlength=total * _CLASSES).reshape(total, -1) / letters[:, None]
    pair = (LOWER[raw[:-1]].astype(np.int64) * 131 + LOWER[raw[1:]]) * 2654435761 % (1 << 32) >> 26
    pairs = np.bincount(of_letter[:-1] * _PAIRS + pair, minlength=total * _PAIRS).reshape(total, -1)
    out[:, _CLASSES : _CLASSES + _PAIRS] = 8 * pairs / letters[:, None]
    n = np.bincount(of, minlength=total)
    have = np.maximum(n, 1)
    h = Rolling(LOWER[raw]).of(start, end) if len(start) else np.zeros(0, np.uint64)
    size = end - start
    by = np.lexsort((h, of))
    again = (h[by][1:] == h[by][:-1]) & (of[by][1:] == of[by][:-1])
    next_same = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    last = raw[end - 1] if len(end) else np.zeros(0, np.uint8)
    signs = np.isin(last, np.frombuffer(_SIGNS, np.uint8))
    mean = np.bincount(of, size, total) / have
    rest = [
        np.log1p(n) / 4, mean / 8, np.sqrt(np.maximum(np.bincount(of, size.astype(float) ** 2, total) / have - mean**2, 0)) / 8,
        np.bincount(of[by][1:], again, total) / have, np.bincount(of[1:], next_same, total) / have,
        np.bincount(of, signs, total) / have, (n == 0).astype(float),
    ]
    out[:, _CLASSES + _PAIRS :] = np.stack(rest, 1)
    return out, count


@dataclass
class Attention:
    """Weights: encoder (w, b), attention (v, u, a), output (c, d), and the features' mean and spread."""

    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    NAMES = ("w", "b", "v", "u", "a", "c", "d")

    def forward(self, x: np.ndarray, count: np.ndarray):
        x = (x - self.mean) / self.spread
        h = np.tanh(x @ self.w + self.b)
        t, g = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        e = (t * g) @ self.a
        first = np.cumsum(count) - count
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), count))
        weight = e / np.repeat(np.add.reduceat(e, first), count)
        z = np.add.reduceat(weight[:, None] * h, first, axis=0)
        return x, h, t, g, weight, z, 1 / (1 + np.exp(-(z @ self.c + self.d)))

    def step(self, x: np.ndarray, count: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss."""
        x, h, t, g, weight, z, p = self.forward(x, count)
        row = np.repeat(np.arange(len(count)), count)
        out = (p - y) / len(y)
        dz = out[:, None] * self.c
        pull = (h * dz[row]).sum(1)
        de = weight * (pull - np.bincount(row, weight * pull, len(count))[row])
        dt, dg = de[:, None] * self.a * g * (1 - t**2), de[:, None] * self.a * t * g * (1 - g)
        dh = (weight[:, None] * dz[row] + dt @ self.v.T + dg @ self.u.T) * (1 - h**2)
        return {
            "w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g * de[:, None]).sum(0),
            "c": z.T @ out, "d": out.sum(),
        }


def fit(texts: list[str], labels: list[int], rounds: int = 40, hidden: int = 24, seed: int = 11) -> Attention:
    rng = np.random.default_rng(seed)
    parts = [passages(*flat(b.column(0))) for b in blocks([pa.record_batch([pa.array(texts, pa.string())], ["text"])])]
    x, count = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    y = np.array(labels, float)
    first = np.cumsum(count) - count
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    prior = np.clip(y.mean(), 0.01, 0.99)
    model = Attention(
        draw(WIDTH, hidden), np.zeros(hidden), draw(hidden, hidden), draw(hidden, hidden), draw(hidden), draw(hidden) * 0.1,
        np.array(np.log(prior / (1 - prior))), x.mean(0), x.std(0) + 1e-2,
    )
    first_moment, second = ({k: np.zeros_like(getattr(model, k)) for k in Attention.NAMES} for _ in range(2))
    turn = 0
    for _ in range(rounds):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            n = count[part]
            upto = np.cumsum(n)
            rows = np.repeat(first[part] - (upto - n), n) + np.arange(upto[-1])
            turn += 1
            for k, grad in model.step(x[rows], n, y[part]).items():
                value = getattr(model, k)
                grad = grad + 1e-4 * value
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                setattr(model, k, value - 0.005 * (first_moment[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8))
    return model


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights that the sample's rows give: (name, shape, values)."""
    some = pa.Table.from_batches([b for b in batches if b.num_rows] or [pa.record_batch([[], [], []], ["doc_id", "text", "y"])])
    if not some.num_rows:
        return
    some = some.sort_by("doc_id")
    model = fit(some["text"].to_pylist(), some["y"].to_pylist())
    weights = [(f.name, np.asarray(getattr(model, f.name), float)) for f in fields(Attention)]
    yield pa.record_batch([
        pa.array([n for n, _ in weights]), pa.array([list(v.shape) for _, v in weights], pa.list_(pa.int32())),
        pa.array([v.ravel() for _, v in weights], pa.list_(pa.float64())),
    ], ["name", "shape", "numbers"])


def fit_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> Attention | None:
    """Trains on at most ``sample`` labelled documents, those with the least hashes of their id.

    Longer texts than ``SAMPLE_TEXT`` are passed over, and the sample ends where its
    texts would exceed ``SAMPLE_BYTES``, so what the task that trains gets is bounded; the
    driver gets the weights alone. Of documents with the same id one is an example. Null
    labels and null ids are no examples; without any example there is no model.
    """
    order = F.xxhash64("doc_id")
    picked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.min("y").alias("y"))
        .orderBy(order, "doc_id").limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    upto = Window.orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # over the sample's rows alone
    some = (
        texts.where(F.octet_length("text") <= SAMPLE_TEXT).join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "y")).alias("one")).select("doc_id", "one.text", "one.y")
        .withColumn("bytes", F.sum(F.octet_length("text")).over(upto)).where(F.col("bytes") <= SAMPLE_BYTES)
    )
    # the window has brought the sample to one task already
    weights = some.select("doc_id", "text", "y").coalesce(1).mapInArrow(_fitted, "name string, shape array<int>, numbers array<double>").collect()
    return Attention(**{r["name"]: np.array(r["numbers"], float).reshape(r["shape"]) for r in weights}) if weights else None


def score_block(model: Attention | None, texts: pa.Array) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    x, count = passages(*flat(texts))
    return model.forward(x, count)[-1]


def score(docs: DataFrame, model: Attention | None) -> DataFrame:
    """(doc_id, score, predicted) of every text; without a model every score is 0.5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, size=1 << 20):
            p = score_block(model, batch.column("text"))
            yield pa.record_batch([batch.column("doc_id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, model: Attention | None) -> DataFrame:
    """The documents, with all their columns, that the classifier doesn't reject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, size=1 << 20):
            yield batch.filter(pa.array(score_block(model, batch.column("text")) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
