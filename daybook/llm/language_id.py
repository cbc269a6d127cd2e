"""Language identification with a linear-chain conditional random field over words.

Words are runs of letters, lower-cased. A word's features are its affixes (first
and last one to three letters), its letter pairs and triples with word edges,
and its entry in a lexicon of frequent training words; their weights are learned
together with the transitions between languages, by maximising the conditional
likelihood of code-switched sequences that are dealt from documents of all
languages. Forward-backward then gives every word's probability of each label,
so a text that switches language is labelled word by word. A document's language
is the label with the largest mean probability over its words, and its score is
that mean; a text without letters, empty or null, is ``und`` with score 0.

Texts are read whole. A block's word sequences are cut into chunks; all chunks
advance together, and products of their transfer matrices carry the forward and
backward messages across, so long texts need no long loop and the result is
that of one pass over the text.

An empty table gives no rows, and a model fitted on one labels every text ``und``. Other
columns of the input than doc_id, text and (for fitting) lang are not read, whatever they
are called. Equal rows are predicted alike, each on its own; ties of labels go to the
first in the order of code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import Rolling, blocks, mix

#: Bounds of the training sample: languages (those with most labelled rows), documents of each language, words of
#: each document, in runs of ``RUN`` words that are spread over the whole text, and letters of a word.
SAMPLE_LANGUAGES, SAMPLE_DOCS, SAMPLE_WORDS, RUN, SAMPLE_LETTERS = 256, 120, 400, 25, 100
FEATURES, LEXICON = 1 << 15, 20_000
CHUNK = 64
KEPT_WORDS = 200_000
UNKNOWN = "und"
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def word_features(words: list[str], lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, word of each): hashed features below FEATURES, lexicon entries above."""
    text = "".join(f"^{w}$" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(w) + 2 for w in words], np.int64)
    end = np.cumsum(size)
    start = end - size
    word = np.repeat(np.arange(len(words)), size)
    roll = Rolling(codes)
    numbers, owner = [], []

    def add(h: np.ndarray, of: np.ndarray, kind: int) -> None:
        numbers.append((mix(h + np.uint64(kind)) % np.uint64(FEATURES)).astype(np.int64))
        owner.append(of)

    for k in (2, 3):
        place = np.arange(len(codes))
        inside = place + k <= end[word]
        place = place[inside]
        add(roll.of(place, place + k), word[inside], 10 + k)
    for k in (1, 2, 3):
        long = np.flatnonzero(size - 2 >= k)
        add(roll.of(start[long] + 1, start[long] + 1 + k), long, 20 + k)
        add(roll.of(end[long] - 1 - k, end[long] - 1), long, 30 + k)
    keys = roll.of(start, end)
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, keys), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[at] == keys)
        numbers.append(FEATURES + at[known])
        owner.append(known)
    numbers, owner = np.concatenate(numbers), np.concatenate(owner)
    by = np.argsort(owner, kind="stable")
    return numbers[by], owner[by]


def word_keys(words: list[str]) -> np.ndarray:
    text = "".join(f"^{w}$" for w in words)
    end = np.cumsum([len(w) + 2 for w in words]) if words else np.zeros(0, np.int64)
    return Rolling(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)).of(np.r_[0, end[:-1]].astype(np.int64)[: len(end)], end)


@dataclass
class Tagger:
    """A trained field: labels, feature weights [number, label], transitions [from, to], lexicon keys."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log potentials [word, label]."""
        out = np.zeros((len(words), len(self.labels)))
        numbers, owner = word_features(words, self.lexicon)
        first = np.searchsorted(owner, np.arange(len(words)))
        if len(numbers):
            out[:] = np.add.reduceat(self.weights[numbers], first, axis=0)
        return out

    def marginals(self, emissions: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Forward-backward: label probabilities of each word, for sequences of ``size`` words one after another."""
        n_labels = len(self.labels)
        step = np.exp(self.transitions - self.transitions.max())
        local = np.exp(emissions - emissions.max(1, keepdims=True))
        chunks = -(-size // CHUNK)  # of each sequence
        owner = np.repeat(np.arange(len(size)), chunks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        start = (np.cumsum(size) - size)[owner] + nth * CHUNK
        length = np.minimum(size[owner] - nth * CHUNK, CHUNK)
        by = np.argsort(-length, kind="stable")  # the chunks that are still running are always the first ones
        start, length, owner, nth = start[by], length[by], owner[by], nth[by]
        running = np.searchsorted(-length, -np.arange(CHUNK), "left")  # chunks longer than t

        def norm(x: np.ndarray) -> np.ndarray:
            return x / x.sum(-1, keepdims=True)

        # product of the transfer matrices of each chunk
        carry = np.broadcast_to(np.eye(n_labels), (len(start), n_labels, n_labels)).copy()
        for t in range(int(length.max(initial=0))):
            k = running[t]
            m = (carry[:k] @ step) * local[start[:k] + t][:, None]
            carry[:k] = m / m.sum((1, 2), keepdims=True)
        # messages into every chunk from the left and from the right
        left, right = np.full((len(start), n_labels), 1 / n_labels), np.full((len(start), n_labels), 1 / n_labels)
        ordered = np.lexsort((nth, owner))
        head = np.cumsum(chunks) - chunks
        most = int(chunks.max(initial=0))
        for t in range(1, most):
            of = np.flatnonzero(chunks > t)
            here, before = ordered[head[of] + t], ordered[head[of] + t - 1]
            left[here] = norm(np.einsum("ka,kab->kb", left[before], carry[before]))
        for t in range(most - 2, -1, -1):
            of = np.flatnonzero(chunks > t + 1)
            here, after = ordered[head[of] + t], ordered[head[of] + t + 1]
            right[here] = norm(np.einsum("kab,kb->ka", carry[after], right[after]))
        forward = np.empty_like(local)
        for t in range(int(length.max(initial=0))):
            k = running[t]
            left[:k] = norm((left[:k] @ step) * local[start[:k] + t])
            forward[start[:k] + t] = left[:k]
        for t in range(int(length.max(initial=0)) - 1, -1, -1):
            k = running[t]
            at = start[:k] + t
            forward[at] *= right[:k]
            right[:k] = norm((local[at] * right[:k]) @ step.T)
        return norm(forward)


def spread(words: list[str]) -> list[str]:
    """At most ``SAMPLE_WORDS`` of a text's words: all, or runs at even distances from its first word to its last."""
    if len(words) <= SAMPLE_WORDS:
        return words
    starts = np.linspace(0, len(words) - RUN, SAMPLE_WORDS // RUN).astype(np.int64)
    return [w for a in starts.tolist() for w in words[a : a + RUN]]


def fit(texts: list[str], languages: list[str], rounds: int = 6, seed: int = 7) -> Tagger:
    """Trains the field on documents of one language each, dealt into sequences that switch language."""
    labels = sorted(set(languages))
    rng = np.random.default_rng(seed)
    spans = []
    for text, language in zip(texts, languages, strict=True):
        words = spread(WORDS.findall(text.lower()))
        at = 0
        while at < len(words):
            size = int(rng.integers(3, 25))
            spans.append((words[at : at + size], labels.index(language)))
            at += size
    rng.shuffle(spans)
    words = [w for ws, _ in spans for w in ws]
    gold = np.array([y for ws, y in spans for _ in ws], np.int64)
    vocabulary, token, count = np.unique(np.array(words, object).astype(str), return_inverse=True, return_counts=True) if words else ([], np.zeros(0, int), np.zeros(0))
    vocabulary = list(map(str, vocabulary))
    frequent = np.argsort(-count, kind="stable")[:LEXICON]
    lexicon = np.sort(word_keys([vocabulary[i] for i in frequent if count[i] > 1]))
    n = len(labels)
    model = Tagger(labels, np.zeros((FEATURES + len(lexicon), n)), np.zeros((n, n)), lexicon)
    numbers, owner = word_features(vocabulary, lexicon) if vocabulary else (np.zeros(0, int), np.zeros(0, int))
    first = np.searchsorted(owner, np.arange(len(vocabulary) + 1))
    span = 32  # words of a training sequence
    full = len(token) // span * span
    token, gold = (token[:full], gold[:full]) if full else (token, gold)
    token, gold = token.reshape(-1, span if full else max(len(token), 1)), gold.reshape(-1, span if full else max(len(gold), 1))
    moment = [np.zeros_like(model.weights), np.zeros_like(model.weights), np.zeros((n, n)), np.zeros((n, n))]
    turn = 0
    for _ in range(rounds):
        for at in np.array_split(rng.permutation(len(token)), max(1, len(token) // 128)):
            x, y = token[at], gold[at]
            used, inverse = np.unique(x, return_inverse=True)
            size = first[used + 1] - first[used]
            upto = np.cumsum(size)
            feature = numbers[np.repeat(first[used] - (upto - size), size) + np.arange(upto[-1])]
            of = np.repeat(np.arange(len(used)), size)
            e = np.add.reduceat(model.weights[feature], upto - size, axis=0)[inverse].reshape(*x.shape, n)
            # forward-backward with the pairwise expectations that the transitions' gradient needs
            step = np.exp(model.transitions)
            start = step.sum(0)  # a uniform label before the first word, as in marginals
            local = np.exp(e - e.max(2, keepdims=True))
            alpha, beta = np.empty_like(local), np.ones_like(local)
            for t in range(x.shape[1]):
                a = local[:, t] * ((alpha[:, t - 1] @ step) if t else start)
                alpha[:, t] = a / a.sum(1, keepdims=True)
            for t in range(x.shape[1] - 2, -1, -1):
                b = (local[:, t + 1] * beta[:, t + 1]) @ step.T
                beta[:, t] = b / b.sum(1, keepdims=True)
            single = alpha * beta
            single /= single.sum(2, keepdims=True)
            pair = alpha[:, :-1, :, None] * step * (local * beta)[:, 1:, None, :]
            pair /= pair.sum((2, 3), keepdims=True)
            error = np.eye(n)[y] - single
            word_error = np.zeros((len(used), n))
            np.add.at(word_error, inverse.reshape(x.shape), error)
            grad_w = np.stack([np.bincount(feature, word_error[of, k], len(model.weights)) for k in range(n)], 1)
            grad_t = np.bincount((y[:, :-1] * n + y[:, 1:]).ravel(), minlength=n * n).reshape(n, n) - pair.sum((0, 1))
            grad_t += error[:, 0].sum(0) * step / start
            turn += 1
            for value, grad, k in ((model.weights, grad_w / len(at), 0), (model.transitions, grad_t / len(at), 2)):
                grad = grad - 1e-4 * value
                moment[k] = 0.9 * moment[k] + 0.1 * grad
                moment[k + 1] = 0.99 * moment[k + 1] + 0.01 * grad**2
                value += 0.05 * (moment[k] / (1 - 0.9**turn)) / (np.sqrt(moment[k + 1] / (1 - 0.99**turn)) + 1e-8)
    model.weights = model.weights.astype(np.float32)
    return model


def fit_sample(labelled: DataFrame, docs_per_language: int = SAMPLE_DOCS) -> Tagger | None:
    """Trains on at most ``docs_per_language`` rows (text, lang) of each language, those with the least hashes.

    The ``SAMPLE_LANGUAGES`` languages with most rows are learned, ties by name. Only the
    words that training reads leave the executors, and equal rows are one example, so what
    the driver gets is bounded, however many languages, rows or letters there are. Rows
    without text or language are no examples; without any example there is no model.
    """
    rows = labelled.where("text is not null and lang is not null and text <> ''").select(
        F.xxhash64("doc_id", "lang").alias("h"), F.xxhash64("text").alias("t"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    learned = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE_LANGUAGES).select("lang")
    order = Window.partitionBy("lang").orderBy("h", "t")
    picked = (  # row numbers up to a bound are cut in every task before the shuffle, so a hot language sends no more
        rows.select("h", "t", "lang").withColumn("r", F.row_number().over(order)).where(F.col("r") <= docs_per_language)
        .join(F.broadcast(learned), "lang", "left_semi").select("h", "t").distinct()
    )

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [
                " ".join(spread([w for w in WORDS.findall(t.lower()) if len(w) <= SAMPLE_LETTERS])) for t in batch.column("text").to_pylist()
            ]
            yield pa.record_batch([batch.column("h"), batch.column("lang"), pa.array(words, pa.string())], ["h", "lang", "text"])

    some = rows.join(F.broadcast(picked), ["h", "t"], "left_semi").select("h", "lang", "text").mapInArrow(
        words_of, "h long, lang string, text string"
    ).distinct().toPandas()
    some = some.sort_values(["h", "lang", "text"])
    return fit(some["text"].tolist(), some["lang"].tolist()) if len(some) else None


def predict(docs: DataFrame, model: Tagger | None, spans: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, n_words) of every text, and with ``spans`` its runs of equally labelled words.

    A run is (first character, end character, lang). Rows keep null and repeated ids.
    """
    out = "doc_id long, lang_pred string, score double, n_words long"
    if spans:
        out += ", spans array<struct<first: int, end: int, lang: string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        table = np.zeros((0, len(model.labels) if model else 0))
        for batch in blocks(batches):
            texts = [(t or "").lower() for t in batch.column("text").to_pylist()]
            words = [WORDS.findall(t) for t in texts] if model else [[] for _ in texts]
            size = np.array([len(w) for w in words], np.int64)
            flat = [w for ws in words for w in ws]
            if len(known) > KEPT_WORDS:
                known.clear()
                table = table[:0]
            new = list(set(flat).difference(known))
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                table = np.concatenate([table, model.emissions(new)])
            best, score = np.full(len(texts), -1), np.zeros(len(texts))
            if flat:
                p = model.marginals(table[np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))], size)
                some = np.flatnonzero(size)
                mean = np.add.reduceat(p, (np.cumsum(size) - size)[some], axis=0) / size[some, None]
                best[some], score[some] = mean.argmax(1), np.minimum(mean.max(1), 1.0)
            columns = [
                batch.column("doc_id"), pa.array([model.labels[k] if k >= 0 else UNKNOWN for k in best], pa.string()),
                pa.array(score), pa.array(size),
            ]
            if spans:
                at = 0
                runs = []
                for text, n in zip(batch.column("text").to_pylist(), size, strict=True):
                    label = p[at : at + n].argmax(1) if n else []
                    places = [m.span() for m in WORDS.finditer(text)] if n else []  # lower case may be longer, but has the same words
                    edge = [i for i in range(n) if not i or label[i] != label[i - 1]] + [n]
                    runs.append([
                        {"first": places[a][0], "end": places[b - 1][1], "lang": model.labels[label[a]]}
                        for a, b in zip(edge[:-1], edge[1:], strict=True)
                    ])
                    at += n
                columns.append(pa.array(runs, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))))
            yield pa.record_batch(columns, ["doc_id", "lang_pred", "score", "n_words", "spans"][: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, out)
