"""Words whose polynomial hashes agree, long words without a cut, and passages looked at together."""

import random

import numpy as np
import pytest

from daybook.llm import common, jaccard_join, passages, pieces


def turns(n):
    """abba baab ...: n letters; its polynomial hash modulo 2**64 is that of its complement from 1,024 letters on."""
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def other(word):
    return word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_of_equal_polynomial_hash_are_told_apart(spark, n):
    one, two = turns(n), other(turns(n))
    raw = np.frombuffer((one + two).encode(), np.uint8)
    at = np.array([0, n])
    assert len(set(common.Rolling(raw).of(at, at + n).tolist())) == 1
    assert len(set(common.word_hashes(raw, at, at + n).tolist())) == 2
    docs = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    rows = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert rows == {1: 1, 2: 2, 3: 1}
    model = pieces.Pieces.load(pieces.MODEL)
    for merge in (False, True):
        [(ids, off)] = model.encode([one, two], (merge,))
        assert model.decode(ids, off) == [one, two]


def test_passages_of_words_of_equal_polynomial_hash(spark):
    words = [turns(1024), other(turns(1024))]
    rnd = random.Random(2)
    pick = [rnd.randrange(2) for _ in range(60)]
    docs = spark.createDataFrame(
        [(1, " ".join(words[i] for i in pick)), (2, " ".join(words[1 - i] for i in pick)), (3, " ".join(words[i] for i in pick))],
        "doc_id long, text string",
    )
    assert [(r.doc_id, r.partner_id, r.n_words) for r in passages.fuzzy_passages(docs).collect()] == [(3, 1, 60)]


@pytest.mark.parametrize("text", ["".join(random.Random(0).choice("acgt") for _ in range(100_000)), "a" * 5000, "the" * 700 + "xyz" * 300])
def test_merges_of_a_long_word_equal_the_library(text):
    from sentencepiece import SentencePieceProcessor

    [(ids, _)] = pieces.Pieces.load(pieces.MODEL).encode([text], (True,))
    assert ids.tolist() == SentencePieceProcessor(model_file=pieces.MODEL).encode(text)


def test_long_and_short_merges_agree(monkeypatch):
    model, rnd = pieces.Pieces.load(pieces.MODEL), random.Random(4)
    texts = ["".join(rnd.choice("acgtthe") for _ in range(rnd.randrange(2, 200))) for _ in range(60)]
    [(want, off)] = model.encode(texts, (True,))
    monkeypatch.setattr(pieces, "LONG", 1)
    [(got, again)] = model.encode(texts, (True,))
    assert got.tolist() == want.tolist() and off.tolist() == again.tolist()


def test_chains_looked_at_together_are_none_one_by_one():
    """What is passed over has no passage in a look at the same words without it."""
    rnd, passed = np.random.default_rng(5), 0
    for _ in range(400):
        n_a, n_b = rnd.integers(5, 160, 2)
        a, b = rnd.integers(0, 3, n_a).astype(np.uint64), rnd.integers(0, 3, n_b).astype(np.uint64)
        x, y = int(rnd.integers(0, n_a - 4)), int(rnd.integers(0, n_b - 4))
        b[y : y + 5] = a[x : x + 5]
        if rnd.random() < 0.5:  # alike around the run
            for i in range(-70, 70):
                if 0 <= x + i < n_a and 0 <= y + i < n_b and rnd.random() < 0.8:
                    b[y + i] = a[x + i]
        few = passages._too_few(
            (a, np.array([x]), np.array([[0], [n_a]])), (b, np.array([y]), np.array([[0], [n_b]])), np.array([5]), 50, 0.8
        )[0]
        if few:
            passed += 1
            left, more = passages._extend(a[:x][::-1], b[:y][::-1])
            right, most = passages._extend(a[x + 5 :], b[y + 5 :])
            words, hits = 5 + left + right, 5 + more + most
            assert hits < 40
            if words < 50:
                left, right = min(x, y, 50), min(n_a - x - 5, n_b - y - 5, 50)
                ends = [(x - left, y - left, left), (x, y, 5), (x + 5, y + 5, right)]
                assert passages._parts(a, b, ends, 50, 0.8) == []
    assert passed > 100


def test_covered_places_equal_brute_force():
    rnd = np.random.default_rng(6)
    for _ in range(200):
        starts = rnd.integers(0, 50, rnd.integers(0, 6))
        ends = starts + rnd.integers(1, 20, len(starts))
        first = rnd.integers(0, 60, 30)
        end = first + rnd.integers(1, 15, 30)
        line = np.zeros(100, bool)
        for s, e in zip(starts, ends, strict=True):
            line[s:e] = True
        want = [bool(line[f:e].all()) for f, e in zip(first, end, strict=True)]
        assert passages._covered(starts, ends, first, end).tolist() == want
