"""Training words from whole texts, bounded languages, and notices of licenses, against SQL and plain code."""

import duckdb
import numpy as np
import pytest

from daybook.llm import language_id, licenses
from tests.llm.test_operators import NOTICES

SENTENCES = {
    "This project is released under the MIT License.": ["MIT"],
    "Licensed under the MIT license (see LICENSE).": ["MIT"],
    "# SPDX-License-Identifier: MIT": ["MIT"],
    "// SPDX-License-Identifier: GPL-2.0-or-later\nint x;": ["GPL-2.0-or-later"],
    "Distributed under the terms of the GNU General Public License v3.": ["GPL-3.0-only"],
    "This code is licensed under CC BY 4.0.": ["CC-BY-4.0"],
    "Dual-licensed under either of the MIT or Apache 2.0 license.": ["Apache-2.0", "MIT"],
    "It is made available under the\n * terms of the Eclipse Public\n * License 2.0 which is here": ["EPL-2.0"],
    "The MIT License\n\nCopyright someone": ["MIT"],
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:": ["MIT"],
    "Released under the GPLv3 or later.": ["GPL-3.0-or-later"],
    "He was released under the mitigating terms of the law.": [],
    "We talked of the MIT license and of apache helicopters.": [],
    "licensed under the apache tribe": [],
}


def test_notices_inside_sentences(spark):
    rows = [(i, t) for i, t in enumerate(SENTENCES)]
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {t: sorted(got[i]) for i, t in rows} == {t: sorted(v) for t, v in SENTENCES.items()}


def test_every_name_is_a_notice(spark):
    names = licenses.notice_names()
    rows = [(i, f"Some words. All this is licensed under the {n.upper()}, as said.") for i, n in enumerate(names)]
    got = {r.doc_id: r.license for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {n: got[i] for i, n in enumerate(names)} == names


def test_licenses_equal_their_sql_on_wrapped_notices(spark):
    texts = [*SENTENCES, *NOTICES.values(), None, "", "\n\n", *("\n".join(t.split(" ")) for t in (*SENTENCES, *NOTICES.values()))]
    texts += ["\nREM ".join([t[:40], t[40:]]) for t in texts if t] + [a + "\n" + b for a, b in zip(SENTENCES, NOTICES.values())]
    rows = [(i, t) for i, t in enumerate(texts)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(licenses.scan_sql()).fetchall())
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r.doc_id, r.n_sentences, ",".join(map(str, r.sentence_ids)), r.license, ";".join(r.licenses)) for r in found)
    assert got == want


def test_training_words_come_from_the_whole_text(spark):
    words = [f"w{i}" for i in range(5000)]
    some = language_id.spread(words)
    assert len(some) == language_id.SAMPLE_WORDS and some[0] == "w0" and some[-1] == "w4999" and language_id.spread(words[:400]) == words[:400]
    assert np.diff([int(w[1:]) for w in some]).max() < 5000 / 10
    # long documents of two languages that open with the same notice of 500 words
    notice = "dies ist ein hinweis den jeder kennt " * 72
    rows = [(i, notice + body * 400, lang) for i in range(20) for lang, body in (("xx", "alpha beta gamma "), ("yy", "delta omega sigma "))]
    model = language_id.fit_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    pred = language_id.predict(spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta omega sigma")], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in pred.collect()} == {1: "xx", 2: "yy"}


def test_learned_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_LANGUAGES", 2)
    rows = [(i, "some plain words " * 5, f"l{i % 7 if i < 70 else i % 2 + 3}") for i in range(100)]
    rows.append((200, "a" * 10_000 + " word", "l3"))
    model = language_id.fit_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.labels == ["l3", "l4"]


@pytest.mark.parametrize("seed", [1, 2])
def test_first_word_is_fitted_as_it_is_predicted(seed):
    """Where all words look alike, the labels' shares decide; the first word must not lean to another label."""
    rng = np.random.default_rng(seed)
    texts = [" ".join(rng.choice(["aa", "bb", "cc"], 40)) for _ in range(40)]
    model = language_id.fit(texts, ["x"] * 30 + ["y"] * 10)
    p = model.marginals(model.emissions(["aa", "bb", "cc"] * 10), np.array([30]))
    assert p[0].argmax() == p[15].argmax()
