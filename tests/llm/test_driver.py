"""What the text operators leave on the driver."""

import numpy as np

from daybook.llm import common, jaccard_join, quality
from pyspark.sql.classic.dataframe import DataFrame

TEXTS = [f"{'plain words of a good text ' * (i % 5 + 1)}{i}" if i % 3 else "BUY!!! now $$$ " * (i % 4 + 1) for i in range(60)]


def test_quality_sample_is_fitted_in_a_task(spark, monkeypatch):
    # ids out of order and held twice; null labels and ids are no examples
    docs = spark.createDataFrame([(59 - i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (3, "z")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (60, 1)], "doc_id long, quality int")

    def refuse(self):
        raise AssertionError("the sample's texts came to the driver")

    monkeypatch.setattr(DataFrame, "toPandas", refuse)
    monkeypatch.setattr(DataFrame, "toArrow", refuse)
    model = quality.fit_sample(docs.where("doc_id <> 3").repartition(5), labels)
    kept = [i for i in range(60) if i != 3]
    want = quality.fit([TEXTS[59 - i] for i in kept], [i % 2 for i in kept])
    for name in (*quality.Attention.NAMES, "mean", "spread"):
        assert getattr(model, name).shape == getattr(want, name).shape
        assert np.allclose(getattr(model, name), getattr(want, name), rtol=1e-6, atol=1e-9), name
    assert quality.fit_sample(docs, labels.where("quality > 1")) is None


class _Jvm:
    """A driver whose heap takes ``total`` of 100."""

    def __init__(self, total):
        self.total, self.collected = total, 0
        self.java = self.lang = self.Runtime = self.System = self

    def getRuntime(self):
        return self

    def totalMemory(self):
        return self.total

    def maxMemory(self):
        return 100

    def gc(self):
        self.collected += 1


def test_a_grown_heap_is_given_back():
    for total, times in ((50, 0), (51, 1), (100, 1)):
        session = type("Session", (), {"_jvm": _Jvm(total)})()
        common.release_if_grown(session)
        assert session._jvm.collected == times
    common.release_if_grown(type("Connect", (), {})())


def test_scratch_tables_look_at_the_heap(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(common, "release_if_grown", seen.append)
    assert common.written(spark.range(3), "some").count() == 3 and len(seen) == 1


def test_frequent_shingles_of_no_documents(spark):
    rows, links = jaccard_join.jaccard_links(spark.createDataFrame([], "doc_id long, text string"))
    assert rows.count() == 0 and links.count() == 0
