import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from costloom.llm import quality

from .data import collected, documents, prose, with_clashes


def junk(k):
    r = random.Random(k)
    w = prose(k, 40).split()
    return r.choice([" | ".join(w), " ".join(x + "$$$" for x in w), " ".join([w[0]] * 40), prose(k, 40).upper() + "!!"])


def corpus(spark):
    rows = [(k, prose(k, 40) + "." if k % 2 else junk(k)) for k in range(300)] + [(1000, None), (1001, ""), (1002, "   "), (1003, prose(1, 30_000)), (None, prose(3)), (5, prose(5, 40) + ".")]
    labels = [(k, k % 2, 0) for k in range(300)] + [(3, 1, 0), (4, None, 0), (None, 1, 0), (9999, 1, 0)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = corpus(spark)
    got = quality.score(with_clashes(docs), labels).collect()
    assert len(got) == 306 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 300]
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95
    by = {r.doc_id: r.score for r in got}
    assert by[1000] == by[1001] and [r.score for r in got if r.doc_id == 5] == [by[5]] * 2


def test_held_out_labels_are_not_learned(spark):
    docs, labels = corpus(spark)
    lied = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert collected(quality.score(docs, labels)) == collected(quality.score(docs, lied))


def test_no_labels_and_empty_table(spark):
    docs, labels = corpus(spark)
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).count() == 0


def test_features_of_long_texts_add_up(monkeypatch):
    text = "\n".join(prose(k, 30) for k in range(40))
    whole = quality.features(text)
    monkeypatch.setattr(quality, "PIECE", 50)
    lines = [quality.FEATURES.index(x) for x in ("lines", "repeated_lines")]
    rest = [k for k in range(len(quality.FEATURES)) if k not in lines]
    assert quality.features(text)[rest] == pytest.approx(whole[rest])


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.train(x[:2000], y[:2000])
    assert ((model.predict(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.9
    assert (1, 0) in [(i, j) for i, j, _ in model.pairs]
