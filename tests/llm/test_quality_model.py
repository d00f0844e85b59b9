"""The quality classifier: held-out accuracy, what it learns from, odd rows."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD

from hexcohort.llm import quality_model as qm

SF = "/root/testdata/sf0.1"


def test_vectors_are_counted_whatever_the_batch():
    texts = ["a b a b", "", None, "x", "Wort%%% und&&& und&&&", "a b a b"]
    edges, places, values = qm.vectors(pa.array(texts))
    assert np.diff(edges).tolist() == [4, 1, 1, 1, 8, 4]          # "a b a b" has two different pairs
    assert np.allclose(np.add.reduceat(values ** 2, edges[:-1]), 1)
    alone = qm.vectors(pa.array(texts[4:5]))
    assert (alone[1] == places[edges[4]:edges[5]]).all() and (alone[2] == values[edges[4]:edges[5]]).all()


def test_learner_follows_the_plain_updates():
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(50, 6, replace=False)), rng.random(6), int(rng.random() < .5)) for _ in range(200)]
    leader, z, n = qm.Leader(), dict.fromkeys(range(51), 0.0), dict.fromkeys(range(51), 0.0)

    def weight(i):
        return -z[i] / ((qm.BETA + n[i] ** .5) / qm.ALPHA + qm.L2)

    for at, x, y in rows:
        leader.learn(at, x, y)
        pairs = [*zip(at.tolist(), x.tolist()), (50, 1.0)]
        p = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in pairs)))
        for i, v in pairs:
            g, w = (p - y) * v, weight(i)
            z[i] += g - ((n[i] + g * g) ** .5 - n[i] ** .5) / qm.ALPHA * w
            n[i] += g * g
    got = leader.weights(np.append(np.arange(50), 1 << qm.BITS))
    assert np.allclose(got, [weight(i) for i in range(51)])


def test_held_out_accuracy(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in qm.scored(docs, qm.fit(docs, labels)).collect()}
    assert len(got) == docs.count()
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 500 and all(g.held_out for g, _ in held)
    good, bad = [g for g, q in held if q == 1], [g for g, q in held if q == 0]
    assert np.mean([g.predicted for g in good]) > 0.99 and np.mean([1 - g.predicted for g in bad]) > 0.8
    above = np.mean([[g.score > b.score for b in bad] for g in good])
    assert above > 0.99


def test_held_out_labels_and_other_columns_teach_nothing(spark, docs_of):
    rows = [(i, f"{'good plain words' if i % 2 else 'bad ### junk'} number {i}") for i in range(60)]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    other = spark.createDataFrame([(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2, 1) for i in range(60)], "doc_id long, quality int, toxic int")
    a, b = qm.fit(docs, labels), qm.fit(docs.drop("lang").selectExpr("*", "1 AS label", "2 AS id", "3 AS place"), other)
    assert (a == b).all() and len(a) == (1 << qm.BITS) + 1
    assert qm.sampled(labels, 10).count() == 10


def test_odd_rows_have_scores(spark, docs_of):
    docs = docs_of([*ODD, (None, "no id"), (3, "repeated id"), (3, None)]).selectExpr("*", "1 AS score", "2 AS held_out")
    labels = spark.createDataFrame([(3, 0), (3, 1), (4, 1), (4, 2), (None, 1), (99, 0), (5, None)], "doc_id long, quality int")
    rows = qm.scored(docs, qm.fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    none = qm.fit(docs, labels.limit(0))
    assert not none.any() and {r.score for r in qm.scored(docs, none).collect()} == {0.5}
    assert qm.scored(docs.limit(0), none).collect() == []
