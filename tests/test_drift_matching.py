"""Pairing of old and new segments."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from hexcohort.operators.drift import _assignment, drift, match_labels, match_segments, transitions

SCHEMA = "subscriber_id long, segment_id int"


@pytest.mark.parametrize("rows,cols", [(1, 1), (3, 3), (4, 6), (6, 6), (2, 7)])
def test_assignment_matches_all_pairings(rows, cols):
    for seed in range(20):
        w = np.random.default_rng(seed).integers(0, 9, (rows, cols))
        at = _assignment(w)
        assert len(set(at.tolist())) == rows
        best = max(sum(w[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(cols), rows))
        assert w[np.arange(rows), at].sum() == best


def test_permuted_ids_are_no_drift(spark):
    old = [(i, i % 9 - 1) for i in range(400)]
    new = [(i, (s * 5 + 3) % 8 if s >= 0 else s) for i, s in old]
    a, b = spark.createDataFrame(new, SCHEMA), spark.createDataFrame(old, SCHEMA)
    assert drift(a, b).first().drift_pct > 80
    assert drift(match_labels(a, b), b).first().n_changed == 0


def test_split_merged_new_and_missing_segments(spark):
    old = [(i, 0) for i in range(10)] + [(i, 1) for i in range(10, 16)] + [(i, 2) for i in range(16, 20)] + [(20, None), (21, -1)]
    new = [(i, 5) for i in range(7)] + [(i, 6) for i in range(7, 10)] + [(i, 1) for i in range(10, 20)] + [(20, None), (21, -1), (30, 9)]
    a, b = spark.createDataFrame(new, SCHEMA), spark.createDataFrame(old, SCHEMA)
    assert {(r.previous, r.current, r.n) for r in match_segments(transitions(a, b)).collect()} == {(0, 5, 7), (1, 1, 6)}
    got = {r.subscriber_id: r.segment_id for r in match_labels(a, b).collect()}
    assert len(got) == 23 and got[0] == 0 and got[10] == got[19] == 1 and got[20] is None and got[21] == -1
    assert got[7] > 9 and got[30] > 9 and got[7] != got[30]
    assert drift(match_labels(a, b), b).first().n_changed == 3 + 4
    assert match_segments(transitions(a.limit(0), b)).collect() == []
