"""The pipeline, stage by stage, against brute force over a whole small table; and the registration of all queries."""

from __future__ import annotations

import os
from collections import Counter, defaultdict

import duckdb
import pytest
from test_mixing_and_hosts import plain_copies
from test_similarity import plain_classes
from test_text_rules import plain_measures, plain_spans
from test_tokens_and_packing import BYTE, crc, plain_ids

import __spark_entry__ as entry_point
import corpus_pipeline
from hexcohort.sources.scratch import materialize

SF = "/root/testdata/sf0.001"


def plain_kept(text):
    n, chars, symbols, lines, dup, repeat, letters, capitals = plain_measures(text)
    return not (n < 10 or 100 * repeat > 20 * n or 10 * symbols > n or 2 * dup > lines or 5 * capitals > 2 * letters
                or chars < 2 * n or chars > 15 * n)


def plain_redacted(text):
    out, at, end = [], 0, -1
    for a, _, b in plain_spans(text):
        if a >= end:
            out += [text[at:a], "[SECRET]"]
        end = max(end, b)
        at = end
    return "".join(out) + text[at:] if out else text


@pytest.fixture(scope="module")
def rows():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    return duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet'").fetchall()


def test_stages_match_brute_force(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (n1, f1), (n2, f2), (n3, f3), (n4, f4), (n5, f5) = corpus_pipeline.STAGES
    quality = materialize(f1(spark, docs, SF), "t1")
    want = [r for r in rows if plain_kept(r[1] or "")]
    assert sorted(map(tuple, quality.collect())) == sorted(want) and 0 < len(want) < len(rows)
    unique = materialize(f2(spark, quality, SF), "t2")
    label = plain_classes([(r[0], r[1]) for r in want])
    want = [r for r in want if label[r[0]] == r[0]]
    assert sorted(map(tuple, unique.collect())) == sorted(want)
    clean = materialize(f3(spark, unique, SF), "t3")
    want = [(i, t2, lang, s, n if t2 == t else len(t2)) for i, t, lang, s, n in want for t2 in [plain_redacted(t)]]
    assert sorted(map(tuple, clean.collect())) == sorted(want)
    mixed = materialize(f4(spark, clean, SF), "t4")
    mass = Counter()
    for r in want:
        mass[r[3]] += len(r[1])
    weight = {s: 0.1 if s == "src0" else 0.05 for s in mass}
    rate = {s: weight[s] * sum(mass.values()) / (sum(weight.values()) * mass[s]) for s in mass}
    want = [r for r in want for _ in range(plain_copies(r[0], rate[r[3]]))]
    assert sorted(map(tuple, mixed.collect())) == sorted(want)
    for d in (quality, unique, clean, mixed):
        assert d.columns == docs.columns
    pieces = f5(spark, mixed, SF).collect()
    ids = {r[0]: own for r, own in zip(want, plain_ids(BYTE, [r[1] for r in want], 0))}
    copies, sequences = Counter(r[0] for r in want), defaultdict(list)
    covered = Counter()
    for p in pieces:
        own = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(own) and p["ids_crc32"] == crc(own[p["start"]:p["start"] + p["length"]])
        covered.update((p["doc_id"], k) for k in range(p["start"], p["start"] + p["length"]))
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert covered == Counter({(d, k): n for d, n in copies.items() for k in range(len(ids[d]))})
    for held in sequences.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at == 1024 or at & (at - 1) == 0


def test_run_equals_the_stages(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "t")
    one, other = docs.drop("sequence_id", "offset"), corpus_pipeline.run(spark, SF).drop("sequence_id", "offset")
    assert one.groupBy("doc_id").sum("length").exceptAll(other.groupBy("doc_id").sum("length")).isEmpty()


def test_empty_documents_run_through(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "t")
    assert docs.count() == 0


def test_every_operator_is_registered():
    names = entry_point.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and set(entry_point.oracle_sql()) <= set(names)
