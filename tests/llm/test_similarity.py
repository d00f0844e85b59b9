"""BagMinHash near-duplicates, vantage-point search and repeated windows against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from hexcohort.llm import bagminhash, near_dup, repeats, vptree


# --- signatures ---------------------------------------------------------------------------------------------------------

def test_signatures_estimate_the_weighted_similarity_without_bias():
    rng = np.random.default_rng(1)
    text, element, count, want = [], [], [], []
    for k in range(300):
        names = rng.integers(0, 2**63, 60).astype(np.uint64)
        a = rng.integers(1, 40, 60)
        b = np.where(rng.random(60) < 0.4, rng.integers(0, 40, 60), a)
        want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        for n, c in ((2 * k, a), (2 * k + 1, b)):
            text.append(np.full((c > 0).sum(), n)), element.append(names[c > 0]), count.append(c[c > 0])
    times = bagminhash.signatures(np.concatenate(text), np.concatenate(element), np.concatenate(count), 600, 128)
    off = (times[0::2] == times[1::2]).mean(1) - np.array(want)
    assert abs(off.mean()) < 0.01 and off.std() < 1.2 * np.sqrt(np.mean([p * (1 - p) for p in want]) / 128)


def test_signature_does_not_depend_on_the_batch():
    e, c = np.array([5, 9, 12], np.uint64), np.array([1, 3, 70])
    alone = bagminhash.signatures(np.zeros(3, int), e, c, 1, 64)
    both = bagminhash.signatures(np.array([0, 1, 1, 1]), np.concatenate([[7], e]).astype(np.uint64), np.concatenate([[2], c]), 3, 64)
    assert (both[1] == alone[0]).all() and np.isinf(both[2]).all()


def test_signature_bits_are_the_same_alone_and_in_any_batch():
    rng = np.random.default_rng(6)
    elements = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (4, 12, 40, 150, 400)]
    counts = [rng.integers(1, 30, len(e)) for e in elements]

    def batch(n_filling):
        other = rng.integers(0, 2**63, 20 * n_filling).astype(np.uint64)
        text = np.concatenate([np.repeat(np.arange(5), [len(e) for e in elements]), 5 + np.repeat(np.arange(n_filling), 20)])
        ones = np.ones(len(other), int)
        return bagminhash.signatures(text, np.concatenate([*elements, other]), np.concatenate([*counts, ones]), 5 + n_filling, 384)[:5]

    alone = np.concatenate([bagminhash.signatures(np.zeros(len(e), int), e, c, 1, 384) for e, c in zip(elements, counts)])
    assert (alone.view(np.uint64) == batch(0).view(np.uint64)).all() and (alone.view(np.uint64) == batch(5000).view(np.uint64)).all()


# --- near-duplicates ----------------------------------------------------------------------------------------------------

def multiset(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()).split()
    n = min(5, len(words))
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def plain_classes(docs, threshold=0.8):
    bags = {i: multiset(t or "") for i, t in docs}
    up = {i: i for i in bags}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    names = sorted(bags)
    for x, a in enumerate(names):
        for b in names[x + 1:]:
            both = sum((bags[a] & bags[b]).values())
            if both and both / (sum(bags[a].values()) + sum(bags[b].values()) - both) >= threshold:
                low, high = sorted((find(a), find(b)))
                up[high] = low
    return {i: find(i) for i in bags}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_classes_match_brute_force(spark, docs_of):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = [t for t in ODD if t and len(t) < 1000]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(30, 200))
        texts.append(" ".join(base))
        texts += [edited(rng, base, rng.choice([0, 1, 2, 4])) for _ in range(rng.randint(0, 6))]
        texts.append(" ".join(base).upper())
        texts.append("\n".join(base[:len(base) // 2]))
    passage = rng.choices(vocabulary, k=60)
    texts += [" ".join(rng.choices(vocabulary, k=50) + passage + rng.choices(vocabulary, k=50)) for _ in range(25)]
    rng.shuffle(texts)
    docs = [(10 * i - 300, t) for i, t in enumerate(texts)]
    df = docs_of(docs).withColumn("kept", F.lit("mine"))
    got = near_dup.classes(df).collect()
    want = plain_classes(docs)
    assert {r["id"]: r["class_id"] for r in got} == want and len(got) == len(docs)
    assert all(r["kept"] == (r["id"] == want[r["id"]]) for r in got)
    left = near_dup.distinct_documents(df)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == set(want.values())


def test_a_large_group_of_near_copies_is_one_class_in_any_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(near_dup, "likely", lambda pairs: pairs.select("a", "b").limit(0))          # the complete comparison alone
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 5000)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = [edited(rng, base, 1 + i % 2) for i in range(60)] + [" ".join(base)] * 40 + [f"other text {i} with some words" for i in range(5)]
    got = {r["id"]: r["class_id"] for r in near_dup.classes(docs_of(texts)).collect()}
    assert got == plain_classes(list(enumerate(texts)))


def near_copies(n, seed=4):
    """Texts around the threshold: a hundred words, one to three of them replaced by words of their own; and their links."""
    rng = random.Random(seed)
    places = [sorted(rng.sample(range(100), rng.choice([1, 2, 2, 3, 3]))) for _ in range(n)]
    texts = [" ".join(f"n{i}x{p}" if p in own else f"w{p}" for p in range(100)) for i, own in enumerate(places)]
    whole = np.array([[not any(p in own for p in range(s, s + 5)) for s in range(96)] for own in places], np.float32)
    shared = whole @ whole.T                              # shingles without a replaced word are all that two texts share
    return texts, shared / (192 - shared) >= 0.8


def test_many_near_copies_around_the_threshold(spark, docs_of, monkeypatch):
    texts, linked = near_copies(1500)
    np.fill_diagonal(linked, False)
    want = np.arange(len(texts))
    while True:
        least = np.minimum(want, np.where(linked, want[None, :], len(texts)).min(axis=1))
        if (least == want).all():
            break
        want = least
    assert 1 < len(set(want.tolist())) < 1400
    written = []
    joining = near_dup.joining

    def counted(held, threshold):
        links = joining(held, threshold)
        written.append((links.count(), held.count()))
        return links

    monkeypatch.setattr(near_dup, "joining", counted)
    got = {r["id"]: r["class_id"] for r in near_dup.classes(docs_of(texts).repartition(8)).collect()}
    assert [got[i] for i in range(len(texts))] == want.tolist()
    assert all(links < members for links, members in written)


def test_equal_ids_with_other_texts_clashing_names_and_long_texts(spark, docs_of):
    long = " ".join(f"w{i % 977}x{i % 1009}" for i in range(60_000))
    df = docs_of([(1, "one text with quite a few words"), (1, "entirely different content under the same name"), (1, "One text WITH quite a few  words"),
                  (2, long), (3, long + " end"), (4, "entirely different content under the same name")])
    odd = df.selectExpr("*", "1 AS kept_id", "2 AS kept_id_", "3 AS words", "4 AS id", "5 AS digest", "6 AS class_id")
    left = near_dup.distinct_documents(odd)
    assert left.columns == odd.columns
    texts = sorted((r["doc_id"], " ".join((r["text"] or "").lower().split())) for r in left.collect())
    assert texts == sorted([(1, "one text with quite a few words"), (1, "entirely different content under the same name"), (2, long)])


def test_rows_without_words_or_ids_and_empty_tables(spark, docs_of):
    df = docs_of([(1, None), (2, ""), (3, " \n"), (None, "some words are here now"), (5, "some words are here now"), (5, "some words are here now"),
                  (6, "Some words ARE here now")])
    rows = near_dup.classes(df).collect()
    assert Counter((r["id"], r["class_id"], r["kept"]) for r in rows) == Counter(
        [(1, 1, True), (2, 2, True), (3, 3, True), (None, None, True), (5, 5, True), (5, 5, True), (6, 5, False)])
    assert sorted(map(str, (r["doc_id"] for r in near_dup.distinct_documents(df).collect()))) == ["1", "2", "3", "5", "None"]
    assert near_dup.classes(df.limit(0)).collect() == [] and near_dup.distinct_documents(df.limit(0)).collect() == []


# --- vantage points -----------------------------------------------------------------------------------------------------

def plain_nearest(rows, k=10, every=100):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(tuple(v))
    out = []
    for q in sorted(i for i in good if i % every == 0):
        own = good[q][0]
        found = sorted((float(np.sqrt(np.sum((np.array(v) - own) ** 2))), i) for i, vs in good.items() for v in set(vs) if i != q and len(v) == len(own))
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(found[:k])]
    return out


def same(got, want):
    got = sorted(map(tuple, got))
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=1e-15)


def test_exact_search_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(i % 7, 1, 3), 1)]) for i in range(900)]
    rows += [(1000 + i, [0.5, 0.5, 0.5]) for i in range(250)]                              # a common vector, with queries among it
    rows += [(2000, None), (2100, []), (2200, [0.0, 0.0, 0.0]), (2300, [1.0, None, 2.0]), (2400, [1.0, float("nan"), 1.0]), (2500, [float("inf"), 1.0, 1.0]),
             (None, [1.0, 1.0, 1.0]), (2600, [1.0, 2.0]), (2601, [1.0, 3.0]), rows[100], rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("mine")).repartition(5)
    same(vptree.nearest(df).collect(), plain_nearest(rows))
    few = rows[:5]
    same(vptree.nearest(spark.createDataFrame(few, df.schema[:2])).collect(), plain_nearest(few))
    assert vptree.nearest(df.limit(0)).collect() == []


def test_relaxed_search_keeps_its_recall():
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (3000, 4))
    ids, q = np.arange(3000), np.arange(0, 3000, 100)
    found, work = {}, {}
    for relax in (1.0, 1.5):
        s = vptree.Search(x, ids, x[q], ids[q], 10, relax)
        s.run(vptree.build(x, ids))
        found[relax], work[relax] = s.found, s.seen
    exact = [set(map(int, sorted(np.delete(ids, i), key=lambda j: (((x[i] - x[j]) ** 2).sum(), j))[:10])) for i in q]
    assert [set(map(int, r)) for r in found[1.0]] == exact
    assert work[1.5] < work[1.0] < 0.5 * len(x) * len(q)
    assert np.mean([len(e & set(map(int, r))) / 10 for e, r in zip(exact, found[1.5])]) >= 0.9


def test_blocks_and_shards_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD", 64)
    monkeypatch.setattr(vptree, "BLOCK", 3)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 2)]) for i in range(1000)]
    same(vptree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("embedding", F.col("embedding").cast("array<double>"))).collect(),
         plain_nearest([(i, [float(np.float32(x)) for x in v]) for i, v in rows]))


# --- repeated windows ---------------------------------------------------------------------------------------------------

def plain_trim(docs, size=13):
    owner = {}
    split = [(i, (t or "").encode().split()) for i, t in docs]
    key = lambda i: (i is None, i or 0)
    for i, w in split:
        for p in range(len(w) - size + 1):
            g = tuple(w[p:p + size])
            owner[g] = min(owner.get(g, i), i, key=key)
    out = []
    for i, w in split:
        gone = {q for p in range(len(w) - size + 1) if key(owner[tuple(w[p:p + size])]) < key(i) for q in range(p, p + size)}
        out.append((i, len(w), len(gone), b" ".join(x for q, x in enumerate(w) if q not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [13, 5, 20])
def test_trim_matches_brute_force(spark, docs_of, size):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(40)]
    passages = [rng.choices(vocabulary, k=n) for n in (size - 1, size, size + 1, 2 * size, 60)]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choice(passages) if rng.random() < 0.4 else rng.choices(vocabulary, k=rng.randint(0, 30))
        docs.append((rng.randrange(-50, 10**6), " ".join(parts)))
    docs += [(i, t) for i, t in enumerate(ODD, 2 * 10**6)] + [(7, docs[3][1]), (7, docs[3][1]), (None, docs[3][1]), (None, docs[4][1])]
    df = docs_of(docs).withColumn("g", F.lit("mine")).withColumn("kept", F.lit(0))
    got = repeats.without_repeats(df, size).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == plain_trim(docs, size)
    for r in got:
        spans = [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]
        assert sum(b - a for a, b in spans) == r["n_removed"] and spans == sorted(spans)


def test_trim_of_an_empty_table(spark, docs_of):
    assert repeats.without_repeats(docs_of(["x"]).limit(0)).collect() == []


def test_packed_numbers_come_back():
    rng = np.random.default_rng(7)
    for values in ([], [0], [2**64 - 1], np.sort(rng.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2)), [5, 5, 5]):
        values = np.array(values, np.uint64)
        assert (repeats.from_sorted(repeats.to_sorted(values)) == values).all() and (repeats.from_planes(repeats.to_planes(values)) == values).all()


def test_plan_stays_even():
    for total in (0, 10**6, 10**9, 10**12, 10**14):
        plan = repeats.Plan(total, 200, 13)
        assert plan.lengths == [7, 13] and 32 <= plan.bits <= 64 and plan.groups >= plan.buckets >= 200
