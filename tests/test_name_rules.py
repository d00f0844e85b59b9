from __future__ import annotations

import random

from hexcohort.operators.name_rules import first_rules


def plain(names, rules):
    out = {}
    for n in {n for n in names if n is not None}:
        hits = [(place, p) for p, place in rules if p is not None and p in n]
        if hits:
            out[n] = min(hits)
    return out


def matched(spark, names, rules):
    rows = first_rules(spark.createDataFrame([(n,) for n in names], "name string").repartition(4), spark.createDataFrame(rules, "pattern string, place long"))
    got = {r["name"]: (r["place"], r["pattern"]) for r in rows.collect()}
    return got, rows.count()


def test_many_names_and_patterns(spark):
    r = random.Random(1)
    word = ["".join(r.choices("abcdeé", k=r.randint(2, 7))) for _ in range(3000)]
    names = [" ".join(r.choices(word, k=3)) for _ in range(10_000)] + ["the same name"] * 5000
    rules = [(w, i) for i, w in enumerate(r.sample(word, 1000))] + [("same", 5000), ("not there", 1)]
    got, n = matched(spark, names, rules)
    assert got == plain(names, rules) and n == len(got)


def test_odd_names_and_patterns(spark):
    names = [None, "", "a", "ab", "abc", "Social Hub 2", "social hub", "日本語 text", "a%b_c"]
    for rules in ([("Social Hub", 3), ("Hub", 9), ("b", 2), ("ab", 4), (None, 0), ("日", 7), ("%b_", 1), ("b", 1), ("longer than any name here", 0)],
                  [("", 5), ("abc", 9), ("a", 1)], [("", 5)], [(None, 1)], []):
        assert matched(spark, names, rules)[0] == plain(names, rules), rules
    assert matched(spark, [], [("a", 1)])[0] == {}
