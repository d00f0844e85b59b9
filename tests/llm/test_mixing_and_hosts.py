"""Poisson mixture and host reputation."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from hexcohort.llm import hosts, mixing


def plain_poisson(mean, u):
    p = c = math.exp(-mean)
    k = 0
    while c <= u:
        k += 1
        p *= mean / k
        c += p
    return k


def plain_copies(doc_id, rate, seed=17):
    parts = max(1, math.ceil(rate / 8))
    total = 0
    for i in range(1, parts + 1):
        u = int(hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}:{i}".encode()).hexdigest()[:13], 16) / 2**52
        total += plain_poisson(rate / parts, u)
    return total


def test_mixture_matches_inversion_and_hits_the_targets(spark):
    rows = [(i, "x" * 10, "big" if i % 10 < 7 else ("mid" if i % 10 < 9 else "tiny")) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy", F.lit("mine"))
    out = mixing.mixed(df, {"big": 0.2, "mid": 0.2, "tiny": 0.6}, other=0.0).collect()
    got = Counter(r["doc_id"] for r in out)
    rate = {"big": 0.2 / 0.7, "mid": 1.0, "tiny": 6.0}
    for i, _, s in rows:
        assert got[i] == plain_copies(i, rate[s]), (i, s)
    assert all(r["copy"] == "mine" for r in out)
    for i in got:
        assert sorted(r["copy_"] for r in out if r["doc_id"] == i) == list(range(1, got[i] + 1)) or i > 40
    share = Counter(r["source"] for r in out)
    assert abs(share["tiny"] / len(out) - 0.6) < 0.03 and abs(len(out) - 4000) < 250


def test_large_rates_are_split(spark):
    df = spark.createDataFrame([(i, "y" * (1 if i == 0 else 1000), "a" if i == 0 else "b") for i in range(20)], "doc_id long, text string, source string")
    out = mixing.mixed(df, {"a": 0.5, "b": 0.5}, other=0.0)
    rates = {r["source"]: r["rate"] for r in mixing.rates(df, {"a": 0.5, "b": 0.5}, 0.0).collect()}
    assert rates["a"] > 5000 and Counter(r["doc_id"] for r in out.collect())[0] == plain_copies(0, rates["a"])


def test_mixture_of_odd_rows(spark, docs_of):
    df = docs_of([*ODD, (None, "no id"), (None, "no id")]).unionByName(docs_of(["no source"], source=None))
    out = mixing.mixed(df, {}, other=1.0)
    assert out.columns[:5] == df.columns and out.filter("doc_id IS NULL").count() % 2 == 0
    assert mixing.mixed(df.limit(0)).collect() == []
    silent = mixing.mixed(docs_of([None, ""], source="empty"), {}, other=1.0)
    assert silent.collect() == []


def test_copies_are_dealt_by_hash(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    parts = mixing.mixed(df, {}, 1.0, partitions=4).withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.avg("doc_id").alias("m")).collect()
    assert len(parts) == 4 and all(350 < r["n"] < 650 and 800 < r["m"] < 1200 for r in parts)


URLS = [("HTTP://A.Example.COM/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://b.www.example.com/en/", "b.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("https://example.com/fr/", "example.com", "/fr/", "com/", "allow"), ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("x://com?a=/en/", "com", "", None, None), ("http://a.net/es/?q", "a.net", "/es/", "net/es/", "block"), ("http://a.net/de/", "a.net", "/de/", None, None),
        ("http://k.org#top", "k.org", "", None, None), ("no scheme", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
        ("a://b://c/d", "b:", "//c/d", None, None), ("http://É.Com/ü", "É.com", "/ü", "com/", "allow"), ("http://x.com/\n/en", "x.com", "/\n/en", "com/", "allow")]


def test_urls_and_rules(spark):
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("Host", F.lit("mine"))
    got = {r["page_id"]: r for r in hosts.judged(df).collect()}
    for i, (url, host, path, rule, verdict) in enumerate(URLS):
        r = got[i]
        assert (r["host_"], r["path"], r["rule"], r["Host"]) == (host, path, rule, "mine"), url
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
    assert hosts.judged(df.limit(0)).collect() == []


def test_hosts_are_judged_by_their_pages(spark):
    """Broken and markup-heavy pages block their host whatever the suffix; ports and suffixes of two labels are understood."""
    good, cut, thin = "<html><p>" + "plain words here " * 9 + "</html>", "<html><p>" + "plain words here " * 9, "<html>" + "<a href='x'></a>" * 9 + "</html>"
    rows = ([("http://junk.net:8080/x", h) for h in (cut, thin) * 15] + [("http://fine.net/x", good)] * 40 + [("http://a.shop.co.uk/", cut)] * 30
            + [("http://b.shop.co.uk/", None), ("http://junk.net/", None), ("http://new.co.uk", None), (None, None), ("http://fine.net/es/", cut)])
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string").withColumn("BAD", F.lit(1))
    got = {(r["url"] or "", r["html"] is None): r["verdict"] for r in hosts.judged(pages).collect()}
    assert {got[k] for k in got if "junk" in k[0] or "shop" in k[0]} == {"block"}
    assert got["http://fine.net/x", False] == "allow" and got["http://fine.net/es/", False] == "block" and got["", True] == "allow"
    cases = {"a.shop.co.uk": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.net": ("y.net", "net"), "localhost": ("localhost", "localhost"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in cases], "host string")
    assert {r[0]: (r[1], r[2]) for r in df.select("host", hosts.domain_of(F.col("host")), hosts.suffix_of(F.col("host"))).collect()} == cases


def test_shrinkage_follows_the_evidence(spark):
    rows = [("bad.spam.org", 1)] * 40 + [("new.spam.org", None)] + [(f"h{i}.good.org", 0) for i in range(30)] + [("one.good.org", 1)] + [("lonely.net", None)]
    rates = {r["host"]: r for r in hosts.reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert rates["bad.spam.org"]["rate"] > 0.9 and rates["new.spam.org"]["rate"] > 0.5
    assert rates["h1.good.org"]["rate"] < 0.2 and rates["one.good.org"]["rate"] < rates["new.spam.org"]["rate"]
    assert 0 < rates["lonely.net"]["rate"] < 1 and rates["lonely.net"]["weight"] < rates["bad.spam.org"]["weight"]
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(("bad.spam.org", "h1.good.org", "lonely.net"))], "page_id long, url string")
    outcomes = spark.createDataFrame([*rows, *[(h, None) for h in ("bad.spam.org", "h1.good.org", "lonely.net")]], "host string, bad int")
    verdicts = {r["host"]: r["verdict"] for r in hosts.judged(pages, outcomes).collect()}
    assert verdicts == {"bad.spam.org": "block", "h1.good.org": "allow", "lonely.net": "allow"}


def test_fitted_strength_recovers_the_spread(spark):
    """Units drawn from Beta(k m, k (1 - m)): the moment estimate is near k."""
    import numpy as np

    rng = np.random.default_rng(8)
    k, m = 12.0, 0.3
    p = rng.beta(k * m, k * (1 - m), 3000)
    n = rng.integers(5, 60, 3000)
    units = spark.createDataFrame([(float(a), float(b), m) for a, b in zip(n, rng.binomial(n, p))], "n double, bad double, mean double")
    assert units.agg(hosts.strength().alias("k")).first()["k"] == pytest.approx(k, rel=0.15)
