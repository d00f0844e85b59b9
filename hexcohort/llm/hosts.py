"""Host reputation by empirical Bayes, in DataFrame operations only.

Judged pages give each host, its registered domain and its suffix counts of good and bad outcomes.  From the suffixes down,
a level's rate is shrunk towards the one above: with prior mean m and strength k, a domain with b bad of n has the
posterior Beta(k m + b, k (1 - m) + n - b).  Strengths are fitted by moments over all units of a level.  A page is blocked
when even the low end of its host's posterior (mean minus ``z`` standard deviations) is above ``limit``.

The suffix is the host's last label, or its last two where they are a listed public suffix; the registered domain is the suffix
and one label more.  A port counts for none of the three.

What is learned from are pages with an outcome.  Given none, each page's own markup is its outcome (``page_is_bad``); tables
without markup take the pages that a rule decides.

Counts fold before every shuffle, so a host with a third of all pages is one row per task; the table of hosts is written once,
and the tables above it have one row per host at most.  Joining them back to the pages is left to Spark, which broadcasts by measured size or splits what is
skewed.

Rules fix a verdict: a rule's host (with all subdomains) and path prefix, the longest one winning.  They are a short fixed
list and become one expression.

Defined cases: a null url, or one without ``://``, has empty host and path, no rule, and the verdict of an unknown host;
a host without a dot is its own domain and suffix; a page with null markup has no outcome; repeated rows count as often as they
stand there; urls and markup are read whole, however long; new columns get underscores where a table has their names; an empty
table gives no rows; without any outcome at all every page without a rule is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort.llm.common import fresh
from hexcohort.sources.scratch import materialize

#: Fixed rules: (rule, verdict).
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Public suffixes of two labels.
TWO_LABELS = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "com.cn", "co.in", "ac.jp", "co.jp", "ne.jp", "or.jp",
              "co.kr", "com.mx", "co.nz", "com.sg", "com.tr", "com.tw", "co.za")
#: A page is bad if less than this share of its characters is outside of tags.
TEXT_SHARE = 0.6
LIMIT, Z = 0.5, 1.0
#: Bounds of a fitted strength (pseudo-counts).
WEAKEST, STRONGEST = 1.0, 1000.0
#: Units with outcomes below which nothing is known of their spread; the prior is then the weakest.
FEWEST = 3


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def bare(host: Column) -> Column:
    """The host without a port."""
    return F.regexp_replace(host, ":[0-9]*$", "")


def _two(host: Column) -> Column:
    return F.substring_index(host, ".", -2).isin(*TWO_LABELS)


def suffix_of(host: Column) -> Column:
    return F.when(_two(host), F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(_two(host), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def page_is_bad(html: Column, share: float = TEXT_SHARE) -> Column:
    """1 for a page that is cut off (no end of ``html``) or mostly markup, else 0; null without markup."""
    text = F.length(F.regexp_replace(html, "<[^>]*>", ""))
    return ((~F.contains(html, F.lit("</html>"))) | (text < F.lit(share) * F.length(html))).cast("int")


def _longest(rules: Sequence[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    split = [(r, *r.partition("/")[::2], v) for r, v in rules]
    return [(r, h, "/" + p, v) for r, h, p, v in sorted(split, key=lambda x: -len(x[0]))]


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule, h, p, _ in reversed(_longest(rules)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def verdict_of_rule(rule: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def strength() -> Column:
    """Pseudo-counts of the prior from units ``(n, bad, mean)`` by moments, as one aggregate.

    For a beta-binomial unit, E[(bad - n m)^2] = n v + n (n - 1) v rho with v = m (1 - m) and rho = 1 / (k + 1); summing
    both sides over the units gives rho, and from it k.
    """
    n, bad, m = F.col("n"), F.col("bad"), F.col("mean")
    v = m * (1 - m)
    found = F.sum((bad - n * m) * (bad - n * m))
    binomial, extra = F.sum(n * v), F.sum(n * (n - 1) * v)
    rho = (found - binomial) / extra
    k = F.when((extra > 0) & (F.count_if(n > 0) >= FEWEST), F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(STRONGEST))).otherwise(F.lit(WEAKEST))
    return F.least(F.greatest(k, F.lit(WEAKEST)), F.lit(STRONGEST))


def _shrunk(units: DataFrame, n: str, bad: str) -> DataFrame:
    """Units with prior ``mean`` get ``rate`` and ``weight`` (posterior mean and pseudo-count) of their posterior.

    ``known`` is the weight behind the prior mean: a unit cannot inherit more certainty than the level above has.
    """
    units = units.withColumnsRenamed({n: "n", bad: "bad"})
    fitted = units.agg(strength().alias("k")).scalar()       # one number
    return (units.withColumn("k", F.least(fitted, F.col("known")))
            .withColumn("rate", (F.col("k") * F.col("mean") + F.col("bad")) / (F.col("k") + F.col("n")))
            .withColumn("weight", F.col("k") + F.col("n")).drop("n", "bad", "k", "mean", "known"))


def reputation(outcomes: DataFrame) -> DataFrame:
    """``(host, rate, weight)`` for every host, without port, of ``outcomes(host, bad)``; ``bad`` is 1, 0, or null where not judged."""
    judged = F.count("bad").cast("double")
    outcomes = outcomes.withColumn("host", bare(F.col("host")))
    hosts = (outcomes.groupBy("host").agg(judged.alias("n_h"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("b_h"))
             .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    hosts = materialize(hosts, "hosts")          # read by every level
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n_h").alias("n_d"), F.sum("b_h").alias("b_d"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n_d").alias("n_s"), F.sum("b_d").alias("b_s"))
    # one outcome of each kind more than found keeps the top mean inside (0, 1)
    whole = suffixes.agg(((F.coalesce(F.sum("b_s"), F.lit(0.0)) + 1) / (F.coalesce(F.sum("n_s"), F.lit(0.0)) + 2)).alias("mean"))
    all_known = suffixes.agg(F.coalesce(F.sum("n_s"), F.lit(0.0)) + 2).scalar()
    top = _shrunk(suffixes.withColumn("mean", whole.scalar()).withColumn("known", all_known), "n_s", "b_s")
    above = [F.col("rate").alias("mean"), F.col("weight").alias("known")]
    middle = _shrunk(domains.join(top.select("suffix", *above), "suffix"), "n_d", "b_d")
    low = hosts.drop("suffix").join(middle.select("domain", *above), "domain")
    return _shrunk(low, "n_h", "b_h").select("host", "rate", "weight")


def low_end(rate: Column, weight: Column, z: float = Z) -> Column:
    return rate - F.lit(z) * F.sqrt(rate * (1 - rate) / (weight + 1))


def judged(pages: DataFrame, outcomes: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES,
           limit: float = LIMIT, z: float = Z, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with host, path, rule, verdict and the low end of the host's share of bad pages (six digits).

    ``outcomes(host, bad)`` are labelled pages; without them the markup in column ``html`` is judged, and without that column
    the pages that a rule decides are the labelled ones.
    """
    host, path, rule, verdict, low, key = fresh(pages, "host", "path", "rule", "verdict", "bad_low", "host_key")
    parsed = pages.withColumn(host, host_of(F.col(f"`{url}`"))).withColumn(path, path_of(F.col(f"`{url}`")))
    parsed = parsed.withColumn(rule, rule_of(F.col(host), F.col(path), rules))
    if outcomes is None:
        bad = page_is_bad(F.col(f"`{html}`")) if html in pages.columns else (verdict_of_rule(F.col(rule), rules) == "block").cast("int")
        outcomes = parsed.select(F.col(host).alias("host"), bad.alias("bad"))
    known = reputation(outcomes).select(F.col("host").alias(key), F.round(low_end(F.col("rate"), F.col("weight"), z), 6).alias(low))
    joined = parsed.join(known, bare(F.col(host)) == F.col(key), "left").drop(key)
    own = F.when(F.col(low) > limit, F.lit("block")).otherwise(F.lit("allow"))
    return joined.withColumn(verdict, F.coalesce(verdict_of_rule(F.col(rule), rules), own))
