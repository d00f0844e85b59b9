"""Plan recommendation: rules, implicit-feedback factorisation, blend, evaluation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import literal_map, rnd
from hexcohort.functions.joins import join_small
from hexcohort.operators.numbering import number_rows
from hexcohort.sources.scratch import materialize


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def plans_by_name(name: Column) -> Column:
    """Plans of the first declared archetype whose name occurs in ``name``; NULL when none does."""
    chain = None
    for archetype, plans in K.ARCHETYPE_PLANS.items():
        cond = name.contains(archetype)
        chain = F.when(cond, _strings(plans)) if chain is None else chain.when(cond, _strings(plans))
    return chain


def rule_plans(name: Column, stored: Column | None = None, n: int = 3) -> Column:
    """By archetype name, else the stored plans, else the fixed fallback; first ``n``."""
    options = [plans_by_name(F.coalesce(name, F.lit("")))] + ([stored] if stored is not None else [])
    return F.slice(F.coalesce(*options, _strings(K.FALLBACK_PLANS)), 1, n)


def plan_name(plan: Column) -> Column:
    """Catalog name, else the id in title case."""
    return F.coalesce(F.try_element_at(literal_map(K.PLAN_NAMES), plan),
                      F.initcap(F.replace(plan, F.lit("_"), F.lit(" "))))


def plan_price(plan: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_element_at(literal_map(K.PLAN_PRICES), plan), F.lit(default))


def plan_catalog(spark) -> DataFrame:
    return spark.createDataFrame(
        K.PLAN_CATALOG, "plan_id string, plan_name string, monthly_price double, tags array<string>, data_gb int, "
                        "voice_min int, roaming boolean, speed string")


def scored_recommendations(dim: DataFrame, n: int = 3) -> DataFrame:
    """One row per segment and rank with plan name, price, match score and reason."""
    plans = rule_plans(F.col("segment_name"), F.col("plans") if "plans" in dim.columns else None, n)
    rows = dim.select("segment_id", "segment_name", F.posexplode(plans).alias("pos", "plan_id"))
    shown = F.coalesce("segment_name", F.lit("your segment"))
    reason = F.coalesce(F.try_element_at(literal_map(K.PLAN_REASONS), F.col("plan_id")), F.lit(K.FALLBACK_REASON))
    return rows.select(
        "segment_id", (F.col("pos") + 1).alias("rank"), "plan_id", plan_name(F.col("plan_id")).alias("plan_name"),
        plan_price(F.col("plan_id")).alias("price"),
        rnd(F.lit(1.0) - F.col("pos").cast("double") * F.lit(0.15), 2).alias("match_score"),
        F.replace(reason, F.lit("{name}"), shown).alias("reason"))


def given_interactions(rows: DataFrame, catalog: Sequence[str] = K.PLAN_IDS) -> DataFrame:
    """``(subscriber_id, plan_id, weight)``, one row per pair, from any number of given rows of these columns.

    Plans outside the catalog and weights that sum to 0 or less are left out.
    """
    return (rows.filter(F.col("plan_id").isin(list(catalog))).groupBy("subscriber_id", "plan_id")
            .agg(F.sum("weight").cast("double").alias("weight")).filter(F.col("weight") > 0))


def fit_als(interactions: DataFrame, factors: int = 32, iterations: int = 30, reg: float = 0.1,
            seed: int = 42, blocks: int | None = None, catalog: Sequence[str] = K.PLAN_IDS) -> tuple[ALSModel, DataFrame]:
    """Implicit ALS of Spark ML for catalogs of many plans.

    Returns the model and the (subscriber_id, user) numbering.  ``plan_id`` must
    be in the catalog.  With few plans use :func:`fit_narrow`: here one plan's
    ratings sit in one block.
    """
    users = number_rows(interactions.select("subscriber_id").distinct(), "user").select(
        "subscriber_id", F.col("user").cast("int").alias("user"))
    items = interactions.sparkSession.createDataFrame(list(enumerate(catalog)), "item int, plan_id string")
    data = (join_small(interactions.join(users, "subscriber_id"), items, "plan_id", "inner")
            .select("user", "item", F.col("weight").cast("float").alias("rating")))
    parts = blocks or int(interactions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    als = ALS(userCol="user", itemCol="item", ratingCol="rating", implicitPrefs=True, rank=min(factors, len(catalog)),
              maxIter=iterations, regParam=reg, seed=seed, numUserBlocks=max(10, parts))
    return als.fit(data), users


def preference_rows(interactions: DataFrame, catalog: Sequence[str] = K.PLAN_IDS) -> DataFrame:
    """``(subscriber_id, weights)``: catalog-wide weight array from one row per (subscriber, plan)."""
    held = F.map_from_entries(F.collect_list(F.struct("plan_id", F.col("weight").cast("double").alias("weight"))))
    weights = F.transform(_strings(list(catalog)), lambda p: F.coalesce(F.try_element_at("held", p), F.lit(0.0)))
    return interactions.groupBy("subscriber_id").agg(held.alias("held")).select("subscriber_id", weights.alias("weights"))


def _user_factors(w: np.ndarray, items: np.ndarray, reg: float) -> np.ndarray:
    """Best user vectors for rows of weights (a weight is the confidence of a preference of 1)."""
    rank = items.shape[1]
    outer = np.einsum("ir,is->irs", items, items)
    extra = np.einsum("ui,irs->urs", np.where(w > 0, w - 1.0, 0.0), outer)
    lhs = items.T @ items + extra + reg * np.eye(rank)
    return np.linalg.solve(lhs, (w @ items)[:, :, None])[:, :, 0]


def fit_narrow(prefs: DataFrame, factors: int = 32, iterations: int = 30, reg: float = 0.1,
               seed: int = 42, n_items: int = len(K.PLAN_IDS)) -> tuple[np.ndarray, DataFrame]:
    """Implicit alternating least squares for a small catalog, exact for any number of subscribers.

    Subscribers with equal weights have equal factors, so rows are folded to
    distinct weight patterns with their counts; there are few of them whatever
    the number of subscribers, and a popular plan is no hot spot.  A round
    solves the patterns task by task and adds up one small system per plan;
    only these sums reach the driver.  Returns plan factors and the patterns.
    """
    patterns = materialize(prefs.groupBy("weights").agg(F.count(F.lit(1)).alias("n")), "patterns")
    rank = min(factors, n_items)
    items = np.random.default_rng(seed).normal(0.0, 0.1, (n_items, rank))
    for _ in range(iterations):
        def sums(batches, items=items):
            gram = np.zeros((rank, rank))
            lhs, rhs = np.zeros((n_items, rank, rank)), np.zeros((n_items, rank))
            for pdf in batches:
                if not len(pdf):
                    continue
                w, n = np.array(pdf["weights"].tolist(), dtype=float), pdf["n"].to_numpy(dtype=float)
                x = _user_factors(w, items, reg)
                gram += np.einsum("u,ur,us->rs", n, x, x)
                lhs += np.einsum("u,ui,ur,us->irs", n, np.where(w > 0, w - 1.0, 0.0), x, x, optimize=True)
                rhs += np.einsum("u,ui,ur->ir", n, w, x)
            flat = np.concatenate([gram.ravel(), lhs.ravel(), rhs.ravel()])
            yield pd.DataFrame({"pos": np.arange(len(flat)), "v": flat})

        total = patterns.mapInPandas(sums, "pos int, v double").groupBy("pos").agg(F.sum("v").alias("v")).collect()
        flat = np.zeros(rank * rank * (n_items + 1) + n_items * rank)
        for r in total:
            flat[r["pos"]] = r["v"]
        gram = flat[:rank * rank].reshape(rank, rank)
        lhs = flat[rank * rank:rank * rank * (n_items + 1)].reshape(n_items, rank, rank)
        rhs = flat[rank * rank * (n_items + 1):].reshape(n_items, rank)
        items = np.linalg.solve(gram + lhs + reg * np.eye(rank), rhs[:, :, None])[:, :, 0]
    return items, patterns


def narrow_top_n(items: np.ndarray, patterns: DataFrame, prefs: DataFrame, subscribers: DataFrame, n: int = 3,
                 reg: float = 0.1, catalog: Sequence[str] = K.PLAN_IDS) -> DataFrame:
    """``(subscriber_id, cf_plans)`` for a narrow catalog; unknown subscribers get the first catalog plans.

    Each row of ``prefs`` solves its own factors, equal weights of a batch once.  ``patterns`` are not joined back: there can be
    nearly as many of them as subscribers, and a popular one would hold a large share of the rows.
    """
    names = list(catalog)

    def best(batches):
        for pdf in batches:
            w = np.array(pdf["weights"].tolist(), dtype=float).reshape(len(pdf), len(names))
            w, at = np.unique(w, axis=0, return_inverse=True)
            order = np.argsort(-(_user_factors(w, items, reg) @ items.T), axis=1, kind="stable")[:, :n]
            yield pd.DataFrame({"subscriber_id": pdf["subscriber_id"], "cf_plans": [[names[i] for i in order[k]] for k in at.ravel()]})

    known = prefs.select("subscriber_id", "weights").mapInPandas(
        best, f"subscriber_id {prefs.schema['subscriber_id'].dataType.simpleString()}, cf_plans array<string>")
    return _with_fallback(subscribers, known, n, catalog)


def _with_fallback(subscribers: DataFrame, known: DataFrame, n: int, catalog: Sequence[str]) -> DataFrame:
    # by size of its file alone Spark would broadcast a long table of few distinct values
    return (subscribers.select("subscriber_id").join(known.hint("merge"), "subscriber_id", "left")
            .withColumn("cf_plans", F.coalesce("cf_plans", _strings(list(catalog[:n])))))


#: Plans up to which each subscriber's weights fit in one row.
NARROW = 64


def collaborative_top_n(interactions: DataFrame, subscribers: DataFrame, n: int = 3,
                        catalog: Sequence[str] = K.PLAN_IDS, narrow: int = NARROW, **settings) -> DataFrame:
    """``(subscriber_id, cf_plans)`` from given interactions: the narrow way for a narrow catalog, else Spark ML."""
    if len(catalog) <= narrow:
        prefs = materialize(preference_rows(interactions, catalog), "preferences")
        items, patterns = fit_narrow(prefs, n_items=len(catalog), **settings)
        return narrow_top_n(items, patterns, prefs, subscribers, n, catalog=catalog)
    return als_top_n(*fit_als(interactions, catalog=catalog, **settings), subscribers, n, catalog)


def als_top_n(model: ALSModel, users: DataFrame, subscribers: DataFrame, n: int = 3,
              catalog: Sequence[str] = K.PLAN_IDS) -> DataFrame:
    """``(subscriber_id, cf_plans)`` from the Spark ML model; unknown subscribers get the first catalog plans.

    The item side has one factor per catalog plan, so it is read once and each
    user row scores all plans on its own: no user x item join.
    """
    items = {r["id"]: [float(x) for x in r["features"]] for r in model.itemFactors.collect()}  # at most one per plan
    scores = []
    for i, vec in sorted(items.items()):
        dot = sum((F.col("features")[j] * F.lit(v) for j, v in enumerate(vec)), F.lit(0.0))
        scores.append(F.struct((-dot).alias("s"), F.lit(i).alias("i"), F.lit(catalog[i]).alias("plan")))
    top = F.transform(F.slice(F.array_sort(F.array(*scores)), 1, n), lambda x: x["plan"])
    recs = (model.userFactors.withColumnRenamed("id", "user").join(users, "user")
            .select("subscriber_id", top.alias("cf_plans")))
    return _with_fallback(subscribers, recs, n, catalog)


def merge_plans(rule: Column, cf: Column, n: int = 3) -> Column:
    """Rule plans first, filled up from the collaborative ones, each once."""
    return F.slice(F.array_distinct(F.concat(rule, F.coalesce(cf, F.array().cast("array<string>")))), 1, n)


def blend_plans(rule: Column, cf: Column, weight: float = 0.3, n: int = 3) -> Column:
    """Optional true blend: plans ordered by the weighted reciprocal rank of both lists."""
    both = F.array_distinct(F.concat(rule, F.coalesce(cf, F.array().cast("array<string>"))))

    def inverse(lst: Column, p: Column) -> Column:
        pos = F.coalesce(F.array_position(lst, p), F.lit(0)).cast("double")
        return F.when(pos > 0, F.lit(1.0) / pos).otherwise(F.lit(0.0))

    ranked = F.transform(both, lambda p: F.struct(
        (-(F.lit(1.0 - weight) * inverse(rule, p) + F.lit(weight) * inverse(cf, p))).alias("s"), p.alias("p")))
    return F.slice(F.transform(F.array_sort(ranked), lambda x: x["p"]), 1, n)


def precision_at_k(df: DataFrame, recommended: str = "recommended", persona: str = "true_persona_name",
                   k: int = 3) -> DataFrame:
    """Mean share of the first ``k`` recommendations among the persona's plans; unknown personas do not count."""
    truth = plans_by_name(F.coalesce(persona, F.lit("")))
    hit = F.size(F.array_intersect(F.slice(recommended, 1, k), F.col("truth"))).cast("double") / F.lit(float(k))
    return (df.withColumn("truth", truth).filter(F.col("truth").isNotNull())
            .agg(F.count(F.lit(1)).alias("n_evaluated"), F.coalesce(F.avg(hit), F.lit(0.0)).alias("precision")))


def plan_coverage(recommended: DataFrame, plans: str = "recommended", catalog: Sequence[str] = K.PLAN_IDS) -> DataFrame:
    """Share of the catalog that is recommended to anyone."""
    return recommended.select(F.explode(plans).alias("p")).agg(
        F.count_distinct("p").alias("n_plans"),
        (F.count_distinct("p").cast("double") / F.lit(float(len(catalog)))).alias("coverage"))


def plan_matrix(dim: DataFrame) -> DataFrame:
    """Segment name, its first three plans by display name and the subscriber count."""
    def nth(i: int) -> Column:
        p = F.get("plans", i)
        return F.coalesce(F.initcap(F.replace(p, F.lit("_"), F.lit(" "))), F.lit("—"))

    return dim.select("segment_id", "segment_name", nth(0).alias("plan_1"), nth(1).alias("plan_2"),
                      nth(2).alias("plan_3"), "n_subscribers")
